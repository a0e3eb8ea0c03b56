"""Place and social-graph questions (Q13-Q21)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aloft.constants import HOTEL_RADIUS_KM, HOTEL_TERM, PAGERANK_TOL
from aloft.operators import (count_within, edges_from_pairs, field_mean, most_active,
                             out_degree, pagerank, top1_with_lookup, top_ranked, triplets,
                             vertices_of, word_count)
from aloft.sources import read_country_codes, read_places, read_social


class PlaceAnalytics:
    """Questions over the 19-field place dump read from ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None,
                 places: DataFrame | None = None):
        self.spark = spark
        self.file = places if places is not None else read_places(spark, path)

    # Q13: (name, country_code, dem)
    def filter_data(self, data: DataFrame | None = None) -> DataFrame:
        d = self.file if data is None else data
        return d.select("name", "country_code", "dem")

    # Q14: elevations of one country (exact code match)
    def filter_elevation(self, country_code: str, data: DataFrame) -> DataFrame:
        return data.where(F.col("country_code") == country_code).select(
            F.col("dem").cast("int").alias("dem"))

    # Q15
    def elevation_average(self, data: DataFrame) -> DataFrame:
        return field_mean(data, "dem", "elevation_average")

    # Q16
    def most_common_words(self, data: DataFrame) -> DataFrame:
        return word_count(data, "name", " ", "word", "count")

    # Q17
    def most_common_country(self, data: DataFrame, codes_path: str | None = None,
                            codes: DataFrame | None = None) -> DataFrame:
        codes = codes if codes is not None else read_country_codes(self.spark, codes_path)
        return top1_with_lookup(data, "country_code", codes, "Code", "Name", "country")

    # Q18
    def hotels_in_area(self, lat: float, lon: float, radius_km: float = HOTEL_RADIUS_KM,
                       term: str = HOTEL_TERM) -> DataFrame:
        return count_within(self.file, "latitude", "longitude", lat, lon, radius_km,
                            name_col="name", term=term, out_col="hotels")


    # ------------------------------------------------------------------
    # Original method names; scalar answers are returned as scalars (one
    # aggregated row collected), DataFrames stay lazy.
    def filterData(self, data: DataFrame | None = None) -> DataFrame:  # noqa: N802
        return self.filter_data(data)

    def filterElevation(self, countryCode: str, data: DataFrame) -> DataFrame:  # noqa: N802,N803
        return self.filter_elevation(countryCode, data)

    def elevationAverage(self, data: DataFrame) -> float:  # noqa: N802
        return self.elevation_average(data).first()[0]

    def mostCommonWords(self, data: DataFrame) -> DataFrame:  # noqa: N802
        return self.most_common_words(data)

    def mostCommonCountry(self, data: DataFrame, path: str) -> str:  # noqa: N802
        row = self.most_common_country(data, path).first()
        return row[0] if row is not None else ""

    def hotelsInArea(self, lat: float, long: float) -> int:  # noqa: N802
        return int(self.hotels_in_area(lat, long).first()[0])


class SocialGraph:
    """Q19-Q21: a graph loaded from a ``a | b`` text dump (or given pairs)."""

    def __init__(self, edges: DataFrame, vertices: DataFrame | None = None):
        self.edges = edges
        self.vertices = vertices if vertices is not None else vertices_of(edges)

    @classmethod
    def load_social(cls, spark: SparkSession, path: str) -> "SocialGraph":
        return cls.from_pairs(read_social(spark, path))

    @classmethod
    def from_pairs(cls, pairs: DataFrame) -> "SocialGraph":
        return cls(edges_from_pairs(pairs))

    def triplets(self) -> DataFrame:
        v = self.vertices.select("id", F.col("id").cast("int").alias("attr"))
        return triplets(v, self.edges, default_attr=0)

    def out_degrees(self) -> DataFrame:
        return out_degree(self.edges)

    # Q20
    def most_active_user(self) -> DataFrame:
        return most_active(self.edges)

    # Q21: run to convergence
    def page_rank(self, tol: float = PAGERANK_TOL, max_iter: int | None = None,
                  **kw) -> DataFrame:
        return pagerank(self.edges, self.vertices, tol=tol, max_iter=max_iter, **kw)

    def page_rank_highest(self, tol: float = PAGERANK_TOL, max_iter: int | None = None,
                          **kw) -> DataFrame:
        return top_ranked(self.page_rank(tol, max_iter, **kw))

    # Original method names (vertex ids returned as ints).
    @classmethod
    def loadSocial(cls, spark: SparkSession, path: str) -> "SocialGraph":  # noqa: N802
        return cls.load_social(spark, path)

    def mostActiveUser(self) -> int:  # noqa: N802
        return int(self.most_active_user().first()["id"])

    def pageRankHighest(self) -> int:  # noqa: N802
        return int(self.page_rank_highest().first()["id"])
