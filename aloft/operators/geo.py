"""Radius search."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aloft.functions.columns import EARTH_RADIUS_KM, haversine_km
from aloft.session import saved

#: most points, and most centres, of one cell that meet as one block, about
CELL_ROWS = 4_096
#: pairs of a cell's points and centres that a task of the join forms, about
TASK_PAIRS = 2 * CELL_ROWS ** 2
#: most tasks of the join
MOST_TASKS = 50_000


def within_radius(df: DataFrame, lat: str, lon: str, lat0: float, lon0: float,
                  radius_km: float = 10.0, name_col: str | None = None,
                  term: str | None = None) -> DataFrame:
    """Rows within ``radius_km`` great-circle km of (lat0, lon0) whose
    ``name_col`` contains ``term`` ignoring case.

    A latitude band ``|lat - lat0| <= radius / R`` (in degrees) is tested
    first: it is a plain range predicate (pushed to the parquet scan when
    ``lat`` is a stored column) and removes most rows before any trigonometry.
    """
    band = math.degrees(radius_km / EARTH_RADIUS_KM)
    cond = F.col(lat).between(lat0 - band, lat0 + band)
    if term is not None:
        cond = cond & F.lower(F.col(name_col)).contains(term.lower())
    return (df.where(cond)
            .where(haversine_km(F.lit(lat0), F.lit(lon0), F.col(lat), F.col(lon)) <= radius_km))


def count_within(df: DataFrame, lat: str, lon: str, lat0: float, lon0: float,
                 radius_km: float = 10.0, name_col: str | None = None,
                 term: str | None = None, out_col: str = "n") -> DataFrame:
    """A14 (Q18): how many rows ``within_radius`` keeps, one row."""
    return (within_radius(df, lat, lon, lat0, lon0, radius_km, name_col, term)
            .agg(F.count(F.lit(1)).alias(out_col)))


class Grid:
    """Cells for a radius: bands of latitude as high as the radius, each cut around into equal cells that are
    at least as wide as the radius reaches from any centre in the band or one next to it; near a pole a
    band is one cell.  So all points within the radius of a centre lie in its band or one next to it, in the cell at
    the centre's longitude or one next to that, counted around the date line."""

    def __init__(self, radius_km: float):
        # a little larger, so that rounding keeps no point out of its cells
        self.reach = min(math.pi, radius_km / EARTH_RADIUS_KM) * (1 + 1e-9) + 1e-12

    def band(self, lat: Column) -> Column:
        return F.floor(F.radians(lat) / F.lit(self.reach)).cast("long")

    def cells_around(self, band: Column) -> Column:
        far = F.greatest(F.abs(band), F.abs(band + 1)) * F.lit(self.reach) + F.lit(self.reach)
        wide = F.asin(F.least(F.lit(1.0), F.sin(F.lit(min(self.reach, math.pi / 2))) / F.cos(far)))
        return F.when(far + self.reach >= math.pi / 2, F.lit(1)).otherwise(
            F.greatest(F.lit(1), F.floor(F.lit(2 * math.pi) / wide))).cast("long")

    def cell(self, band: Column, lon: Column) -> Column:
        n = self.cells_around(band)
        turn = F.pmod(lon.cast("double") / F.lit(360.0), F.lit(1.0))
        return F.least(F.floor(turn * n), n - 1).cast("long")

    def cover(self, lat: Column, lon: Column) -> Column:
        """Array of the (band, cell) pairs that hold all points within the radius."""
        def around(band: Column) -> Column:
            n, own = self.cells_around(band), self.cell(band, lon)
            return F.transform(F.array_distinct(F.array(F.pmod(own - 1, n), own, F.pmod(own + 1, n))),
                               lambda c: F.struct(band.alias("band"), c.alias("cell")))
        middle = self.band(lat)
        return F.concat(*[around(middle + k) for k in (-1, 0, 1)])


def radius_join(centres: DataFrame, points: DataFrame, radius_km: float, *, centre_id: str, point_id: str,
                lat: str = "lat", lon: str = "lon", distance_col: str = "km") -> DataFrame:
    """Q18 for many centres: (centre_id, point_id, distance) of all pairs within ``radius_km`` great-circle km.

    An equi-join on grid cells, then the exact distance; no pair further apart than some radii is formed.
    The points of a cell are cut by a hash into parts of about :data:`CELL_ROWS`, and so are its centres; each part
    of the one meets each of the other as a block of its own, so a crowded place is many keys.  Pairs grow with the
    product of both tables, so the number of tasks follows the number of pairs in the cells, not
    the size of the rows.  Rows without a coordinate meet nothing."""
    grid = Grid(radius_km)
    some = F.col(lat).isNotNull() & F.col(lon).isNotNull()

    def place(df: DataFrame, key: str, side: str) -> DataFrame:
        """Rows as (id, degrees, unit vector)."""
        la, lo = F.radians(F.col(lat)), F.radians(F.col(lon))
        return df.where(some).select(F.col(key), F.col(lat).alias(f"__{side}lat"), F.col(lon).alias(f"__{side}lon"),
                                     (F.cos(la) * F.cos(lo)).alias(f"__{side}x"), (F.cos(la) * F.sin(lo)).alias(f"__{side}y"),
                                     F.sin(la).alias(f"__{side}z"))
    p = (place(points, point_id, "p")
         .withColumn("band", grid.band(F.col("__plat"))).withColumn("cell", grid.cell(F.col("band"), F.col("__plon"))))
    c = (place(centres, centre_id, "c")
         .withColumn("at", F.explode(grid.cover(F.col("__clat"), F.col("__clon"))))
         .select("*", "at.band", "at.cell").drop("at"))

    def counted(df: DataFrame, out: str) -> DataFrame:
        return df.groupBy("band", "cell").agg(F.count(F.lit(1)).alias(out))

    def parts(n: str) -> Column:
        return F.ceil(F.col(n) / CELL_ROWS).cast("int")
    sizes = saved(counted(p, "n").join(counted(c, "m"), ["band", "cell"])
                  .select("band", "cell", "n", "m", parts("n").alias("cuts"), parts("m").alias("copies")), "cells")
    pairs = sizes.agg(F.sum(F.col("n").cast("double") * F.col("m"))).first()[0] or 0.0
    least = int(centres.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, min(MOST_TASKS, math.ceil(pairs / TASK_PAIRS)))
    cells = sizes.select("band", "cell", "cuts", "copies")
    keys = ["band", "cell", "cut", "copy"]
    p = (p.join(cells, ["band", "cell"])
         .withColumn("cut", F.pmod(F.xxhash64(point_id, "__plat", "__plon"), F.col("cuts")).cast("int"))
         .withColumn("copy", F.explode(F.expr("sequence(0, copies - 1)"))).drop("cuts", "copies"))
    c = (c.join(cells, ["band", "cell"])
         .withColumn("copy", F.pmod(F.xxhash64(centre_id, "__clat", "__clon"), F.col("copies")).cast("int"))
         .withColumn("cut", F.explode(F.expr("sequence(0, cuts - 1)"))).drop("cuts", "copies"))
    # a number of partitions that is asked for is not merged again for the few bytes in them
    met = c.repartition(tasks, *keys).join(p.repartition(tasks, *keys), keys)
    # the cosine of the angle drops most pairs before any trigonometry, with a margin far above its rounding
    near = F.lit(math.cos(min(grid.reach, math.pi)) - 1e-12)
    cosine = F.col("__cx") * F.col("__px") + F.col("__cy") * F.col("__py") + F.col("__cz") * F.col("__pz")
    distance = haversine_km(F.col("__clat"), F.col("__clon"), F.col("__plat"), F.col("__plon"))
    return (met.where(cosine >= near).withColumn(distance_col, distance)
            .where(F.col(distance_col) <= radius_km).select(centre_id, point_id, distance_col))
