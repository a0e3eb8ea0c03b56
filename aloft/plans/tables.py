"""The registered queries: every operator of the inventory applied to the
shared parquet tables (``region nation customer supplier part orders lineitem
events documents ...``), each paired with an independent SQL formulation.

Every query reads whole tables.  Floating results are rounded in both the
Spark query and the SQL, because summation order differs between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from aloft.operators import (anti_lookup, conditional_share, count_by_key, count_within,
                             domestic_only, edges_from_pairs, exact_percentile, field_mean, filter_project,
                             filtered_max, grouped_percentile, least_squares, most_active, moving_average,
                             out_degree, pagerank, radius_join, range_mean, route_counts, top1_with_lookup, top_ranked,
                             triplets, two_sided_mean, vertices_of, word_count)
from aloft.operators import ml
from aloft.operators.catalog import joined_totals, keyed_table
from aloft.operators.joins import bloom_semi_filter, semi_filter
from aloft.constants import (EARTH_RADIUS_KM, PAGERANK_RESET, PAGERANK_TOL, SOCIAL_LINE,
                             SPLIT_SEED, SPLIT_WEIGHTS)
from aloft.plans.places import PlaceAnalytics
from aloft.schemas import FLIGHT, PLACE, PLAYER_FEATURES
from aloft.session import saved
from aloft.sources import (parse_airport_lines, parse_carrier_lines, parse_country_code_lines, parse_flight_lines,
                           parse_place_lines, parse_player_lines, parse_social_lines, quarantine_csv_lines,
                           read_csv_lines, read_table, table_exists)

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values shared by the Spark queries and their SQL.
URGENT_FILTER = ("F", "1-URGENT")         # (o_orderstatus, o_orderpriority)
BRAND = "Brand#13"
REGION = "AMERICA"
PART_SIZE_OVER = 25
GEO_CENTER = (-83.0, -167.0)              # (lat, lon) of customer 1 on the derived grid
GEO_RADIUS_KM = 500.0
GEO_TERM = "7"                            # some customer names hold it, some do not
SHARE_KEY_MODULUS = 97                    # flags few customers' orders, so some groups have none
DOMESTIC_REGION = 1                       # nations of this region count as one country
PAGERANK_DIGITS = 6
EVENT_REACH = 3_600_000_000               # an hour either side, in microseconds


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def _r(c, digits: int) -> Column:
    return F.round(c if isinstance(c, Column) else F.col(c), digits)


# ---------------------------------------------------------------- relational

def q_count_by_key(spark, sf):                                     # Q02
    return count_by_key(_t(spark, sf, "lineitem"), "l_suppkey", "count")


def q_filter_project(spark, sf):                                   # Q03
    status, prio = URGENT_FILTER
    return filter_project(_t(spark, sf, "orders"),
                          (F.col("o_orderstatus") == status) & (F.col("o_orderpriority") == prio),
                          ["o_orderkey", "o_custkey"])


def q_filtered_max(spark, sf):                                     # Q04
    return filtered_max(_t(spark, sf, "lineitem"), "l_extendedprice",
                        F.month("l_shipdate").between(1, 3), "max_extendedprice")


def q_anti_lookup(spark, sf):                                      # Q05
    orders = _t(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    # the dimension's columns define the EXCEPT rows: project before the anti join
    return anti_lookup(_t(spark, sf, "customer").select("c_custkey", "c_name"), orders,
                       "c_custkey", "o_custkey", distinct=True)


def q_route_counts(spark, sf):                                     # Q06
    status, prio = URGENT_FILTER
    per_cust = (_t(spark, sf, "orders")
                .where((F.col("o_orderstatus") == status) & (F.col("o_orderpriority") == prio))
                .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("w")))
    fact = per_cust.join(_t(spark, sf, "customer").select("c_custkey", "c_nationkey"),
                         per_cust["o_custkey"] == F.col("c_custkey"))
    return route_counts(fact, _t(spark, sf, "nation"), "c_nationkey", "n_nationkey", "n_name",
                        out_col="Num", weight_col="w")


def q_two_sided_mean(spark, sf):                                   # Q07
    out = two_sided_mean(_t(spark, sf, "lineitem"), "l_suppkey", "l_quantity",
                         "l_partkey", "l_tax", out_key="key", out_value="mean_value")
    return out.select("key", _r("mean_value", 6).alias("mean_value"))


def q_median(spark, sf):                                           # Q08
    return exact_percentile(_t(spark, sf, "lineitem"), "l_quantity", 0.5, "m") \
        .select(_r("m", 6).alias("median_quantity"))


def q_p95(spark, sf):                                              # Q09
    return exact_percentile(_t(spark, sf, "lineitem"), "l_extendedprice", 0.95, "p") \
        .select(_r("p", 6).alias("p95_extendedprice"))


def q_domestic_mean(spark, sf):                                    # Q07, domestic only
    suppliers = _t(spark, sf, "supplier")
    nations = _t(spark, sf, "nation").select(
        "n_nationkey", F.col("n_regionkey").cast("string").alias("country"))
    airports = (suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
                .select(F.col("s_suppkey").alias("iata"), "country"))
    legs = _t(spark, sf, "lineitem").withColumn("dest", F.col("l_orderkey") % 100)
    legs = domestic_only(legs, airports, "l_suppkey", "dest", country=str(DOMESTIC_REGION))
    out = two_sided_mean(legs, "l_suppkey", "l_quantity", "dest", "l_tax", out_key="key",
                         out_value="mean_value")
    return out.select("key", _r("mean_value", 6).alias("mean_value"))


def q_semi_filter(spark, sf):                                      # J07
    """Rows whose two end keys both belong to allowed sets.  The sets are semi joins
    themselves, so Spark knows their size and lineitem is not shuffled for small ones."""
    region = _t(spark, sf, "region").where(F.col("r_name") == REGION)
    nations = semi_filter(_t(spark, sf, "nation"), "n_regionkey", region, "r_regionkey")
    suppliers = semi_filter(_t(spark, sf, "supplier"), "s_nationkey", nations, "n_nationkey")
    big_parts = _t(spark, sf, "part").where(F.col("p_size") > PART_SIZE_OVER)
    li = semi_filter(_t(spark, sf, "lineitem"), "l_suppkey", suppliers, "s_suppkey")
    li = semi_filter(li, "l_partkey", big_parts, "p_partkey")
    return count_by_key(li, "l_returnflag", "count")


def q_bloom_semi_filter(spark, sf):                                # J07, allowed set met by a Bloom filter first
    urgent = filter_project(_t(spark, sf, "orders"), F.col("o_orderpriority") == URGENT_FILTER[1], ["o_orderkey"])
    return bloom_semi_filter(_t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"),
                             "l_orderkey", urgent, "o_orderkey")


def q_conditional_share(spark, sf):                                # Q10
    dim = (_t(spark, sf, "customer").select("c_custkey", "c_nationkey")
           .join(_t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
           .join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
           .select("c_custkey", "n_name", "r_name"))
    flag = (F.col("o_orderstatus") == "F") & (F.col("o_custkey") % SHARE_KEY_MODULUS == 0)
    out = conditional_share(_t(spark, sf, "orders"), dim, "o_custkey", "c_custkey", flag,
                            ["n_name", "r_name"])
    return out.select("n_name", "r_name", _r("percentage", 9).alias("percentage"))


def _kept(spark, sf):
    """Orders and customers in the catalog, kept by customer; shared by the queries that join the two."""
    orders = keyed_table(_t(spark, sf, "orders"), "orders_by_customer", "o_custkey",
                         ["o_custkey", "o_orderstatus", "o_orderpriority"])
    return orders, keyed_table(_t(spark, sf, "customer"), "customers", "c_custkey", ["c_custkey", "c_nationkey"])


def q_route_counts_kept(spark, sf):                                # Q06 S11 over catalog tables
    orders, customers = _kept(spark, sf)
    status, prio = URGENT_FILTER
    wanted = (F.col("o_orderstatus") == status) & (F.col("o_orderpriority") == prio)
    per_customer = joined_totals(orders, customers, {"w": F.count_if(wanted)})
    return route_counts(per_customer.where("w > 0"), _t(spark, sf, "nation"), "c_nationkey", "n_nationkey", "n_name",
                        out_col="Num", weight_col="w")


def q_conditional_share_kept(spark, sf):                           # Q10 S11 over catalog tables
    orders, customers = _kept(spark, sf)
    flag = (F.col("o_orderstatus") == "F") & (F.col("o_custkey") % SHARE_KEY_MODULUS == 0)
    per_customer = joined_totals(orders, customers, {"flagged": F.count_if(flag), "n": F.count(F.lit(1))})
    nations = (_t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
               .select("n_nationkey", "n_name", "r_name"))
    per_nation = per_customer.groupBy("c_nationkey").agg(F.sum("flagged").alias("flagged"), F.sum("n").alias("n"))
    return (per_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name", "r_name").agg(F.sum("flagged").alias("flagged"), F.sum("n").alias("n"))
            .where("flagged > 0")
            .select("n_name", "r_name", _r(F.col("flagged") / F.col("n"), 9).alias("percentage"))
            .orderBy(F.desc("percentage"), F.desc("n_name"), F.desc("r_name")))


def q_catalog_tables(spark, sf):                                   # S11 S12
    """Every order under whether the catalog has its table, by a view's name as the loader registers one."""
    _t(spark, sf, "orders").createOrReplaceTempView("aloft_orders")
    found = [(name, table_exists(spark, name)) for name in ("aloft_orders", "aloft_nothing")]
    rows = spark.table("aloft_orders").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("o_custkey").alias("n_keys"))
    exists = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(e).alias("present")) for n, e in found]))
    return rows.select(exists.alias("t"), "n", "n_keys").select(
        "t.name", "t.present", F.when(F.col("t.present"), F.col("n")).alias("n"),
        F.when(F.col("t.present"), F.col("n_keys")).alias("n_keys"))


def q_least_squares(spark, sf):                                    # Q11
    fit = least_squares(_t(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", x_min=0)
    return fit.select(_r("intercept", 4).alias("intercept"), _r("slope", 4).alias("slope"))


def q_moving_average(spark, sf):                                   # Q12
    out = moving_average(_t(spark, sf, "lineitem"), F.to_date("l_shipdate"), "l_quantity",
                         days=5)
    return out.select("date", _r("moving_average", 9).alias("moving_average"))


def q_moving_average_by_flag(spark, sf):                           # Q12, one series per flag
    out = moving_average(_t(spark, sf, "lineitem"), F.to_date("l_shipdate"), "l_quantity",
                         days=5, partition_cols=["l_returnflag"])
    return out.select("l_returnflag", "date", _r("moving_average", 9).alias("moving_average"))


# ---------------------------------------------------------------- places-style

def _part_places(spark, sf) -> PlaceAnalytics:
    """Parts as places: the brand is the country, the size the elevation."""
    return PlaceAnalytics(spark, places=_t(spark, sf, "part").select(
        F.col("p_name").alias("name"), F.col("p_brand").alias("country_code"),
        F.col("p_size").alias("dem")))


def q_project_fields(spark, sf):                                   # Q13
    return _part_places(spark, sf).filter_data()


def _brand_sizes(spark, sf):
    places = _part_places(spark, sf)
    return places.filter_elevation(BRAND, places.filter_data()).select(
        F.col("dem").alias("p_size"))


def q_filter_measure(spark, sf):                                   # Q14
    return _brand_sizes(spark, sf)


def place_lines(spark, sf) -> DataFrame:
    """Suppliers rendered as raw 19-field place lines."""
    own = {"geonameid": F.col("s_suppkey"), "name": F.concat(F.lit('"'), F.col("s_name")),
           "country_code": F.col("s_nationkey"), "dem": F.floor("s_acctbal").cast("int"),
           "latitude": F.col("s_suppkey") % 90, "population": F.col("s_suppkey") * 10}
    fields = [F.coalesce(own[n].cast("string"), F.lit("")) if n in own else F.lit("")
              for n in PLACE.names]
    return _t(spark, sf, "supplier").select(F.concat_ws("\t", *fields).alias("value"))


def q_place_rows(spark, sf):                                       # Q13 S04 F-free parse
    rows = parse_place_lines(place_lines(spark, sf))
    return rows.select("geonameid", "name", "country_code", "dem", "latitude", "population",
                       "timezone")


def q_mean_measure(spark, sf):                                     # Q15
    return field_mean(_brand_sizes(spark, sf), "p_size", "m").select(
        _r("m", 9).alias("mean_size"))


def q_word_count(spark, sf):                                       # Q16
    return word_count(_t(spark, sf, "part"), "p_name", " ", "word", "count")


def q_word_count_documents(spark, sf):                             # Q16 on whole documents
    return word_count(_t(spark, sf, "documents"), "text", " ", "word", "count")


def q_top1_with_lookup(spark, sf):                                 # Q17
    return top1_with_lookup(_t(spark, sf, "customer"), "c_nationkey", _t(spark, sf, "nation"),
                            "n_nationkey", "n_name", "country")


def _customer_points(spark, sf, name: str = "c_name"):
    return _t(spark, sf, "customer").select(
        name,
        ((F.col("c_custkey") * 7) % 180 - 90).cast("double").alias("lat"),
        ((F.col("c_custkey") * 13) % 360 - 180).cast("double").alias("lon"))


def q_count_within(spark, sf):                                     # Q18
    lat0, lon0 = GEO_CENTER
    return count_within(_customer_points(spark, sf), "lat", "lon", lat0, lon0, GEO_RADIUS_KM,
                        name_col="c_name", term=GEO_TERM, out_col="n")


def q_radius_join(spark, sf):                                      # Q18 for many centres
    suppliers = _t(spark, sf, "supplier").select(
        "s_suppkey", ((F.col("s_suppkey") * 11) % 180 - 89.5).alias("lat"),
        ((F.col("s_suppkey") * 17) % 360 - 179.5).alias("lon"))
    customers = _customer_points(spark, sf, "c_custkey")
    found = radius_join(suppliers, customers, GEO_RADIUS_KM, centre_id="s_suppkey", point_id="c_custkey")
    return found.withColumn("km", _r("km", 3))


def q_moving_mean_events(spark, sf):                               # Q12 at the events' own instants
    at = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', cast(ts AS timestamp_ntz))")
    return range_mean(_t(spark, sf, "events"), at, "value", EVENT_REACH, at_col="at",
                      out_col="moving_mean").withColumn("moving_mean", _r("moving_mean", 9))


def q_median_by_group(spark, sf):                                  # Q08 for every supplier
    return grouped_percentile(_t(spark, sf, "lineitem"), ["l_suppkey"], "l_extendedprice", 0.5, "median_price") \
        .withColumn("median_price", _r("median_price", 6))


# ---------------------------------------------------------------- graph

def social_lines(spark, sf) -> DataFrame:
    """Events rendered as a text dump: purchases become ``user | k`` lines,
    every other event a line the graph parser must skip."""
    ev = _t(spark, sf, "events")
    return ev.select(F.when(
        F.col("event_type") == "purchase",
        F.concat(F.col("user_id").cast("string"), F.lit(" | "),
                 F.get_json_object("props", "$.k")))
        .otherwise(F.concat(F.col("event_type"), F.lit(" "), F.col("user_id").cast("string")))
        .alias("value"))


def social_edges(spark, sf) -> DataFrame:
    return edges_from_pairs(parse_social_lines(social_lines(spark, sf)))


def q_edges_from_pairs(spark, sf):                                 # Q19
    return social_edges(spark, sf)


def q_triplets(spark, sf):                                         # J08
    """The attribute is not the id, and vertices with odd ids are not listed."""
    e = saved(social_edges(spark, sf), "edges")
    v = vertices_of(e).where(F.col("id") % 2 == 0).select("id", (F.col("id") * 3 + 1).alias("attr"))
    return triplets(v, e, default_attr=0)


def q_out_degree(spark, sf):                                       # G02
    return out_degree(social_edges(spark, sf))


def q_most_active(spark, sf):                                      # Q20
    return most_active(social_edges(spark, sf))


def _ranks(spark, sf):
    return pagerank(social_edges(spark, sf), least=0.0)  # to its tolerance, every change told


def q_pagerank(spark, sf):                                         # Q21 (all ranks)
    return _ranks(spark, sf).select("id", _r("rank", PAGERANK_DIGITS).alias("rank"))


def q_pagerank_top(spark, sf):                                     # Q21 (highest)
    return top_ranked(_ranks(spark, sf)).select("id")


# ---------------------------------------------------------------- loaders

NA_LINE_SCHEMA = StructType([
    StructField("l_orderkey", LongType()), StructField("l_linenumber", IntegerType()),
    StructField("l_quantity", DoubleType()), StructField("l_discount", DoubleType()),
    StructField("l_returnflag", StringType())])


def q_csv_na_roundtrip(spark, sf):                                 # Q01 parse rules
    li = _t(spark, sf, "lineitem")
    disc = F.when(F.col("l_discount") == 0, None).otherwise(F.col("l_discount"))
    fields = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity"), disc,
              F.col("l_returnflag")]
    line = F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("NA")) for c in fields])
    return read_csv_lines(li.select(line.alias("value")), NA_LINE_SCHEMA,
                          options={"nullValue": "NA"})


def q_quarantine_rows(spark, sf):                                  # Q01 S03, bad lines kept apart
    li = _t(spark, sf, "lineitem")
    kind = F.col("l_orderkey") % 11
    disc = F.when(F.col("l_discount") == 0, None).otherwise(F.col("l_discount"))
    quantity = F.when(kind == 3, F.lit("many")).otherwise(F.col("l_quantity").cast("string"))
    fields = [F.col("l_orderkey"), F.col("l_linenumber"), quantity, disc, F.col("l_returnflag")]
    line = F.concat_ws(",", *[F.coalesce(c.cast("string"), F.lit("NA")) for c in fields])
    line = (F.when(kind == 1, F.regexp_replace(line, ",[^,]*$", "")).when(kind == 2, F.concat(line, F.lit(",more")))
            .otherwise(line))
    lines = li.select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("number"), line.alias("value"))
    return quarantine_csv_lines(lines, NA_LINE_SCHEMA, options={"nullValue": "NA"}, keep=["key", "number"])


def _csv_line(fields: dict[str, Column], header: list[str]) -> Column:
    """One CSV line in the order of ``header``; columns without a value get the text ``more``."""
    return F.concat_ws(",", *[F.coalesce(fields[n].cast("string"), F.lit("")) if n in fields else F.lit("more")
                              for n in header])


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def q_carrier_rows(spark, sf):                                     # S01, header in another order
    header = ["Description", "Since", "Code"]
    fields = {"Code": F.concat(F.lit("S"), F.col("s_suppkey")),
              "Description": _quoted(F.concat(F.col("s_name"), F.lit(", Inc. (est. 1990)")))}
    lines = _t(spark, sf, "supplier").select(_csv_line(fields, header).alias("value"))
    return parse_carrier_lines(lines, header)


def q_airport_rows(spark, sf):                                     # S02, quoted names, coordinates
    header = ["long", "iata", "airport", "city", "state", "country", "lat", "note"]
    fields = {"iata": F.col("c_custkey"), "airport": _quoted(F.concat(F.col("c_name"), F.lit(", Field"))),
              "city": F.col("n_name"), "state": F.when(F.col("c_custkey") % 3 > 0, F.concat(F.lit("S"), F.col("c_nationkey"))),
              "country": F.when(F.col("n_regionkey") == DOMESTIC_REGION, "USA").otherwise("NA"),
              "lat": F.when(F.col("c_custkey") % 5 > 0, F.col("c_custkey") % 180 - 90.25), "long": F.col("c_custkey") % 360 - 180}
    rows = _t(spark, sf, "customer").join(_t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return parse_airport_lines(rows.select(_csv_line(fields, header).alias("value")), header)


def q_country_code_rows(spark, sf):                                # S05, NA is a code
    header = ["Name", "Code"]
    fields = {"Name": _quoted(F.concat(F.initcap("n_name"), F.lit(", Republic of"))),
              "Code": F.when(F.col("n_nationkey") == 7, "NA").otherwise(F.substring("n_name", 1, 2))}
    lines = _t(spark, sf, "nation").select(_csv_line(fields, header).alias("value"))
    return parse_country_code_lines(lines, header)


def flight_lines(spark, sf, header: list[str]) -> DataFrame:
    """lineitem rendered as flight CSV lines with the columns in the order of ``header``."""
    own = {"FlightNum": F.col("l_orderkey"), "TailNum": F.concat(F.lit("N"), F.col("l_suppkey")),
           "Origin": F.col("l_suppkey"), "Dest": F.col("l_partkey"),
           "Distance": F.col("l_quantity").cast("int"),
           "DepDelay": F.when(F.col("l_discount") > 0, F.col("l_linenumber"))}
    fields = [F.coalesce(own[n].cast("string"), F.lit("NA")) if n in own else F.lit("NA")
              for n in header]
    return _t(spark, sf, "lineitem").select(F.concat_ws(",", *fields).alias("value"))


def q_flight_rows(spark, sf):                                      # Q01, columns by header name
    header = sorted(FLIGHT.names, reverse=True)
    return parse_flight_lines(flight_lines(spark, sf, header), header).select(
        "FlightNum", "TailNum", "Origin", "Dest", "Distance", "DepDelay", "ArrDelay")


def player_lines(spark, sf) -> DataFrame:
    """All documents with their labels, if any, as raw 16-field player lines (doc_id kept aside);
    a document without labels is a customer who did not pay."""
    d = _t(spark, sf, "documents").join(_t(spark, sf, "labels"), "doc_id", "left")
    s = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    fields = [
        F.col("doc_id"), F.concat(F.lit("doc"), F.col("doc_id")),
        F.concat(F.col("source"), F.lit("@example.org")),
        F.when(F.col("toxic") == 1, F.lit(" Male")).otherwise(F.lit("female")),
        F.col("n_chars") % 97, F.concat(F.col("lang"), F.lit(" street")), F.upper("lang"),
        F.col("doc_id") * 1000, F.col("n_chars") % 13, F.col("n_chars"),
        F.col("doc_id") % 3, F.col("doc_id") % 5, F.col("doc_id") % 7, F.col("n_chars") % 11,
        F.lit(0), F.when(F.col("quality") == 1, F.lit("YES ")).otherwise(F.lit("no")),
    ]
    return d.select("doc_id", F.concat_ws(",", *[s(c) for c in fields]).alias("value"))


def players(spark, sf) -> DataFrame:
    """(doc_id, the 10 player columns)."""
    return parse_player_lines(player_lines(spark, sf), keep=["doc_id"])


def q_player_convert(spark, sf):                                   # Q22
    return parse_player_lines(player_lines(spark, sf).select("value"))


# ---------------------------------------------------------------- ml

def indexed_players(spark, sf) -> DataFrame:
    # the indexer, the scaler and the output read the converted rows from one written table
    return ml.index_categories(saved(players(spark, sf), "players"), "country", "country_index",
                               handle_invalid="keep")


def q_category_index(spark, sf):                                   # Q23
    docs = _t(spark, sf, "documents").select("doc_id", "lang")
    return ml.index_categories(docs, "lang", "lang_index", handle_invalid="keep")


def q_category_index_brand(spark, sf):                             # Q23 on part brands
    parts = _t(spark, sf, "part").select("p_partkey", "p_brand")
    return ml.index_categories(parts, "p_brand", "brand_index", handle_invalid="keep")


def q_category_index_distributed(spark, sf):                       # Q23, labels never collected
    docs = _t(spark, sf, "documents").select("doc_id", "lang")
    return ml.index_categories_distributed(docs, "lang", "lang_index").select(
        "doc_id", "lang", "lang_index")


def q_assemble(spark, sf):                                         # Q24
    a = ml.assemble(indexed_players(spark, sf), PLAYER_FEATURES, "features")
    return ml.vector_columns(a, "features", PLAYER_FEATURES, ["doc_id"])


def q_scale(spark, sf):                                            # Q25
    a = ml.assemble(indexed_players(spark, sf), PLAYER_FEATURES, "features")
    s = ml.scale(a, "scaledFeatures", "features")
    return ml.vector_columns(s, "scaledFeatures", PLAYER_FEATURES, ["doc_id"])


def q_hash_split(spark, sf):                                       # Q28
    flag = ml.in_train("doc_id", SPLIT_WEIGHTS[0], seed=SPLIT_SEED)
    return players(spark, sf).select(
        "doc_id", F.when(flag, F.lit("train")).otherwise(F.lit("test")).alias("split"))


def q_exact_split(spark, sf):                                      # Q28, exact sizes for each language
    docs = _t(spark, sf, "documents").select("doc_id", "lang")
    flagged = ml.exact_split(docs, "doc_id", ["lang"], SPLIT_WEIGHTS[0], SPLIT_SEED)
    return flagged.select("doc_id", "lang", F.when(F.col("in_train"), "train").otherwise("test").alias("split"))


_NUMERIC = [c for c in PLAYER_FEATURES if c != "country_index"]


def _scored(spark, sf):
    return ml.fit_and_score_newton(players(spark, sf), "doc_id", "country", _NUMERIC,
                                   "paid_customer", train_fraction=0.9, seed=10, max_iter=5)[1]


def q_fit_predict(spark, sf):                                      # Q26 Q27 Q30
    return _scored(spark, sf).select("doc_id", "paid_customer", "prediction",
                                     _r("p_positive", 6).alias("p_positive"))


def q_evaluate(spark, sf):                                         # Q29
    m = ml.evaluate(_scored(spark, sf), "paid_customer", raw_col="p_positive")
    return spark.createDataFrame([m], "auc double, auc_hard double, accuracy double, n bigint") \
        .select(*[_r(c, 9).alias(c) for c in ("auc", "auc_hard", "accuracy")], "n")


def q_evaluate_scores(spark, sf):                                  # Q29 on given scores
    rows = (_t(spark, sf, "documents").join(_t(spark, sf, "labels"), "doc_id")
            .where(F.col("quality").isNotNull())
            .select(F.col("quality").cast("double").alias("label"),
                    (F.col("n_chars") % 1009).cast("double").alias("score"))
            .withColumn("prediction", (F.col("score") > 500).cast("double")))
    m = ml.evaluate(rows, "label", "prediction", "score")
    return spark.createDataFrame([m], "auc double, auc_hard double, accuracy double, n bigint") \
        .select(*[_r(c, 9).alias(c) for c in ("auc", "auc_hard", "accuracy")], "n")


def _one_feature(spark, sf) -> DataFrame:
    """Orders: is the status F, and is the priority one of the first two; unrelated but uneven."""
    return saved(_t(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("double").alias("label"),
        (F.col("o_totalprice") > 100000).cast("double").alias("big")), "one-feature")


def _one_feature_model(rows):
    return ml.fit_logistic(ml.assemble(rows, ["big"]), "features", "label", max_iter=200, tol=1e-9)


def q_logistic_fit(spark, sf):                                     # Q26 against the closed form
    model = _one_feature_model(_one_feature(spark, sf))
    return spark.createDataFrame(
        [(round(float(model.intercept), 4), round(float(model.coefficients[0]), 4))],
        "intercept double, coefficient double")


def q_logistic_predict(spark, sf):                                 # Q27 against the closed form
    rows = _one_feature(spark, sf)
    out = ml.predict(_one_feature_model(rows), ml.assemble(rows, ["big"]))
    return out.select("o_orderkey", "prediction",
                      _r(ml.vector_to_array("probability")[1], 4).alias("p_positive"))


QUERIES: dict[str, Query] = {
    "count_by_key": q_count_by_key,
    "filter_project": q_filter_project,
    "filtered_max": q_filtered_max,
    "anti_lookup": q_anti_lookup,
    "route_counts": q_route_counts,
    "two_sided_mean": q_two_sided_mean,
    "domestic_mean": q_domestic_mean,
    "median": q_median,
    "p95": q_p95,
    "semi_filter": q_semi_filter,
    "bloom_semi_filter": q_bloom_semi_filter,
    "conditional_share": q_conditional_share,
    "route_counts_kept": q_route_counts_kept,
    "conditional_share_kept": q_conditional_share_kept,
    "catalog_tables": q_catalog_tables,
    "least_squares": q_least_squares,
    "moving_average": q_moving_average,
    "moving_average_by_flag": q_moving_average_by_flag,
    "project_fields": q_project_fields,
    "filter_measure": q_filter_measure,
    "place_rows": q_place_rows,
    "mean_measure": q_mean_measure,
    "word_count": q_word_count,
    "word_count_documents": q_word_count_documents,
    "top1_with_lookup": q_top1_with_lookup,
    "count_within": q_count_within,
    "radius_join": q_radius_join,
    "moving_mean_events": q_moving_mean_events,
    "median_by_group": q_median_by_group,
    "edges_from_pairs": q_edges_from_pairs,
    "triplets": q_triplets,
    "out_degree": q_out_degree,
    "most_active": q_most_active,
    "pagerank": q_pagerank,
    "pagerank_top": q_pagerank_top,
    "csv_na_roundtrip": q_csv_na_roundtrip,
    "quarantine_rows": q_quarantine_rows,
    "flight_rows": q_flight_rows,
    "carrier_rows": q_carrier_rows,
    "airport_rows": q_airport_rows,
    "country_code_rows": q_country_code_rows,
    "player_convert": q_player_convert,
    "category_index": q_category_index,
    "category_index_brand": q_category_index_brand,
    "category_index_distributed": q_category_index_distributed,
    "assemble": q_assemble,
    "scale": q_scale,
    "hash_split": q_hash_split,
    "exact_split": q_exact_split,
    "fit_predict": q_fit_predict,
    "evaluate": q_evaluate,
    "evaluate_scores": q_evaluate_scores,
    "logistic_fit": q_logistic_fit,
    "logistic_predict": q_logistic_predict,
}


# ---------------------------------------------------------------- SQL oracles

_SOCIAL = SOCIAL_LINE
_EDGES = f"""
SELECT CAST(regexp_extract(value, '{_SOCIAL}', 1) AS BIGINT) AS src,
       CAST(regexp_extract(value, '{_SOCIAL}', 2) AS BIGINT) AS dst,
       count(*) AS weight
FROM (SELECT CASE WHEN event_type = 'purchase'
                  THEN CAST(user_id AS VARCHAR) || ' | ' || json_extract_string(props, '$.k')
                  ELSE event_type || ' ' || CAST(user_id AS VARCHAR) END AS value
      FROM events) t
WHERE regexp_full_match(value, '{_SOCIAL}')
GROUP BY 1, 2"""

# rounds go on while the last one changed some rank by the tolerance or more
_ALL_RANKS = f"""
WITH RECURSIVE e AS MATERIALIZED ({_EDGES}),
deg AS MATERIALIZED (SELECT src, count(*) AS c FROM e GROUP BY src),
v AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e),
r(i, id, v, delta) AS (
  SELECT 0, id, CAST(1.0 AS DOUBLE), CAST(1.0 AS DOUBLE) FROM v
  UNION ALL
  SELECT x.i, x.id, x.v, max(abs(x.v - x.old)) OVER () FROM (
    SELECT (SELECT max(i) FROM r) + 1 AS i, v.id, any_value(o.v) AS old,
           CAST({PAGERANK_RESET} AS DOUBLE) + CAST({1 - PAGERANK_RESET} AS DOUBLE)
             * coalesce(sum(r.v / deg.c), 0) AS v
    FROM v JOIN r o ON o.id = v.id LEFT JOIN e ON e.dst = v.id LEFT JOIN deg ON deg.src = e.src
           LEFT JOIN r ON r.id = e.src
    WHERE o.delta >= {PAGERANK_TOL}
    GROUP BY v.id) x)"""

# pagerank_top: a vertex sends what its rank changed since it last sent, if that is the tolerance or more; rounds go on
# while some vertex has to
_RANKS = f"""
WITH RECURSIVE e AS MATERIALIZED ({_EDGES}),
deg AS MATERIALIZED (SELECT src, count(*) AS c FROM e GROUP BY src),
v AS MATERIALIZED (SELECT src AS id FROM e UNION SELECT dst FROM e),
r(i, id, v, pending, most) AS (
  SELECT 0, id, CAST({PAGERANK_RESET} AS DOUBLE), CAST(1.0 AS DOUBLE), CAST(1.0 AS DOUBLE) FROM v
  UNION ALL
  SELECT x.i, x.id, x.v, x.pending, max(abs(x.pending)) OVER () FROM (
    SELECT m.i, m.id, m.old + m.c AS v, CASE WHEN m.i = 1 THEN m.old + m.c - 1.0 ELSE m.kept + m.c END AS pending
    FROM (
      SELECT (SELECT max(i) FROM r) + 1 AS i, v.id, any_value(o.v) AS old,
             any_value(CASE WHEN abs(o.pending) >= {PAGERANK_TOL} THEN 0 ELSE o.pending END) AS kept,
             CAST({1 - PAGERANK_RESET} AS DOUBLE)
               * coalesce(sum(r.pending / deg.c) FILTER (abs(r.pending) >= {PAGERANK_TOL}), 0) AS c
      FROM v JOIN r o ON o.id = v.id LEFT JOIN e ON e.dst = v.id LEFT JOIN deg ON deg.src = e.src
             LEFT JOIN r ON r.id = e.src
      WHERE o.most >= {PAGERANK_TOL}
      GROUP BY v.id) m) x)"""

_PLAYERS = """
SELECT d.doc_id,
       CAST(CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END AS DOUBLE) AS gender,
       CAST(d.n_chars % 97 AS DOUBLE) AS age,
       NULLIF(upper(d.lang), '') AS country,
       CAST(d.n_chars % 13 AS DOUBLE) AS friend_count,
       CAST(d.n_chars AS DOUBLE) AS lifetime,
       CAST(d.doc_id % 3 AS DOUBLE) AS game1,
       CAST(d.doc_id % 5 AS DOUBLE) AS game2,
       CAST(d.doc_id % 7 AS DOUBLE) AS game3,
       CAST(d.n_chars % 11 AS DOUBLE) AS game4,
       CAST(CASE WHEN l.quality = 1 THEN 1 ELSE 0 END AS DOUBLE) AS paid_customer
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

_INDEXED_PLAYERS = f"""
WITH p AS ({_PLAYERS}),
f AS (SELECT country, count(*) AS n FROM p WHERE country IS NOT NULL GROUP BY country),
r AS (SELECT country, CAST(row_number() OVER (ORDER BY n DESC, country) - 1 AS DOUBLE) AS ci
      FROM f),
k AS (SELECT CAST(count(*) AS DOUBLE) AS nk FROM f),
a AS (SELECT p.*, coalesce(r.ci, k.nk) AS country_index
      FROM p LEFT JOIN r ON p.country = r.country CROSS JOIN k)"""


def _index_sql(table: str, key: str, col: str, out: str) -> str:
    return f"""
WITH f AS (SELECT {col}, count(*) AS n FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}),
r AS (SELECT {col}, CAST(row_number() OVER (ORDER BY n DESC, {col}) - 1 AS DOUBLE) AS ix FROM f),
k AS (SELECT CAST(count(*) AS DOUBLE) AS nk FROM f)
SELECT t.{key}, t.{col}, coalesce(r.ix, k.nk) AS {out}
FROM {table} t LEFT JOIN r ON t.{col} = r.{col} CROSS JOIN k"""


def _hav_sql(lat0, lon0) -> str:
    return (f"2 * {EARTH_RADIUS_KM} * asin(sqrt(least(pow(sin((radians(lat) - radians({lat0})) / 2), 2)"
            f" + pow(sin((radians(lon) - radians({lon0})) / 2), 2)"
            f" * cos(radians({lat0})) * cos(radians(lat)), 1.0)))")


# without a penalty, the fit on one 0/1 feature gives each side its own log odds
_LOGIT = """
WITH c AS (SELECT CAST(sum(CASE WHEN o_totalprice <= 100000 AND o_orderstatus = 'F' THEN 1 END) AS DOUBLE) AS a1,
                  CAST(sum(CASE WHEN o_totalprice <= 100000 AND o_orderstatus <> 'F' THEN 1 END) AS DOUBLE) AS a0,
                  CAST(sum(CASE WHEN o_totalprice > 100000 AND o_orderstatus = 'F' THEN 1 END) AS DOUBLE) AS b1,
                  CAST(sum(CASE WHEN o_totalprice > 100000 AND o_orderstatus <> 'F' THEN 1 END) AS DOUBLE) AS b0
           FROM orders)"""


def _newton_sql(rounds: int, k: int) -> str:
    """``nw``: Newton's method for ``tr`` (x: list of ``k`` values, the first 1; y), as one recursion over
    phases: 0 sums the weighted Gram matrix, the gradient and, to judge pivots by, the diagonal; 1 to ``k``
    eliminate a column; the last one adds the step."""
    def entry(a: int, b: int) -> str:
        return f"sum(p * (1 - p) * x[{a}] * x[{b}])"
    rows = ", ".join("[" + ", ".join([*(entry(a, b) for b in range(1, k + 1)), f"sum((y - p) * x[{a}])", entry(a, a)])
                     + "]" for a in range(1, k + 1))
    return f"""
nw(t, phase, beta, m) AS (
  SELECT 0, 0, [0.0::DOUBLE{", 0.0" * (k - 1)}], [[0.0::DOUBLE]]
  UNION ALL
  SELECT CASE WHEN phase = {k + 1} THEN t + 1 ELSE t END, CASE WHEN phase = {k + 1} THEN 0 ELSE phase + 1 END,
         CASE WHEN phase = {k + 1} THEN list_transform(range(1, {k + 1}), lambda i: beta[i] + m[i][{k + 1}]) ELSE beta END,
         CASE WHEN phase = 0 THEN sums WHEN phase = {k + 1} THEN m ELSE
           list_transform(range(1, {k + 1}), lambda i: list_transform(range(1, {k + 3}), lambda j:
             CASE WHEN j = {k + 2} THEN m[i][j]
                  WHEN m[phase][phase] <= {ml.ALIASED} * m[phase][{k + 2}] THEN CASE WHEN i = phase THEN 0.0 ELSE m[i][j] END
                  WHEN i = phase THEN m[i][j] / m[phase][phase]
                  ELSE m[i][j] - m[i][phase] * (m[phase][j] / m[phase][phase]) END)) END
  FROM (SELECT t, phase, beta, m, [{rows}] AS sums
        FROM (SELECT nw.*, x, y, 1 / (1 + exp(-list_inner_product(beta, x))) AS p
              FROM nw LEFT JOIN tr ON nw.phase = 0 WHERE nw.t < {rounds})
        GROUP BY t, phase, beta, m))"""


_TRAIN = f"substr(md5(CAST(doc_id AS VARCHAR) || ':10'), 1, 8) < '{int(round(0.9 * 2 ** 32)):08x}'"
_FIT = f"""
WITH RECURSIVE p AS MATERIALIZED (SELECT *, {_TRAIN} AS in_train FROM ({_PLAYERS})),
f AS (SELECT country, count(*) AS n FROM p WHERE in_train AND country IS NOT NULL GROUP BY country),
r AS (SELECT country, CAST(row_number() OVER (ORDER BY n DESC, country) - 1 AS DOUBLE) AS ci FROM f),
a AS (SELECT p.*, coalesce(r.ci, (SELECT CAST(count(*) AS DOUBLE) FROM f)) AS country_index
      FROM p LEFT JOIN r ON p.country = r.country),
s AS (SELECT {", ".join(f"stddev_samp({c}) AS s_{c}" for c in ["country_index", *_NUMERIC])} FROM a WHERE in_train),
z AS MATERIALIZED (
  SELECT doc_id, in_train, paid_customer AS y, [1.0, {", ".join(
      f"CASE WHEN coalesce(s_{c}, 0) = 0 THEN 0.0 ELSE {c} / s_{c} END" for c in ["country_index", *_NUMERIC])}] AS x
  FROM a CROSS JOIN s),
tr AS MATERIALIZED (SELECT x, y FROM z WHERE in_train),
{_newton_sql(5, len(_NUMERIC) + 2)},
scored AS (
  SELECT doc_id, y, 1 / (1 + exp(-list_inner_product(beta, x))) AS p
  FROM z CROSS JOIN (SELECT beta FROM nw WHERE t = 5) WHERE NOT in_train)"""

_FEATS = ", ".join(f"round({c}, 6) AS {c}" for c in PLAYER_FEATURES)
_STDS = ", ".join(f"stddev_samp({c}) AS s_{c}" for c in PLAYER_FEATURES)
_SCALED = ", ".join(
    f"round(CASE WHEN coalesce(s_{c}, 0) = 0 THEN 0.0 ELSE {c} / s_{c} END, 6) AS {c}"
    for c in PLAYER_FEATURES)

ORACLE_SQL: dict[str, str] = {
    "count_by_key": """
SELECT l_suppkey, count(*) AS "count" FROM lineitem GROUP BY l_suppkey""",
    "filter_project": f"""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderstatus = '{URGENT_FILTER[0]}' AND o_orderpriority = '{URGENT_FILTER[1]}'""",
    "filtered_max": """
SELECT max(l_extendedprice) AS max_extendedprice FROM lineitem
WHERE month(l_shipdate) BETWEEN 1 AND 3""",
    "anti_lookup": """
SELECT DISTINCT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o
                  WHERE o.o_orderstatus = 'F' AND o.o_custkey = c.c_custkey)""",
    "route_counts": f"""
SELECT n.n_name, count(*) AS Num
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
     JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderstatus = '{URGENT_FILTER[0]}' AND o.o_orderpriority = '{URGENT_FILTER[1]}'
GROUP BY n.n_name""",
    "two_sided_mean": """
WITH u AS (SELECT l_suppkey AS k, l_quantity AS v, 1 AS a, 0 AS b FROM lineitem
           UNION ALL
           SELECT l_partkey, l_tax, 0, 1 FROM lineitem)
SELECT k AS "key", round(avg(v), 6) AS mean_value FROM u WHERE k IS NOT NULL
GROUP BY k HAVING max(a) = 1 AND max(b) = 1""",
    "domestic_mean": f"""
WITH a AS (SELECT s_suppkey AS k FROM supplier JOIN nation ON s_nationkey = n_nationkey
           WHERE n_regionkey = {DOMESTIC_REGION}),
f AS (SELECT l_suppkey, l_orderkey % 100 AS dest, l_quantity, l_tax FROM lineitem
      WHERE l_suppkey IN (SELECT k FROM a) AND l_orderkey % 100 IN (SELECT k FROM a)),
u AS (SELECT l_suppkey AS k, l_quantity AS v, 1 AS a, 0 AS b FROM f
      UNION ALL SELECT dest, l_tax, 0, 1 FROM f)
SELECT k AS "key", round(avg(v), 6) AS mean_value FROM u
GROUP BY k HAVING max(a) = 1 AND max(b) = 1""",
    "median": """
SELECT round(quantile_cont(l_quantity, 0.5), 6) AS median_quantity FROM lineitem""",
    "p95": """
SELECT round(quantile_cont(l_extendedprice, 0.95), 6) AS p95_extendedprice FROM lineitem""",
    "semi_filter": f"""
SELECT l_returnflag, count(*) AS "count" FROM lineitem l
WHERE EXISTS (SELECT 1 FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
              JOIN region r ON n.n_regionkey = r.r_regionkey
              WHERE r.r_name = '{REGION}' AND s.s_suppkey = l.l_suppkey)
  AND EXISTS (SELECT 1 FROM part p WHERE p.p_size > {PART_SIZE_OVER} AND p.p_partkey = l.l_partkey)
GROUP BY l_returnflag""",
    "bloom_semi_filter": f"""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE EXISTS (
  SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderpriority = '{URGENT_FILTER[1]}')""",
    "conditional_share": f"""
SELECT n.n_name, r.r_name,
       round(sum(CASE WHEN o.o_orderstatus = 'F' AND o.o_custkey % {SHARE_KEY_MODULUS} = 0
                 THEN 1 ELSE 0 END) / count(*), 9) AS percentage
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
     JOIN nation n ON c.c_nationkey = n.n_nationkey
     JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY n.n_name, r.r_name
HAVING sum(CASE WHEN o.o_orderstatus = 'F' AND o.o_custkey % {SHARE_KEY_MODULUS} = 0
           THEN 1 ELSE 0 END) > 0""",
    "least_squares": """
WITH p AS (SELECT CAST(l_quantity AS DOUBLE) AS x, avg(l_extendedprice) AS y
           FROM lineitem WHERE l_quantity >= 0 GROUP BY l_quantity)
SELECT round(CASE WHEN regr_count(y, x) >= 2 THEN regr_intercept(y, x)
                  ELSE CAST(0 AS DOUBLE) END, 4) AS intercept,
       round(CASE WHEN regr_count(y, x) >= 2 THEN regr_slope(y, x)
                  ELSE CAST(0 AS DOUBLE) END, 4) AS slope
FROM p""",
    "moving_average": """
WITH d AS (SELECT CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS s, count(l_quantity) AS c
           FROM lineitem GROUP BY 1)
SELECT strftime(d, '%Y-%m-%d') AS "date",
       round(sum(s) OVER w / sum(c) OVER w, 9) AS moving_average
FROM d
WINDOW w AS (ORDER BY d RANGE BETWEEN INTERVAL 5 DAYS PRECEDING
                              AND INTERVAL 5 DAYS FOLLOWING)""",
    "moving_average_by_flag": """
WITH d AS (SELECT l_returnflag, CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS s,
                  count(l_quantity) AS c
           FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, strftime(d, '%Y-%m-%d') AS "date",
       round(sum(s) OVER w / sum(c) OVER w, 9) AS moving_average
FROM d
WINDOW w AS (PARTITION BY l_returnflag ORDER BY d
             RANGE BETWEEN INTERVAL 5 DAYS PRECEDING AND INTERVAL 5 DAYS FOLLOWING)""",
    "project_fields": "SELECT p_name AS name, p_brand AS country_code, p_size AS dem FROM part",
    "place_rows": """
SELECT CAST(s_suppkey AS INTEGER) AS geonameid, '"' || s_name AS name,
       CAST(s_nationkey AS VARCHAR) AS country_code, CAST(floor(s_acctbal) AS INTEGER) AS dem,
       CAST(s_suppkey % 90 AS DOUBLE) AS latitude, CAST(s_suppkey * 10 AS BIGINT) AS population,
       CAST(NULL AS VARCHAR) AS timezone
FROM supplier""",
    "filter_measure": f"SELECT CAST(p_size AS INTEGER) AS p_size FROM part WHERE p_brand = '{BRAND}'",
    "mean_measure": f"SELECT round(avg(p_size), 9) AS mean_size FROM part WHERE p_brand = '{BRAND}'",
    "word_count": """
SELECT w AS word, count(*) AS "count"
FROM (SELECT unnest(string_split(p_name, ' ')) AS w FROM part) t
WHERE w <> '' GROUP BY w""",
    "word_count_documents": """
SELECT w AS word, count(*) AS "count"
FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) t
WHERE w <> '' GROUP BY w""",
    "top1_with_lookup": """
WITH t AS (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY c_nationkey
           ORDER BY n DESC, k ASC NULLS LAST LIMIT 1)
SELECT coalesce((SELECT min(n_name) FROM nation WHERE n_nationkey = t.k), '') AS country
FROM t""",
    "count_within": f"""
SELECT count(*) AS n
FROM (SELECT c_name, CAST((c_custkey * 7) % 180 - 90 AS DOUBLE) AS lat,
             CAST((c_custkey * 13) % 360 - 180 AS DOUBLE) AS lon FROM customer) p
WHERE contains(lower(c_name), '{GEO_TERM}')
  AND {_hav_sql(*GEO_CENTER)} <= {GEO_RADIUS_KM}""",
    "radius_join": f"""
WITH s AS (SELECT s_suppkey, CAST((s_suppkey * 11) % 180 - 89.5 AS DOUBLE) AS lat0,
                  CAST((s_suppkey * 17) % 360 - 179.5 AS DOUBLE) AS lon0 FROM supplier),
c AS (SELECT c_custkey, CAST((c_custkey * 7) % 180 - 90 AS DOUBLE) AS lat,
             CAST((c_custkey * 13) % 360 - 180 AS DOUBLE) AS lon FROM customer),
d AS (SELECT s_suppkey, c_custkey, {_hav_sql("lat0", "lon0")} AS km FROM s CROSS JOIN c)
SELECT s_suppkey, c_custkey, round(km, 3) AS km FROM d WHERE km <= {GEO_RADIUS_KM}""",
    "moving_mean_events": f"""
SELECT DISTINCT epoch_us(ts) AS "at", round(sum(value) OVER w / count(value) OVER w, 9) AS moving_mean FROM events
WINDOW w AS (ORDER BY epoch_us(ts) RANGE BETWEEN {EVENT_REACH} PRECEDING AND {EVENT_REACH} FOLLOWING)""",
    "median_by_group": """
SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.5), 6) AS median_price FROM lineitem GROUP BY l_suppkey""",
    "edges_from_pairs": _EDGES,
    "triplets": f"""
SELECT src, CASE WHEN src % 2 = 0 THEN src * 3 + 1 ELSE 0 END AS src_attr,
       dst, CASE WHEN dst % 2 = 0 THEN dst * 3 + 1 ELSE 0 END AS dst_attr, weight
FROM ({_EDGES}) e""",
    "out_degree": f"SELECT src AS id, count(*) AS out_degree FROM ({_EDGES}) e GROUP BY src",
    "most_active": f"""
SELECT src AS id, count(*) AS out_degree FROM ({_EDGES}) e GROUP BY src
ORDER BY out_degree DESC, id LIMIT 1""",
    "pagerank": _ALL_RANKS + f"""
SELECT id, round(v, {PAGERANK_DIGITS}) AS rank FROM r WHERE i = (SELECT max(i) FROM r)""",
    "pagerank_top": _RANKS + """
SELECT id FROM r WHERE i = (SELECT max(i) FROM r) ORDER BY v DESC, id LIMIT 1""",
    "flight_rows": """
SELECT CAST(l_orderkey AS INTEGER) AS FlightNum, 'N' || l_suppkey AS TailNum,
       CAST(l_suppkey AS VARCHAR) AS Origin, CAST(l_partkey AS VARCHAR) AS Dest,
       CAST(trunc(l_quantity) AS INTEGER) AS Distance,
       CASE WHEN l_discount > 0 THEN l_linenumber END AS DepDelay,
       CAST(NULL AS INTEGER) AS ArrDelay
FROM lineitem""",
    "quarantine_rows": """
WITH t AS (
  SELECT *, l_orderkey % 11 AS k, l_orderkey || ',' || l_linenumber || ','
           || CASE WHEN l_orderkey % 11 = 3 THEN 'many' ELSE CAST(l_quantity AS VARCHAR) END || ','
           || CASE WHEN l_discount = 0 THEN 'NA' ELSE CAST(l_discount AS VARCHAR) END AS head
  FROM lineitem)
SELECT l_orderkey AS "key", l_linenumber AS number,
       CASE WHEN k NOT IN (1, 2, 3) THEN l_orderkey END AS l_orderkey,
       CASE WHEN k NOT IN (1, 2, 3) THEN l_linenumber END AS l_linenumber,
       CASE WHEN k NOT IN (1, 2, 3) THEN l_quantity END AS l_quantity,
       CASE WHEN k NOT IN (1, 2, 3) AND l_discount <> 0 THEN l_discount END AS l_discount,
       CASE WHEN k NOT IN (1, 2, 3) THEN l_returnflag END AS l_returnflag,
       CASE WHEN k IN (1, 2) THEN 'field count' WHEN k = 3 THEN 'l_quantity' END AS reason,
       CASE k WHEN 1 THEN head WHEN 2 THEN head || ',' || l_returnflag || ',more' WHEN 3 THEN head || ',' || l_returnflag
         END AS raw
FROM t""",
    "csv_na_roundtrip": """
SELECT l_orderkey, l_linenumber, l_quantity,
       CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS l_discount, l_returnflag
FROM lineitem""",
    "player_convert": f"""
SELECT gender, age, country, friend_count, lifetime, game1, game2, game3, game4, paid_customer
FROM ({_PLAYERS}) p""",
    "hash_split": f"""
SELECT d.doc_id,
       CASE WHEN substr(md5(CAST(d.doc_id AS VARCHAR) || ':{SPLIT_SEED}'), 1, 8)
                 < '{int(round(SPLIT_WEIGHTS[0] * 2 ** 32)):08x}'
            THEN 'train' ELSE 'test' END AS split
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "exact_split": f"""
WITH h AS (SELECT doc_id, lang, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':{SPLIT_SEED}'), 1, 13)
                                AS BIGINT) AS v FROM documents),
k AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY v, doc_id NULLS FIRST) AS r,
             count(*) OVER (PARTITION BY lang) AS n FROM h)
SELECT doc_id, lang, CASE WHEN r <= floor(n * {SPLIT_WEIGHTS[0]} + 0.5) THEN 'train' ELSE 'test' END AS split
FROM k""",
    "category_index": _index_sql("documents", "doc_id", "lang", "lang_index"),
    "category_index_brand": _index_sql("part", "p_partkey", "p_brand", "brand_index"),
    "category_index_distributed": """
WITH f AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang),
r AS (SELECT lang, CAST(row_number() OVER (ORDER BY n DESC, lang) - 1 AS DOUBLE) AS ix FROM f)
SELECT d.doc_id, d.lang, r.ix AS lang_index FROM documents d LEFT JOIN r ON d.lang = r.lang""",
    "assemble": _INDEXED_PLAYERS + f"\nSELECT doc_id, {_FEATS} FROM a",
    "scale": _INDEXED_PLAYERS + f", s AS (SELECT {_STDS} FROM a)\n"
                                f"SELECT doc_id, {_SCALED} FROM a CROSS JOIN s",
    # area under the curve as the rank sum, tied scores sharing their mean rank
    "evaluate_scores": """
WITH t AS (SELECT CAST(l.quality AS DOUBLE) AS y, CAST(d.n_chars % 1009 AS DOUBLE) AS s
           FROM documents d JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL),
k AS (SELECT y, s, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r,
             rank() OVER (ORDER BY s > 500) + (count(*) OVER (PARTITION BY s > 500) - 1) / 2.0 AS h
      FROM t),
c AS (SELECT sum(y) AS p, count(*) - sum(y) AS q, sum(y * r) AS sr, sum(y * h) AS sh,
             avg(CASE WHEN (s > 500) = (y = 1) THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n
      FROM k)
SELECT round((sr - p * (p + 1) / 2) / (p * q), 9) AS auc,
       round((sh - p * (p + 1) / 2) / (p * q), 9) AS auc_hard, round(accuracy, 9) AS accuracy, n
FROM c""",
    "fit_predict": _FIT + """
SELECT doc_id, y AS paid_customer, CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
       round(p, 6) AS p_positive FROM scored""",
    "evaluate": _FIT + """,
k AS (SELECT y, p, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS r,
             rank() OVER (ORDER BY p > 0.5) + (count(*) OVER (PARTITION BY p > 0.5) - 1) / 2.0 AS h FROM scored),
c AS (SELECT sum(y) AS a, count(*) - sum(y) AS b, sum(y * r) AS sr, sum(y * h) AS sh,
             avg(CASE WHEN (p > 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n FROM k)
SELECT round((sr - a * (a + 1) / 2) / (a * b), 9) AS auc, round((sh - a * (a + 1) / 2) / (a * b), 9) AS auc_hard,
       round(accuracy, 9) AS accuracy, n FROM c""",
    "logistic_fit": _LOGIT + """
SELECT round(ln(a1 / a0), 4) AS intercept,
       round(ln(b1 / b0) - ln(a1 / a0), 4) AS coefficient FROM c""",
    "logistic_predict": _LOGIT + """
SELECT o_orderkey, CAST(CASE WHEN o_totalprice > 100000 THEN b1 > b0 ELSE a1 > a0 END AS DOUBLE)
         AS prediction,
       round(CASE WHEN o_totalprice > 100000 THEN b1 / (b0 + b1) ELSE a1 / (a0 + a1) END, 4)
         AS p_positive
FROM orders CROSS JOIN c""",
}

ORACLE_SQL |= {
    # the same questions as over the source tables
    "route_counts_kept": ORACLE_SQL["route_counts"],
    "conditional_share_kept": ORACLE_SQL["conditional_share"],
    "catalog_tables": """
SELECT 'aloft_orders' AS name, true AS present, count(*) AS n, count(DISTINCT o_custkey) AS n_keys FROM orders
UNION ALL SELECT 'aloft_nothing', false, NULL, NULL""",
    "carrier_rows": """
SELECT 'S' || s_suppkey AS Code, s_name || ', Inc. (est. 1990)' AS Description FROM supplier""",
    "airport_rows": f"""
SELECT CAST(c_custkey AS VARCHAR) AS iata, c_name || ', Field' AS airport, n_name AS city,
       CASE WHEN c_custkey % 3 > 0 THEN 'S' || c_nationkey END AS state,
       CASE WHEN n_regionkey = {DOMESTIC_REGION} THEN 'USA' ELSE 'NA' END AS country,
       CASE WHEN c_custkey % 5 > 0 THEN CAST(c_custkey % 180 AS DOUBLE) - 90.25 END AS lat,
       CAST(c_custkey % 360 - 180 AS DOUBLE) AS long
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "country_code_rows": """
SELECT upper(left(lower(n_name), 1)) || substr(lower(n_name), 2) || ', Republic of' AS Name,
       CASE WHEN n_nationkey = 7 THEN 'NA' ELSE left(n_name, 2) END AS Code
FROM nation""",
}
