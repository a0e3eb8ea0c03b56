"""Exact interpolated percentile (A06: Q08 median, Q09 95th percentile).

Spark's ``percentile`` aggregate is exact but its final merge holds every
distinct value of the column in one task, which does not scale to a
high-cardinality column over a whole table.  This operator gives the same
answer (linear interpolation between the values at 0-based ranks
``floor(p * (n - 1))`` and ``ceil(p * (n - 1))``, NULLs ignored):

1. one scan counts rows per distinct value (ties combine map-side) and deals the values to
   ranges, written to the shared folder;
2. the row total of each range (one number per range) says which range holds a rank;
3. the lazy result reads those one or two ranges and counts up inside them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from aloft.operators.ranking import ranged
from aloft.session import saved

#: ranges that a group's interval is cut into in a round
BINS = 1024


def exact_percentile(df: DataFrame, value_col: str, p: float, out_col: str) -> DataFrame:
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be in [0, 1]")
    counts = (df.select(F.col(value_col).cast("double").alias("v")).where(F.col("v").isNotNull())
              .groupBy("v").agg(F.count(F.lit(1)).alias("c")))
    b = ranged(counts, [F.col("v")])
    # one row per range: as many as shuffle partitions
    totals = {r["__pid"]: r["t"] for r in b.groupBy("__pid").agg(F.sum("c").alias("t")).collect()}
    n = sum(totals.values())
    if n == 0:
        schema = StructType([StructField(out_col, DoubleType(), True)])
        return df.sparkSession.createDataFrame([(None,)], schema)
    pos = p * (n - 1)
    lo_rank, hi_rank = math.floor(pos), math.ceil(pos)
    before, wanted = 0, {}
    for pid in sorted(totals):
        if before <= hi_rank and before + totals[pid] > lo_rank:
            wanted[pid] = before
        before += totals[pid]
    offset = F.create_map(*[F.lit(x) for kv in wanted.items() for x in kv])[F.col("__pid")]
    # rows holding value v occupy global ranks [cum - c, cum)
    within = (Window.partitionBy("__pid").orderBy("v")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (b.where(F.col("__pid").isin(*wanted))
              .select("v", "c", (offset + F.sum("c").over(within)).alias("cum")))

    def at(r):
        return F.min(F.when((F.col("cum") - F.col("c") <= r) & (F.lit(r) < F.col("cum")),
                            F.col("v")))

    picks = ranked.agg(at(lo_rank).alias("lo_v"), at(hi_rank).alias("hi_v"))
    return picks.select((F.col("lo_v") + F.lit(pos - lo_rank) * (F.col("hi_v") - F.col("lo_v")))
                        .alias(out_col))


def builtin_percentile(df: DataFrame, value_col: str, p: float, out_col: str) -> DataFrame:
    """Spark's exact ``percentile``: fine for low-cardinality columns (integer
    minutes or miles), where the distinct-value map stays small."""
    return df.agg(F.percentile(F.col(value_col), F.lit(p)).alias(out_col))


def select_ranks(rows: DataFrame, place) -> DataFrame:
    """The value at a rank of every group, by repeated histograms: ``rows`` has columns ``__key`` (a struct)
    and ``v`` (double, nulls ignored); ``place`` is the 0-based rank, rounded down, as a column over ``n``, the
    values of the group.  Gives (__key, lo, n, place, below, inside): the value, and how many values of the
    group are less and equal.

    All groups go on at once: a round counts each group's values in :data:`BINS` equal ranges of its interval
    (combined map-side, so a group that holds much of the table is a few rows a task) and keeps
    the range in which the rank falls, shrunk to the values it holds, until that is a single
    value.  Rows outside their group's interval take no part in later rounds."""
    state = (rows.groupBy("__key").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n"))
             .withColumn("place", place)
             .withColumns({"below": F.lit(0).cast("long"), "inside": F.col("n")}))
    state = saved(state.select("__key", "lo", "hi", "n", "place", "below", "inside"), "selection")
    rows = rows.where(F.col("v").isNotNull())
    found = state.where("lo IS NULL OR lo = hi")
    open_ = state.where("lo <> hi")
    while open_.limit(1).count():
        # NaN is the largest value; infinite ends are cut where finite values end
        low, high = (F.greatest(F.lit(-1.7e308), F.least(F.lit(1.7e308), F.col(c))) for c in ("lo", "hi"))
        share = F.try_divide(F.greatest(low, F.least(high, F.col("v"))) / 2 - low / 2, high / 2 - low / 2)
        bin_ = (F.when(F.isnan("v"), BINS + 2).when(F.col("v") == float("inf"), BINS + 1)
                .when(F.col("v") == float("-inf"), -1)
                .otherwise(F.coalesce(F.floor(share * BINS), F.lit(0))))
        counts = (rows.join(open_, "__key").where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
                  .groupBy("__key", "n", "place", "below", bin_.alias("bin"))
                  .agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("inside")))
        before = F.sum("inside").over(Window.partitionBy("__key").orderBy("bin")
                                      .rowsBetween(Window.unboundedPreceding, -1))
        state = saved(counts.withColumn("below", F.col("below") + F.coalesce(before, F.lit(0)))
                      .where((F.col("below") <= F.floor("place")) & (F.floor("place") < F.col("below") + F.col("inside")))
                      .select("__key", "lo", "hi", "n", "place", "below", "inside"), "selection")
        found = found.unionByName(state.where("lo = hi"))
        open_ = state.where("lo <> hi")
    return saved(found.drop("hi"), "selection")


def grouped_percentile(df: DataFrame, keys: list[str], value_col: str, p: float, out_col: str) -> DataFrame:
    """The exact interpolated percentile of every group (:func:`select_ranks`).  A last pass finds the next
    larger value for groups whose upper rank lies beyond the lower one's value.  Groups without values
    give null."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be in [0, 1]")
    names = [f"k{i}" for i in range(len(keys))]
    # groups as one column that is never null, to join on
    rows = saved(df.select(F.struct(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]).alias("__key"),
                           F.col(value_col).cast("double").alias("v")), "selection-rows")
    found = select_ranks(rows, F.lit(p) * (F.col("n") - 1))
    beyond = found.where("ceil(place) >= below + inside").select("__key", F.col("lo").alias("v_lo"))
    larger = (rows.join(beyond, "__key").where(F.col("v") > F.col("v_lo")).groupBy("__key").agg(F.min("v").alias("next")))
    return (found.join(larger, "__key", "left")
            .withColumn("up", F.coalesce("next", "lo"))
            .select(*[F.col(f"__key.{n}").alias(k) for k, n in zip(keys, names, strict=True)],
                    F.when(F.col("up") == F.col("lo"), F.col("lo"))
                    .otherwise(F.col("lo") + (F.col("place") - F.floor("place")) * (F.col("up") - F.col("lo")))
                    .alias(out_col)))
