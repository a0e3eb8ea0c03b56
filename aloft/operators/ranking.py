"""Distributed running totals over a global order.

An unpartitioned window would order every row in one task.  Here the rows
are range-partitioned on the order columns, each range computes its own
running total in its own task, and the per-range totals (one row per
partition) become offsets.  The range-partitioned input is written to the shared
checkpoint folder, so partition ids stay stable if a task is recomputed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aloft.session import saved


def ranged(df: DataFrame, order: list[Column], parts: int | None = None) -> DataFrame:
    """``df`` in value ranges, each with its number ``__pid`` (ascending), written once."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return saved(df.repartitionByRange(parts, *order)
                 .withColumn("__pid", F.spark_partition_id()), "ranged")


def running_total(df: DataFrame, order: list[Column], weight: Column, out_col: str,
                  parts: int | None = None) -> DataFrame:
    """``df`` plus ``out_col`` = sum of ``weight`` over all rows up to and
    including this one in ``order`` (which must be a total order for the
    result to be deterministic)."""
    b = ranged(df.withColumn("__w", weight), order, parts)
    totals = b.groupBy("__pid").agg(F.sum("__w").alias("__t"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__pid", F.coalesce(F.sum("__t").over(before), F.lit(0))
                            .alias("__off"))
    within = (Window.partitionBy("__pid").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # offsets has one row per partition: bounded by construction
    return (b.join(F.broadcast(offsets), "__pid")
            .withColumn(out_col, F.col("__off") + F.sum("__w").over(within))
            .drop("__pid", "__w", "__off"))
