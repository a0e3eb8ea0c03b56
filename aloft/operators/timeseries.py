"""Calendar moving average."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aloft.constants import MOVING_AVERAGE_DAYS


def moving_average(df: DataFrame, date: Column, value: str, days: int = MOVING_AVERAGE_DAYS,
                   partition_cols: list[str] | None = None, date_col: str = "date",
                   out_col: str = "moving_average") -> DataFrame:
    """Mean of ``value`` over the calendar days ``[d - days, d + days]`` for
    every day ``d`` that has rows, weighted by row count (sum / count), with
    the day as a ``yyyy-MM-dd`` string, ordered by day.

    Rows are first reduced to one (sum, count) per day with partial
    aggregation, so the window only ever sees one row per day (per series):
    its input is bounded by the calendar, not by the data volume.  The frame
    is a RANGE over the day number, so missing days do not shift it.  For many
    independent series pass ``partition_cols`` and the window is distributed
    by series.
    """
    parts = list(partition_cols or [])
    daily = (df.groupBy(*parts, date.alias("__d"))
             .agg(F.sum(F.col(value).cast("double")).alias("__s"),
                  F.count(F.col(value)).alias("__c")))
    w = (Window.partitionBy(*parts).orderBy(F.unix_date("__d"))
         .rangeBetween(-days, days))
    return (daily.select(*parts, F.date_format("__d", "yyyy-MM-dd").alias(date_col),
                         F.try_divide(F.sum("__s").over(w), F.sum("__c").over(w)).alias(out_col))
            .orderBy(*parts, date_col))


def range_mean(df: DataFrame, at: Column, value: str, reach: int, partition_cols: list[str] | None = None,
               width: int | None = None, at_col: str = "at", out_col: str = "mean") -> DataFrame:
    """W01 at any time step: for each series and each instant that has rows, the mean of ``value`` over the
    instants in ``[at - reach, at + reach]`` (``at``: a whole number, such as microseconds).

    Rows are first reduced to one (sum, count) per instant, so an instant that holds much of the table is a
    row per task.  Time is cut into blocks as long as a frame, so a frame is the end of one block and the start
    of the next: two running sums, one of them over mirrored time, give every mean with work that does not
    depend on how many instants a frame holds, and nothing is subtracted.  No task orders the
    whole time line or a block: a running sum is one within a cell of ``width`` (a 64th of a block unless
    given) and one over the totals of the block's cells."""
    parts, span = list(partition_cols or []), 2 * reach + 1
    width = width or -(-span // 64)
    instants = (df.where(at.isNotNull()).groupBy(*parts, at.cast("long").alias("__at"))
                .agg(F.sum(F.col(value).cast("double")).alias("__s"), F.count(F.col(value)).alias("__c")))
    # one column for the series, which joins as it groups where a part is null
    instants = instants.select((F.struct(*parts) if parts else F.lit(0)).alias("__series"), "__at", "__s", "__c")

    def row(side: int, t: Column, asks: bool) -> Column:
        of = {"asks": F.col("__at") if asks else F.lit(None).cast("long"),
              "s": F.lit(None).cast("double") if asks else F.col("__s"), "c": F.lit(0).cast("long") if asks else F.col("__c")}
        return F.struct(F.lit(side).alias("__side"), t.alias("__t"), *[v.alias(f"__{k}") for k, v in of.items()])
    start, end = F.col("__at") - reach, F.col("__at") + reach
    # side 1 runs forward, side -1 backward; a frame that is a whole block needs no second part
    rows = F.array(row(-1, F.col("__at"), False), row(1, F.col("__at"), False), row(-1, start, True),
                   F.when(F.pmod(start, F.lit(span)) != 0, row(1, end, True)))
    in_block = F.pmod("__t", F.lit(span))
    dealt = (instants.select("__series", F.explode(rows).alias("r")).where(F.col("r").isNotNull())
             .select("__series", "r.*")
             .select("__series", "__side", (F.col("__t") - in_block).alias("__block"),
                     (F.col("__side") * F.floor(in_block / F.lit(width))).alias("__cell"),
                     (F.col("__side") * F.col("__t")).alias("__o"), "__asks", "__s", "__c"))
    block = ["__series", "__side", "__block"]
    totals = dealt.groupBy(*block, "__cell").agg(F.sum("__s").alias("__cs"), F.sum("__c").alias("__cc"))
    before = Window.partitionBy(*block).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*block, "__cell", F.sum("__cs").over(before).alias("__bs"), F.sum("__cc").over(before).alias("__bc"))
    so_far = (Window.partitionBy(*block, "__cell").orderBy("__o")
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    zero = F.lit(0)
    found = (dealt.join(totals, [*block, "__cell"])
             .withColumn("__ps", F.coalesce(F.sum("__s").over(so_far), zero) + F.coalesce("__bs", zero))
             .withColumn("__pc", F.sum("__c").over(so_far) + F.coalesce("__bc", zero))
             .where(F.col("__asks").isNotNull()))
    return (found.groupBy("__series", "__asks")
            .agg(F.try_divide(F.sum("__ps"), F.sum("__pc")).alias(out_col))
            .select(*[F.col("__series")[p].alias(p) for p in parts], F.col("__asks").alias(at_col), out_col))
