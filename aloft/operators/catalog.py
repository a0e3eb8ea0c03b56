"""Catalog tables bucketed by join key, written once and used by many queries.

A table kept by key is two catalog tables: ``rows``, bucketed and sorted by the key, so that grouping it or joining
it with another one on the key shuffles neither; and ``hot``, the rows of the keys that hold more than an even share
of a bucket, unbucketed, so that no task reads a whole hot key.  There are fewer hot keys than buckets, which
bounds what a query makes of them per key.  A null key is a key like any other.

The names in the catalog hold a fingerprint of the source files (path, size and time of change), so a changed source is
written anew and an unchanged one is found again.  Column statistics of the key are computed for the optimiser.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aloft.session import require_checkpoint_dir, saved
from aloft.sources.readers import table_exists

#: a key of fewer rows is never hot
HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class KeyedTable:
    key: str
    rows: DataFrame
    hot: DataFrame

    def whole(self) -> DataFrame:
        """All rows, for uses that have nothing to do with the key."""
        return self.rows.unionByName(self.hot)


def fingerprint(df: DataFrame) -> str:
    """Of the files that ``df``, a plain scan, reads; no column is read for it."""
    files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    row = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))).first()
    return f"{row[0]}_{row[1] or 0}".replace("-", "m")


def _counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("__hot")).agg(F.count(F.lit(1)).alias("__n"))


def keyed_table(source: DataFrame, name: str, key: str, columns: list[str], buckets: int | None = None,
                hot_rows: int = HOT_ROWS) -> KeyedTable:
    """``columns`` of ``source`` (a scan of files) kept by ``key``, found in the catalog or written to it."""
    spark = source.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the layout is part of the name: another width or column list is another table
    layout = f"{key}|{','.join(columns)}|{buckets}|{hot_rows}"
    full = f"{name}_{fingerprint(source)}_{uuid.uuid5(uuid.NAMESPACE_OID, layout).hex[:12]}"
    parts = {part: f"{full}_{part}" for part in ("rows", "hot")}
    # "rows" is written last, so where it exists the other one is whole
    if not table_exists(spark, parts["rows"]):
        _write(source.select(*columns), parts, key, buckets, hot_rows)
    return KeyedTable(key, spark.table(parts["rows"]), spark.table(parts["hot"]))


def _write(df: DataFrame, names: dict[str, str], key: str, buckets: int, hot_rows: int) -> None:
    spark = df.sparkSession
    folder = f"{require_checkpoint_dir(spark)}/keyed-{uuid.uuid4().hex}"
    total = df.count()
    # more rows than an even share of a bucket: fewer keys than buckets, whatever the table
    hot = saved(_counts(df, key).where(F.col("__n") > max(total // buckets, hot_rows)).select("__hot"), "hot_keys")
    same = F.col(key).eqNullSafe(F.col("__hot"))
    spark.sql(f"DROP TABLE IF EXISTS `{names['hot']}`")  # of a write that was cut off
    (df.join(F.broadcast(hot), same, "left_semi").write.format("parquet").option("path", f"{folder}/hot")
     .saveAsTable(names["hot"]))
    (df.join(F.broadcast(hot), same, "left_anti").repartition(buckets, key).write.format("parquet")
     .bucketBy(buckets, key).sortBy(key).option("path", f"{folder}/rows").saveAsTable(names["rows"]))
    for name in names.values():
        spark.sql(f"ANALYZE TABLE `{name}` COMPUTE STATISTICS FOR COLUMNS `{key}`")


def joined_totals(fact: KeyedTable, dim: KeyedTable, totals: dict[str, Column]) -> DataFrame:
    """``totals`` (aggregates of fact columns) of every fact key that the dimension has, beside the dimension's row.

    The bucketed halves are grouped and joined where they lie.  Hot fact keys are combined map-side and broadcast:
    they are fewer rows than the table has buckets.  A dimension may repeat a key; null keys join nothing."""
    def per_key(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col(fact.key).alias("__k")).agg(*[c.alias(n) for n, c in totals.items()])

    def meet(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, left["__k"] == right[dim.key]).drop("__k")

    cold, hot = per_key(fact.rows), F.broadcast(per_key(fact.hot))
    out = meet(cold, dim.rows).unionByName(meet(hot, dim.rows))
    if not dim.hot.isEmpty():  # keys that the dimension itself repeats very often
        out = out.unionByName(meet(cold, dim.hot)).unionByName(meet(hot, dim.hot))
    return out
