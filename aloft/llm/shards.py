"""Operator 11 [native]: sharding by proportional stratified interleaving.

Rows are put into a seeded random order within each source, and the row of rank r among the n of
its source gets the fractional rank (r + phase) / n, where the phase in [0, 1) is a seeded hash of
the source.  Sorting all rows by fractional rank spreads every source evenly over the whole order
(the phase keeps sources of few rows from crowding at one place), so equal cuts of that order hold
every source in its share, to within a few rows (about the square root of the number of sources).  Cutting by row number gives shard sizes at most
one row apart: the law is ``rows``.

Neither order is sorted in one place.  The seeded hash and the fractional rank are both spread
evenly, so each is cut into ranges of equal width; ranges are counted, ranges' offsets summed, and
rows numbered within their range.  Rows that agree in id, source and text cannot be told apart and
are counted before the first shuffle, so that repeated rows, null ids among them, make no range
hot; they are dealt out again in chunks of :data:`CHUNK` copies.

Everything is DataFrame work.  A null text has the size of the empty text, null sources are a
source of their own, null ids are ordered before others and repeated rows each get a slot.  An
empty table gives an empty one.  Long texts are only read for their length and hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aloft.llm.common import saved, shuffle_partitions

#: bytes that a row counts besides its text
ROW_BYTES = 16
#: rows numbered within one range, about
RANGE_ROWS = 50_000
#: copies of one row that are dealt out together
CHUNK = 10_000
SEED = 11
#: what makes two rows the same row
IDENTITY = ["id", "source", "size", "text_crc32", "text_hash"]


def _seeded(column: Column, seed: int, digits: int) -> Column:
    """The first hex digits of md5(seed:value) as a number, the same in any SQL engine."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def _before(offsets_of: DataFrame, keys: list[str], order: str, count: str, out: str) -> DataFrame:
    """``out`` = rows in earlier ranges, for a table of one row per range."""
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(order)
    return offsets_of.withColumn(out, F.coalesce(
        F.sum(count).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def _ranges(spark, rows: int) -> int:
    return max(2 * shuffle_partitions(spark), rows // RANGE_ROWS)


def _identity(id_col: str, text_col: str, source_col: str) -> list[Column]:
    """The columns of :data:`IDENTITY`."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.col(id_col).alias("id"), F.col(source_col).alias("source"),
            (F.octet_length(text).cast("long") + ROW_BYTES).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash")]


def _ranked(docs: DataFrame, seed: int, names: dict) -> tuple[DataFrame, int]:
    """Every row of ``docs`` (identity and copy number) with its ``rank`` from 0 among the ``n``
    of its source, and how many rows there are."""
    spark = docs.sparkSession
    kinds = saved(docs.select(*_identity(**names)).groupBy(*IDENTITY).agg(F.count("*").alias("copies"))
                  .withColumn("hash", _seeded(F.col("id"), seed, 15)), "shard-rows")
    kinds_n, total, most = kinds.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0)),
                                     F.coalesce(F.max("copies"), F.lit(0))).first()
    # 60 hash bits, of which the upper 32 choose the range
    cut = kinds.withColumn("range", F.shiftright(F.shiftright("hash", 28) * _ranges(spark, kinds_n), 32))
    counts = cut.groupBy("source", "range").agg(F.sum("copies").alias("in_range"))
    offsets = (_before(counts, ["source"], "range", "in_range", "earlier")
               .withColumn("n", F.sum("in_range").over(Window.partitionBy("source")))
               .select(F.col("source").alias("__s"), F.col("range").alias("__r"), "earlier", "n"))
    within = (Window.partitionBy("source", "range").orderBy("hash", *IDENTITY)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    kinds = (cut.join(offsets, F.col("source").eqNullSafe(F.col("__s")) & (F.col("range") == F.col("__r")))
             .withColumn("first", F.col("earlier") + F.sum("copies").over(within) - F.col("copies"))
             .select(*IDENTITY, "copies", "first", "n",
                     F.explode(F.expr(f"sequence(0L, copies - 1, {CHUNK}L)")).alias("chunk")))
    if most > CHUNK:  # the chunks of a much repeated row go to several tasks
        kinds = kinds.repartition(_ranges(spark, total), "first", "chunk")
    rows = (kinds.withColumn("copy", F.explode(F.expr(
        f"sequence(chunk, least(chunk + {CHUNK}, copies) - 1)")))
        .select(*IDENTITY, "copy", "n", (F.col("first") + F.col("copy")).alias("rank")))
    return rows, total


def interleave(docs: DataFrame, *, shards: int = 40, seed: int = SEED, id_col: str = "doc_id",
               text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, source, size, text_crc32, text_hash, copy, shard, slot
    (gapless from 0 in each shard)."""
    spark = docs.sparkSession
    names = {"id_col": id_col, "text_col": text_col, "source_col": source_col}
    rows, total = _ranked(docs, seed, names)
    ranges = _ranges(spark, total)
    phase = _seeded(F.col("source"), seed, 13) / F.lit(float(16 ** 13))
    placed = saved(rows.withColumn("place", (F.col("rank") + phase) / F.col("n"))
                   .withColumn("range", F.least(F.floor(F.col("place") * ranges), F.lit(ranges - 1)))
                   .drop("n"), "shard-places")
    counts = placed.groupBy("range").agg(F.count("*").alias("in_range"))
    offsets = _before(counts, [], "range", "in_range", "earlier").select("range", "earlier")
    within = Window.partitionBy("range").orderBy("place", "source", "rank")
    position = F.col("earlier") + F.row_number().over(within) - 1
    return (placed.join(offsets, "range").withColumn("position", position)
            .withColumn("shard", F.expr(f"position * {shards} div {total}"))
            .select(F.col("id").alias(id_col), "source", "size", "text_crc32", "text_hash", "copy",
                    F.col("shard").cast("int").alias("shard"),
                    F.expr(f"position - (shard * {total} + {shards - 1}) div {shards}").alias("slot")))


def write_shards(docs: DataFrame, path: str, *, shards: int = 40, seed: int = SEED,
                 id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> None:
    """Write the texts as Parquet files under ``path``/shard=N, in slot order within each shard.

    A repeated text is held once per chunk of copies in the join, so no key of it is hot."""
    names = {"id_col": id_col, "text_col": text_col, "source_col": source_col}
    placed = saved(interleave(docs, shards=shards, seed=seed, **names).withColumnRenamed(id_col, "id")
                   .withColumn("chunk", F.expr(f"copy div {CHUNK}")), "shard-slots")
    texts = (docs.select(*_identity(**names), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
             .groupBy(*IDENTITY).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
             .withColumn("chunk", F.explode(F.expr(f"sequence(0L, (copies - 1) div {CHUNK})"))))
    on = [F.col(f"p.{k}").eqNullSafe(F.col(f"t.{k}")) for k in [*IDENTITY, "chunk"]]
    (placed.alias("p").join(texts.alias("t"), on)
     .select(F.col("p.id").alias(id_col), F.col("p.source").alias("source"), F.col("t.text").alias("text"),
             F.col("p.shard").alias("shard"), F.col("p.slot").alias("slot"))
     .repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def _bit_remainders() -> list[int]:
    out = []
    for bit in range(8):
        c = 1 << bit
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        out.append(c)
    return out


def crc32_sql(text: str) -> str:
    """DuckDB expression for the CRC-32 (polynomial 0xEDB88320) of a string's UTF-8 bytes."""
    step = "acc >> 8"
    for bit, remainder in enumerate(_bit_remainders()):
        step = f"xor({step}, ((xor(acc, b) >> {bit}) & 1) * {remainder})"
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce({octets}, lambda acc, b: {step}, 4294967295::BIGINT), 4294967295)"


def _seeded_sql(value: str, digits: int) -> str:
    return f"('0x' || md5('{SEED}:' || coalesce({value}::VARCHAR, ''))[1:{digits}])::BIGINT"


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + {ROW_BYTES} AS size,
         {crc32_sql("coalesce(text, '')")} AS text_crc32, {_seeded_sql("doc_id", 15)} AS h
  FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id NULLS FIRST, size, text_crc32)
            - 1 AS rank, count(*) OVER (PARTITION BY source) AS n,
         {_seeded_sql("source", 13)} / 4503599627370496.0::DOUBLE AS phase FROM d),
p AS (
  SELECT *, row_number() OVER (ORDER BY (rank + phase) / n, source NULLS FIRST, rank) - 1 AS position,
         count(*) OVER () AS total FROM r),
s AS (SELECT *, position * 40 // total AS shard FROM p)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, position - (shard * total + 39) // 40 AS slot,
       NULL::INTEGER AS grown_shard, source
FROM s
"""
