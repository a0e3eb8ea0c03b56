"""Join helpers.  No size hints: Spark picks broadcast or shuffle from file statistics and,
at run time, from exchange sizes (AQE, which also splits skewed shuffle partitions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def anti_lookup(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str,
                select: list[str] | None = None, distinct: bool = True) -> DataFrame:
    """J02/U02 (Q05): rows of ``dim`` whose key never occurs in ``fact``.

    Equivalent to ``dim EXCEPT (dim JOIN fact ON dim_key = fact_key)``: a dim
    row with a NULL key never matches and is kept.  The fact side is reduced
    to its distinct non-NULL keys first (partial aggregation before the
    shuffle, so a key holding a third of the fact rows collapses map-side);
    the anti join then reuses that hash partitioning.  ``distinct`` applies
    EXCEPT's set semantics to the surviving rows only (distinct commutes with
    a row filter, so de-duplicating after the anti join is cheaper).
    """
    keys = (fact.select(F.col(fact_key).alias("__key"))
            .where(F.col("__key").isNotNull())
            .distinct())
    out = dim.join(keys, dim[dim_key] == keys["__key"], "left_anti")
    if distinct:
        out = out.distinct()
    return out.select(*select) if select else out


def semi_filter(df: DataFrame, key: str, allowed: DataFrame, allowed_key: str) -> DataFrame:
    """Keep rows whose ``key`` occurs in ``allowed`` (left semi join).

    Pass ``allowed`` as a filter or semi join of one table: its size estimate is then that
    table's, so a small one is broadcast and the fact stays where it was read (an
    inner join's estimate is the product of its sides and forces a shuffle)."""
    keys = allowed.select(F.col(allowed_key).alias("__ok"))
    return df.join(keys, F.col(key) == F.col("__ok"), "left_semi")


#: most words (of 64 bits) of a Bloom filter, which is broadcast: 16 MB with their numbers
BLOOM_WORDS = 1_000_000
#: bits that a key sets in its word
BLOOM_BITS = 5


def _bloom_mask(key: Column) -> Column:
    mask = F.lit(0).cast("long")
    for k in range(BLOOM_BITS):
        bit = F.xxhash64(key, F.lit(k)).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


def bloom_filter(df: DataFrame, key: str, allowed: DataFrame, allowed_key: str,
                 bits_per_key: int = 16) -> DataFrame:
    """The rows of ``df`` whose ``key`` may occur in ``allowed``: all that do, and few others.

    A blocked Bloom filter: each key has one word of 64 bits and sets :data:`BLOOM_BITS` bits in it.  The words
    are one grouped bitwise aggregate (combined map-side); at most :data:`BLOOM_WORDS` of them are broadcast,
    whatever the keys (a fuller filter lets more through), and ``df`` meets them where it was read."""
    keys = allowed.select(F.col(allowed_key).alias("__bk"))
    n = keys.agg(F.approx_count_distinct("__bk")).first()[0]
    words = int(min(BLOOM_WORDS, max(1, n * bits_per_key // 64)))
    slot = F.pmod(F.xxhash64("__bk"), F.lit(words))
    made = (keys.where(F.col("__bk").isNotNull()).groupBy(slot.alias("__word"))
            .agg(F.bit_or(_bloom_mask(F.col("__bk"))).alias("__bits")))
    # a semi join of its own: Spark would move a later one before an inner join
    mine = (F.pmod(F.xxhash64(key), F.lit(words)) == F.col("__word"))
    mask = _bloom_mask(F.col(key))
    return df.join(F.broadcast(made), mine & (F.col("__bits").bitwiseAND(mask) == mask), "left_semi")


def bloom_semi_filter(df: DataFrame, key: str, allowed: DataFrame, allowed_key: str,
                      bits_per_key: int = 16) -> DataFrame:
    """:func:`semi_filter` for an allowed set too large to broadcast: rows that a Bloom filter of it excludes
    are left out of the shuffle, the exact semi join does the rest.  Types of both keys must agree."""
    return semi_filter(bloom_filter(df, key, allowed, allowed_key, bits_per_key), key, allowed, allowed_key)


def triplets(vertices: DataFrame, edges: DataFrame, id_col: str = "id",
             attr_col: str = "attr", default_attr=None) -> DataFrame:
    """Each edge with the attributes of both end points.

    A vertex that only edges name has the attribute ``default_attr``; no edge is dropped.  If
    the vertex table is too large to broadcast, both joins shuffle and AQE's skew-join split
    handles a vertex owning a large share of the edges.
    """
    kind = vertices.schema[attr_col].dataType
    default = F.lit(default_attr).cast(kind)
    # a flag, because a listed vertex may have a NULL attribute of its own
    v = vertices.select(F.col(id_col).alias("__id"), F.col(attr_col).alias("__attr"),
                        F.lit(True).alias("__listed"))
    out = edges
    for end in ("src", "dst"):
        out = (out.join(v, F.col(end) == F.col("__id"), "left")
               .withColumn(f"{end}_attr", F.when(F.col("__listed"), F.col("__attr"))
                           .otherwise(default))
               .drop("__id", "__attr", "__listed"))
    return out.select("src", "src_attr", "dst", "dst_attr", "weight")
