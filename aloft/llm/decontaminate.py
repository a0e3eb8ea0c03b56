"""Operator 10 [native]: benchmark decontamination by size-partitioned MinHash containment.

Short test items are sought inside long documents.  Texts are lower-cased (A-Z), words are
runs of anything but ASCII white space, shingles are ``shingle`` words (an item of fewer
words is one shingle of all its words, sought among document shingles of that length).

Jaccard-based MinHash fails here, because a document may hold a thousand times the shingles
of an item.  Containment needs only the item's own min-wise sample: items are partitioned by
the power of two above their size, and all items of a class are sketched by as many smallest
shingle hashes as the class's largest size asks for.  If an item of n shingles is
contained to a share t or more, at most m = n - ceil(t n) of its shingles are missing, so
at least (sketch length - m) sketch hashes occur in the document: the search loses nothing.
A pair that reaches this count is a candidate and is verified by exact comparison
of all shingles as text.

Everything is DataFrame work.  The documents are read once for the sketch search and only
candidate documents once more; the item side is broadcast if it is counted small enough,
else joined by shuffle with the same result.

Rows that share an id, null included, count as one document.  Null, empty and blank items
never match; a null text counts as empty; repeated item rows with one id count as one item
if their texts agree, else as the union of their shingles.  The word hashes of a very long text are one array
in its task, as are the shingles of a candidate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: rows of the item side (two longs or a shingle text each) up to which it is broadcast
BROADCAST_ROWS = 50_000


def _words(column):
    plain = F.translate(F.coalesce(column, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(plain, "[ \\t-\\r]+"), "")


def _shingles(words: str, length):
    """Array of shingle texts of the array column ``words``; null if it is too short."""
    return F.expr(f"if(size({words}) >= {length}, transform(sequence(1, size({words}) - {length} + 1),"
                  f" i -> array_join(slice({words}, i, {length}), ' ')), null)")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast behind a count; beyond it Spark joins by shuffle."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def item_shingles(items: DataFrame, item_col: str, text_col: str, shingle: int) -> DataFrame:
    """(item_id, length, shingle) without repeats."""
    words = items.select(F.col(item_col).alias("item_id"), _words(F.col(text_col)).alias("__w"))
    sized = (words.where(F.size("__w") > 0)
             .withColumn("length", F.least(F.size("__w"), F.lit(shingle))))
    return (sized.select("item_id", "length", F.explode(_shingles("__w", "length")).alias("shingle"))
            .distinct())


def sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """(item_id, n, least_hits, length, hash): the min-wise sample of each item."""
    hashed = shingles.withColumn(
        "hash", F.expr("xxhash64(transform(split(shingle, ' '), w -> xxhash64(w)))"))
    size = hashed.groupBy("item_id").agg(
        F.count("*").alias("n"),
        F.sort_array(F.collect_list(F.struct("hash", "length"))).alias("all"))
    need = F.ceil(F.lit(threshold) * F.col("n") - F.lit(1e-9))
    upper = F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("long")
    wide = F.least("n", upper - F.ceil(F.lit(threshold) * upper - F.lit(1e-9)) + 1)
    return (size.select("item_id", "n", "all", wide.cast("int").alias("length_of_sketch"),
                        (F.col("n") - need).alias("may_miss"))
            .select("item_id", "n", (F.col("length_of_sketch") - F.col("may_miss")).alias("least_hits"),
                    F.explode(F.slice("all", F.lit(1), F.col("length_of_sketch"))).alias("s"))
            .select("item_id", "n", "least_hits", F.col("s.length").alias("length"),
                    F.col("s.hash").alias("hash")))


def contamination(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """Pairs (id, item_id, n_shingles, n_common, containment) of containment ``threshold`` or
    more: the share of the item's distinct shingles that occur in the document."""
    wanted = saved(item_shingles(items, item_col, item_text_col, shingle), "item-shingles")
    lengths = sorted(r[0] for r in wanted.select("length").distinct().collect())  # 1..shingle
    source = docs.select(F.col(id_col).alias("__id"), _words(F.col(text_col)).alias("__w"))

    # search: which documents hold enough of an item's sketch
    sketch = _small(saved(sketches(wanted, threshold), "item-sketches"))
    hashed = source.select("__id", F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"))
    found = None
    for length in lengths:
        rows = (hashed.select("__id", F.explode(_hashes(length)).alias("hash"))
                .join(sketch.where(F.col("length") == length), "hash")
                .select("__id", "item_id", "n", "least_hits", "hash"))
        found = rows if found is None else found.union(rows)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], f"`{id_col}` {dict(docs.dtypes)[id_col]}, item_id {dict(items.dtypes)[item_col]}, "
                "n_shingles long, n_common long, containment double")
    candidates = saved(found.groupBy("__id", "item_id", "n", "least_hits")
                       .agg(F.count_distinct("hash").alias("hits"))
                       .where(F.col("hits") >= F.col("least_hits"))
                       .select("__id", "item_id", "n"), "candidates")

    # verification: exact shingles of the candidate documents alone
    ids = candidates.select(F.col("__id").alias("__c")).distinct()
    again = source.join(ids, F.col("__id").eqNullSafe(F.col("__c")), "left_semi")
    exact = _small(wanted)
    common = None
    for length in lengths:
        rows = (again.select("__id", F.explode(_shingles("__w", length)).alias("shingle"))
                .join(exact.where(F.col("length") == length), "shingle")
                .select("__id", "item_id", "length", "shingle"))
        common = rows if common is None else common.union(rows)
    counted = (common.distinct().groupBy("__id", "item_id").agg(F.count("*").alias("n_common"))
               .select(F.col("__id").alias("__d"), F.col("item_id").alias("__i"), "n_common"))
    return (candidates.join(counted, F.col("__id").eqNullSafe(F.col("__d"))
                            & F.col("item_id").eqNullSafe(F.col("__i")))
            .withColumn("containment", F.col("n_common") / F.col("n"))
            .where(F.col("n_common") >= F.ceil(F.lit(threshold) * F.col("n") - F.lit(1e-9)))
            .select(F.col("__id").alias(id_col), "item_id", F.col("n").alias("n_shingles"),
                    "n_common", "containment"))


def _hashes(length: int):
    """Hash of every run of ``length`` word hashes; Spark hashes an array like its elements
    given one by one, so this equals what ``sketches`` computes.  Null if there are too few."""
    parts = ", ".join(f"__h[i + {k}]" for k in range(length))
    return F.expr(f"if(size(__h) >= {length}, transform(sequence(0, size(__h) - {length}),"
                  f" i -> xxhash64({parts})), null)")


ORACLE = f"""
WITH w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[ \\t-\\r]+') IF x <> ''] AS ws
  FROM documents),
b AS (
  SELECT item_id, [x FOR x IN regexp_split_to_array(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[ \\t-\\r]+') IF x <> ''] AS ws
  FROM benchmark),
bs AS (
  SELECT DISTINCT item_id, l, array_to_string(ws[i:i + l - 1], ' ') AS s
  FROM (SELECT item_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i
        FROM (SELECT item_id, ws, least(len(ws), 5) AS l FROM b WHERE len(ws) > 0))),
n AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id),
ds AS (
  SELECT DISTINCT doc_id, l, array_to_string(ws[i:i + l - 1], ' ') AS s
  FROM (SELECT doc_id, ws, l, unnest(range(1, len(ws) - l + 2)) AS i
        FROM w, (SELECT DISTINCT l FROM bs) WHERE len(ws) >= l)),
c AS (
  SELECT ds.doc_id, bs.item_id, count(*) AS n_common
  FROM ds JOIN bs USING (l, s) GROUP BY ds.doc_id, bs.item_id)
SELECT c.doc_id, c.item_id, n.n AS n_shingles, c.n_common,
       c.n_common::DOUBLE / n.n AS containment
FROM c JOIN n USING (item_id) WHERE c.n_common >= ceil(0.8 * n.n - 1e-9)
"""
