"""Operator 13: source divergence audit by K-squared quadtrees over the group-term count matrix.

A group is a (language, source) pair.  Each language has a matrix of its sources by its kept terms
(those in at least ``least_docs`` of its documents); most cells of it are zero, and a zero cell of
a source always has the same smoothed probability.  The audit compares every source with every
other source of its language, over all kept terms, and with the language as a whole.

* Terms are counted in tasks over Arrow batches, combined before the shuffle, so a source or word
  that holds much of the table is a few rows per task.
* The columns of a matrix are dealt to blocks of about :data:`BLOCK` terms by hash and ordered in a
  block by how many sources hold them, which gathers the zeros; the rows are cut into tiles of
  :data:`TILE` sources.  Each task takes one block and one pair of tiles.
* A tile of a block is a strip of squares, each a quadtree that halves both sides (K = 2): a
  level keeps one bit for each quadrant, 0 where all of it is zero.  Two tiles are traversed jointly
  from the roots.  A pair of quadrants that are both zero is left at once, and its columns are
  priced as (number of columns) x (the price of two zero cells); any other pair is opened, down to
  leaves of :data:`LEAF` x :data:`LEAF` cells, where the exact prices are summed.  The task
  returns sums and numbers of columns seen at leaves; the zero columns, with those of blocks in
  which neither source has a term, are priced once for each pair in the end.

All arithmetic is on integers: probabilities are parts in 10^9 and prices floor((p-q)^2/q).

A null text, language or source counts as the empty string; a row without terms still makes its
group occur; a language without kept terms has pairs of value 0 and no ``term`` rows.  Every row is a document
of its own, repeated rows and null ids included (ids are not read).  Ties rank by the item's UTF-8
bytes.  Very long texts are split whole in a task.  An empty table gives an empty one.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aloft.llm.common import saved, ship, text_batches

#: parts that probabilities are counted in
ONE = 1_000_000_000
#: columns of a block, about; rows of a tile and cells on a side of a leaf (powers of two)
BLOCK, TILE, LEAF = 8_192, 32, 4
#: (group, term) counts that a task holds before it passes them on
HELD = 300_000
#: leaf triples evaluated at once
AT_ONCE = 20_000

#: letters A-Z to lower case, other ASCII but letters to a space, all else as it is
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
COUNTED = "lang string, source string, term string, n long, docs long"


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters, A-Z lower-cased."""
    return text.translate(_FOLD).split()


def count_terms(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term.  One more row a
    group has a null term, so that groups without terms are there too."""
    ship(docs.sparkSession)
    src = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(a)
                        for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])

    def rows(held: dict) -> pa.RecordBatch:
        langs, sources, terms, n, in_docs = [], [], [], [], []
        for (lang, source), (count, df) in held.items():
            langs += [lang] * (len(count) + 1)
            sources += [source] * (len(count) + 1)
            terms += [None, *count]
            n += [0, *count.values()]
            in_docs += [0, *(df[t] for t in count)]
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(sources, pa.string()),
             pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
             pa.array(in_docs, pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = defaultdict(lambda: (Counter(), Counter()))
        size = 0
        for batch in text_batches(batches, "text"):
            langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang, source, text in zip(langs, sources, batch.column(2).cast(pa.binary()), strict=True):
                found = Counter(terms_of(text.as_py()))
                count, in_docs = held[lang, source]
                size -= len(count)
                count.update(found)
                in_docs.update(found.keys())
                size += len(count)
                if size >= HELD:
                    yield rows(held)
                    held.clear()
                    size = 0
        if held:
            yield rows(held)

    return (src.mapInArrow(run, COUNTED).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def _share(count: str, total: str, kept: str) -> str:
    """SQL for 1 + floor(ONE * (count + 1) / (total + kept)), exact for counts of any size."""
    return (f"1 + cast(cast({count} + 1 AS DECIMAL(28, 0)) * {ONE} div ({total} + {kept}) AS BIGINT)")


def _price(p: str, q: str) -> str:
    """SQL for floor((p - q)^2 / q); p and q are at most ONE + 1, so the square fits a long."""
    return f"({p} - {q}) * ({p} - {q}) div {q}"


class Strip:
    """One tile of a block as quadtrees: ``p`` holds the cells, ``levels[i]`` one bit for each quadrant
    of 2^i leaves on a side.  A row number with column -1 gives that row's probability of a zero cell."""

    def __init__(self, row: np.ndarray, col: np.ndarray, p: np.ndarray, zero: np.ndarray, cols: int):
        zeros = np.ones(TILE, np.int64)
        zeros[row] = zero
        self.rows = int(row.max()) + 1 if len(row) else 0
        self.p = np.repeat(zeros[:, None], cols, axis=1)
        full = col >= 0
        self.p[row[full], col[full]] = p[full]
        some = np.zeros((TILE, cols), bool)
        some[row[full], col[full]] = True
        some = some.reshape(TILE // LEAF, LEAF, cols // LEAF, LEAF).any((1, 3))
        self.levels = [some]
        while len(some) > 1:
            some = some.reshape(len(some) // 2, 2, some.shape[1] // 2, 2).any((1, 3))
            self.levels.append(some)


def traverse(a: Strip, b: Strip, real: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Joint traversal of two strips of equal width, ``real`` of whose columns exist: for every pair of
    rows (i of a, j of b) the sum of prices of p_a against p_b at leaves, the same the other way round,
    and the number of columns seen at leaves."""
    there, back, seen = (np.zeros(len(a.p) * len(b.p), np.int64) for _ in range(3))
    top = len(a.levels) - 1
    c = np.arange(a.levels[top].shape[1])
    i = j = np.zeros(len(c), np.int64)
    for level in range(top, -1, -1):
        keep = a.levels[level][i, c] | b.levels[level][j, c]
        i, j, c = i[keep], j[keep], c[keep]
        if level:
            i, j, c = (np.concatenate([2 * x + (k >> bit & 1) for k in range(8)])
                       for x, bit in ((i, 2), (j, 1), (c, 0)))
    keep = (i * LEAF < a.rows) & (j * LEAF < b.rows)
    i, j, c = i[keep], j[keep], c[keep]
    lanes = np.arange(LEAF)
    for at in range(0, len(c), AT_ONCE):
        ri, rj, cc = (x[at:at + AT_ONCE, None] * LEAF + lanes for x in (i, j, c))
        one = a.p[ri[:, :, None], cc[:, None, :]][:, :, None, :]
        two = b.p[rj[:, :, None], cc[:, None, :]][:, None, :, :]
        exists = (cc < real)[:, None, None, :]
        square = (one - two) ** 2
        pair = (ri[:, :, None] * len(b.p) + rj[:, None, :]).ravel()
        np.add.at(there, pair, np.where(exists, square // two, 0).sum(3).ravel())
        if a is not b:
            np.add.at(back, pair, np.where(exists, square // one, 0).sum(3).ravel())
        np.add.at(seen, pair, np.broadcast_to(exists.sum(3), (len(ri), LEAF, LEAF)).ravel())
    return tuple(x.reshape(len(a.p), len(b.p)) for x in (there, back, seen))


def _pairs_of_block(key, table):
    """Sums for all pairs of sources of two tiles (or of one tile with itself) in one block of columns.
    Each source has a row without a column, which says the probability of its zero cells."""
    lang, _, first, second = (k.as_py() for k in key)
    gid, col, p, zero = (table.column(c).to_numpy() for c in ("gid", "col", "p", "zero"))
    real = int(table.column("cols")[0].as_py())
    strips = {}
    for tile in {first, second}:
        mine = gid // TILE == tile
        strips[tile] = Strip(gid[mine] % TILE, col[mine], p[mine], zero[mine], -(-real // TILE) * TILE)
    there, back, seen = traverse(strips[first], strips[second], real)
    i, j = np.nonzero(seen)
    g, h, n = first * TILE + i, second * TILE + j, seen[i, j]
    sums = there[i, j]
    if first != second:
        g, h, n = np.concatenate([g, h]), np.concatenate([h, g]), np.concatenate([n, n])
        sums = np.concatenate([sums, back[i, j]])
    return pa.table({"lang": pa.array([lang] * len(g), pa.string()), "g": g, "h": h, "priced": sums, "seen": n})


def audit(docs: DataFrame, *, least_docs: int = 3, most_terms: int = 200, text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): for each group the divergence from every other source of
    its language (``pair``) and the ``most_terms`` terms it overuses most (``term``)."""
    counts = saved(count_terms(docs, text_col=text_col, lang_col=lang_col, source_col=source_col),
                   "term-counts")
    found = counts.where(F.col("term").isNotNull())
    kept = saved(found.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"),
                                                   F.count("*").alias("sources"))
                 .where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    langs = langs.withColumn("blocks", F.ceil(F.col("kept") / BLOCK).cast("long"))
    in_block = Window.partitionBy("lang", "block")
    columns = (kept.join(langs, "lang").withColumn("block", F.expr("pmod(xxhash64(term), blocks)"))
               .withColumn("col", F.row_number().over(in_block.orderBy(F.desc("sources"), "term")) - 1)
               .withColumn("cols", F.count("*").over(in_block))
               .select("lang", "term", "block", "col", "cols",
                       F.expr(_share("lang_n", "lang_total", "kept")).alias("q")))
    columns = saved(columns, "term-columns")
    cells = saved(found.select("lang", "source", "term", "n").join(columns, ["lang", "term"]), "term-cells")

    # every group that occurs, numbered within its language
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (counts.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left")
              .join(langs.select("lang", "kept", "blocks"), "lang", "left")
              .fillna(0, ["total", "kept", "blocks"])
              .withColumn("gid", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
              .withColumn("tiles", F.expr(f"(count(*) OVER (PARTITION BY lang) + {TILE - 1}) div {TILE}"))
              .withColumn("zero", F.expr(f"if(kept = 0, 1, {_share('0', 'total', 'kept')})")))
    groups = saved(groups, "groups")
    priced = (cells.join(groups, ["lang", "source"])
              .withColumn("p", F.expr(_share("n", "total", "kept"))))

    # joint traversal, one task for a block and two tiles
    widths = columns.groupBy("lang", "block").agg(F.first("cols").alias("cols"))
    edges = (groups.join(widths, "lang")
             .select("lang", "block", "gid", F.lit(-1).alias("col"), "cols", F.lit(1).cast("long").alias("p"),
                     "zero", "tiles"))
    sent = (priced.select("lang", "block", "gid", "col", "cols", "p", "zero", "tiles").union(edges)
            .withColumn("tile", F.expr(f"gid div {TILE}"))
            .withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)")))
            .select("lang", "block", F.least("tile", "other").alias("first"),
                    F.greatest("tile", "other").alias("second"), "gid", "col", "cols", "p", "zero"))
    sums = (sent.groupBy("lang", "block", "first", "second")
            .applyInArrow(_pairs_of_block, "lang string, g long, h long, priced long, seen long")
            .groupBy("lang", "g", "h").agg(F.sum("priced").alias("priced"), F.sum("seen").alias("seen")))
    one = groups.select("lang", "source", "kept", F.col("gid").cast("long").alias("g"), F.col("zero").alias("p0"))
    two = groups.select("lang", F.col("source").alias("item"), F.col("gid").cast("long").alias("h"),
                        F.col("zero").alias("q0"))
    rest = f"(kept - coalesce(seen, 0)) * ({_price('p0', 'q0')})"
    pairs = (one.join(two, "lang").where("g <> h").join(sums, ["lang", "g", "h"], "left")
             .select("lang", "source", F.lit("pair").alias("part"), "item",
                     F.expr(f"coalesce(priced, 0) + {rest}").alias("value")))
    terms = (priced.where("p > q")
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     F.expr(_price("p", "q")).alias("value")))
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return (pairs.withColumn("rank", ranked)
            .union(terms.withColumn("rank", ranked).where(F.col("rank") <= most_terms)))


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
grp AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT id, lang, source,
        unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
q AS (SELECT lang, term, 1 + {ONE}::HUGEINT * (n + 1) // (total + v) AS q FROM kept JOIN v USING (lang)),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM grp LEFT JOIN c USING (lang, source) GROUP BY ALL),
m AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + {ONE}::HUGEINT * (coalesce(c.n, 0) + 1) // (g.total + v) AS p
  FROM g JOIN v USING (lang) JOIN kept ON kept.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pv AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM m a JOIN m b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
  FROM m JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 200
"""
