"""Operator 8: SimHash near-duplicates found with vantage-point trees.

Fingerprints: A-Z lower-cased, words are runs of anything but ASCII white space, shingles
of ``shingle`` words joined by one space, repeats included (a shorter text is one
shingle, a text without words has fingerprint zero).  A bit is 1 if it is set in
over half of the shingles' XXH64 values (seed 42).

Search: equal fingerprints collapse to one vertex first, so copies cost nothing.  A
vantage-point tree is built on a bounded sample of the distinct fingerprints; its leaves
are shards.  Every fingerprint has one home shard (by median distance to each vantage
point) and is also sent to those shards whose boundary its ball of ``max_bits`` overlaps:
if d(x, v) > mu + r, no point with d(y, v) <= mu can be within r of x.  In a shard, home
points are joined with all its points by further vantage points, in rings of the distance,
under the same triangle bound, down to small blocks that are compared exactly.  A shard
returns a spanning forest of its links, never all pairs of a group; components over
the forests of all shards come from :mod:`aloft.llm.components`.

The tree's sample and the shard size change the speed only: the pairs are exact for any tree.

Null or blank texts share fingerprint zero and are linked like any other.  Rows with a null
id take part; they get the component's smallest id (null if it has none).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import per_text, saved, ship
from aloft.llm.components import components, forest

SEED = 42
#: distinct fingerprints the shard tree is built on, at most
SAMPLE = 20_000
#: distinct fingerprints aimed at in a shard
SHARD = 10_000
#: largest number of comparisons of one exact block
BLOCK = 1 << 20


def fingerprint(text: str, shingle: int) -> int:
    """The 64-bit SimHash of one text, unsigned."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones = np.zeros(64, np.int64)
    total = len(words) - shingle + 1
    for at in range(0, total, 32768):
        part = words[at:min(at + 32768, total) + shingle - 1]
        h = np.array([digest(join(s), SEED) for s in zip(*(part[k:] for k in range(shingle)))],
                     ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """One row per row: the id and ``fp``, the fingerprint as a signed long."""
    def work(texts: list[str]) -> dict:
        fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
        return {"fp": pa.array(fps, pa.int64())}
    return per_text(docs, work, "fp long", id_col=id_col, text_col=text_col, out_id=id_col)


def _distance(points: np.ndarray, vantage) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(vantage)).astype(np.int16)


def shard_tree(sample: np.ndarray, depth: int, radius: int) -> list | int:
    """Nested [vantage, mu, near, far]; leaves are numbered from left to right.

    Of a few vantage candidates and cuts near the median, the one whose boundary
    (points within ``radius`` of the cut) holds the fewest sample points is taken.
    """
    counter = iter(range(1 << 30))

    def build(points: np.ndarray, level: int):
        if level == 0 or len(points) < 8:
            return next(counter)
        best = None
        for v in points[:: max(1, len(points) // 24)][:24]:
            d = _distance(points, v)
            for q in (0.35, 0.5, 0.65):
                mu = int(np.quantile(d, q))
                share = float((d <= mu).mean())
                if 0.2 <= share <= 0.8:
                    cost = float(((d > mu - radius) & (d <= mu + radius)).mean())
                    if best is None or cost < best[0]:
                        best = (cost, int(v), mu, d)
        if best is None:
            return next(counter)
        _, v, mu, d = best
        return [v, mu, build(points[d <= mu], level - 1), build(points[d > mu], level - 1)]

    return build(np.sort(sample), depth)


def route(points: np.ndarray, tree, radius: int):
    """Yields (shard, indices, is_home) for all points."""
    def walk(node, index, home):
        if not len(index):
            return
        if not isinstance(node, list):
            yield node, index, home
            return
        v, mu, near, far = node
        d = _distance(points[index], v)
        left, right = d <= mu + radius, d > mu - radius
        yield from walk(near, index[left], home[left] & (d[left] <= mu))
        yield from walk(far, index[right], home[right] & (d[right] > mu))
    yield from walk(tree, np.arange(len(points)), np.ones(len(points), bool))


def linked(points: np.ndarray, home: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest (i, j) of all links between a home point and any point of the shard."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def keep(i, j):
        nonlocal found, held
        found.append((i, j))
        held += len(i)
        if held > 4_000_000:
            found = [shrink()]
            held = len(found[0][0])

    def shrink():
        i = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64)
        j = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.int64)
        label = forest(i, j, len(points))
        k = np.flatnonzero(label != np.arange(len(points)))
        return k, label[k]

    def block(a, b):
        step = max(1, BLOCK // max(1, len(b)))
        for s in range(0, len(a), step):
            own = a[s:s + step]
            near = np.bitwise_count(points[own][:, None] ^ points[b][None, :]) <= radius
            i, j = np.nonzero(near)
            i, j = own[i], b[j]
            differ = i != j
            if differ.any():
                keep(i[differ], j[differ])

    def join(a, b, level):
        if not len(a) or not len(b):
            return
        if len(a) * len(b) <= BLOCK or level == 0:
            block(a, b)
            return
        v = points[a[len(a) // 2]]
        da, db = _distance(points[a], v), _distance(points[b], v)
        ring = da // (radius + 1)
        rings = np.unique(ring)
        if len(rings) == 1:
            block(a, b)
            return
        for r in rings:
            low, high = r * (radius + 1), r * (radius + 1) + radius
            join(a[ring == r], b[(db >= low - radius) & (db <= high + radius)], level - 1)

    join(np.flatnonzero(home), np.arange(len(points)), 12)
    return shrink()


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fps`` has one column fp of distinct signed longs.  Returns edges (u, v) whose
    components are those of all pairs at ``max_bits`` or fewer differing bits."""
    spark = fps.sparkSession
    ship(spark)
    n = fps.count()
    # smallest hash values: a sample that does not depend on partitioning
    sample = [r[0] for r in fps.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    depth = max(0, int(np.ceil(np.log2(max(1, n / SHARD)))))
    tree = shard_tree(np.array(sample, np.int64).view(np.uint64), depth, max_bits)

    def send(batches):
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, index, home in route(points, tree, max_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(index), shard), pa.int32()),
                     pa.array(points[index].view(np.int64)), pa.array(home)],
                    names=["shard", "fp", "home"])

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf["fp"].to_numpy()
        i, j = linked(values.view(np.uint64), pdf["home"].to_numpy(), max_bits)
        return pd.DataFrame({"u": values[i], "v": values[j]})

    sent = fps.mapInArrow(send, "shard int, fp long, home boolean")
    return sent.groupBy("shard").applyInPandas(search, "u long, v long")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id (smallest id
    reachable over links of ``max_bits`` or fewer differing bits, the own id included)."""
    made = saved(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle)
                 .withColumnRenamed(id_col, "__id"), "fingerprints")
    per_fp = made.groupBy("fp").agg(F.min("__id").alias("low"))
    groups = components(links(per_fp.select("fp"), max_bits))
    named = (per_fp.join(groups.withColumnRenamed("u", "fp"), "fp", "left")
             .select("fp", "low", F.coalesce("v", "fp").alias("group")))
    lowest = named.groupBy("group").agg(F.min("low").alias("component_id"))
    ids = named.join(lowest, "group").select("fp", "component_id")
    return (made.join(ids, "fp")
            .select(F.col("__id").alias(id_col),
                    F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
