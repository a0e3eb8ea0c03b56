"""Operator 5: approximate nearest neighbours by learned partitions.

On a bounded sample of distinct vectors (``SAMPLE``, by hash) the graph of nearest neighbours
(largest inner product) is cut into balanced parts by recursive spectral bisection, each
half refined by swaps that keep the balance.  A softmax classifier then learns, from
each vector, how its neighbours spread over the parts.  Every vector of the table is indexed
in its most probable part; a query visits its most probable parts, as many as held-out sample
queries need for a recall of ``TARGET``, and all vectors found there are ranked exactly.

Parts are searched ``TOGETHER`` at a time, so that a query yields one ranked list for several parts.
Equal vectors collapse to one indexed vector with its smallest ids (no more than k + 1 can ever
be returned), so a vector that holds a third of all rows costs one.  Groups of parts larger than
``BLOCK`` vectors are dealt in blocks, and so are more than ``QUERIES`` queries; each block of
queries meets each block of a group's vectors in a task of its own, which passes on the k best.

Vectors that are null, zero or hold null or non-finite components take no part, neither do
those whose length is not the commonest.  Rows that share an id count as one row, that with
the smallest vector.  Rows with a null id take no part, since they cannot be named.
An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aloft.llm.common import saved, ship

SAMPLE = 12_000
#: indexed vectors aimed at per part, and the most parts
PER_PART, MOST_PARTS = 800, 64
NEIGHBOURS = 12
TARGET = 0.93
BLOCK = QUERIES = 20_000
TOGETHER = 8


def nearest_graph(x: np.ndarray, k: int) -> np.ndarray:
    """(n, k) nearest others of each row by inner product."""
    out = np.empty((len(x), k), np.int64)
    for s in range(0, len(x), 1000):
        sim = x[s:s + 1000] @ x.T
        sim[np.arange(len(sim)), np.arange(s, s + len(sim))] = -np.inf
        out[s:s + 1000] = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    return out


def _bisect(nodes: np.ndarray, i: np.ndarray, j: np.ndarray, share: float,
            rng: np.random.Generator) -> np.ndarray:
    """True for ``share`` of the nodes, with few edges (i, j; local numbers) cut."""
    n = len(nodes)
    degree = np.bincount(i, minlength=n) + np.bincount(j, minlength=n) + 1.0
    v = rng.standard_normal(n)
    for _ in range(60):  # power iteration on the lazy walk, constant part taken out
        v -= (v * degree).sum() / degree.sum()
        v = 0.5 * v + 0.5 * (np.bincount(i, v[j], n) + np.bincount(j, v[i], n) + v) / degree
        v /= np.abs(v).max() or 1.0
    take = int(round(share * n))
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[:take]] = True
    for _ in range(8):  # swap as many as gain on both sides
        s = np.where(side, 1.0, -1.0)
        pull = (np.bincount(i, s[j], n) + np.bincount(j, s[i], n)) * -s  # > 0: better off over there
        a, b = np.flatnonzero(side & (pull > 0)), np.flatnonzero(~side & (pull > 0))
        m = min(len(a), len(b)) // 2
        if not m:
            break
        side[a[np.argsort(-pull[a], kind="stable")[:m]]] = False
        side[b[np.argsort(-pull[b], kind="stable")[:m]]] = True
    return side


def balanced_parts(graph: np.ndarray, parts: int) -> np.ndarray:
    """Part of each node: ``parts`` parts of nearly equal size."""
    n, k = graph.shape
    i, j = np.repeat(np.arange(n), k), graph.ravel()
    rng = np.random.default_rng(0)
    part = np.zeros(n, np.int64)

    def cut(nodes, first, count):
        if count == 1 or len(nodes) < 2:
            part[nodes] = first
            return
        local = np.full(n, -1)
        local[nodes] = np.arange(len(nodes))
        a, b = local[i], local[j]
        both = (a >= 0) & (b >= 0)
        left = count // 2
        side = _bisect(nodes, a[both], b[both], left / count, rng)
        cut(nodes[side], first, left)
        cut(nodes[~side], first + left, count - left)

    cut(np.arange(n), 0, parts)
    return part


@dataclass
class Router:
    """One hidden layer; probabilities over parts."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    @property
    def parts(self) -> int:
        return len(self.b2)

    def logits(self, x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        h = np.maximum((x / np.where(norm > 0, norm, 1)) @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def top(self, x: np.ndarray, m: int) -> np.ndarray:
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :m]


def fit_router(x: np.ndarray, target: np.ndarray, hidden: int = 128, rounds: int = 40) -> Router:
    """Softmax regression with one hidden layer on soft targets (n, parts); Adam on batches."""
    rng = np.random.default_rng(1)
    d, parts = x.shape[1], target.shape[1]
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    w = [rng.standard_normal((d, hidden)) * (2 / d) ** 0.5 * 2, np.zeros(hidden),
         rng.standard_normal((hidden, parts)) * hidden ** -0.5, np.zeros(parts)]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for r in range(rounds):
        order = rng.permutation(len(x))
        for s in range(0, len(x), 256):
            b = order[s:s + 256]
            pre = x[b] @ w[0] + w[1]
            h = np.maximum(pre, 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            g = (p / p.sum(axis=1, keepdims=True) - target[b]) / len(b)
            gh = (g @ w[2].T) * (pre > 0)
            step += 1
            for k, grad in enumerate((x[b].T @ gh + 1e-4 * w[0], gh.sum(0), h.T @ g + 1e-4 * w[2],
                                      g.sum(0))):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                w[k] -= 0.003 * (1 - r / rounds) * (m[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Router(*w)


def learn(sample: np.ndarray, parts: int, k: int) -> Router:
    """Fit the parts and the router; choose the number of probes on held-out sample rows."""
    d = sample.shape[1]
    if parts <= 1 or len(sample) < 200:
        return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    held = np.arange(len(sample)) % 10 == 0
    base = sample[~held]
    graph = nearest_graph(base, min(NEIGHBOURS, len(base) - 1))
    part = balanced_parts(graph, parts)
    target = np.zeros((len(base), parts))
    np.add.at(target, (np.repeat(np.arange(len(base)), graph.shape[1]), part[graph.ravel()]), 1.0)
    target[np.arange(len(base)), part] += 2.0
    target /= target.sum(axis=1, keepdims=True)
    router = fit_router(base, target)
    # recall of held-out queries over the sample, by number of probes
    own = router.top(base, 1)[:, 0]
    queries = sample[held]
    near = np.argsort(-(queries @ base.T), axis=1, kind="stable")[:, :k]
    order = router.top(queries, parts)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(len(queries), 0), axis=1)
    rank = np.take_along_axis(place, own[near], axis=1)  # the probe that finds each neighbour
    recall = np.array([(rank < m).mean() for m in range(1, parts + 1)])
    router.probes = int(np.argmax(recall >= TARGET)) + 1
    return router


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>): one row per id, of vectors that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = (table.select(F.col(id_col).alias("id"), v.alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull()))
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(finite & F.exists(v, lambda c: c != 0))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def dealt(queries: DataFrame, candidates: DataFrame, sizes: dict[int, int],
          asked: int) -> tuple[DataFrame, DataFrame]:
    """Both with columns block and query_block, such that each query meets every candidate of its
    group once.  ``sizes``: candidates of each group; ``asked``: queries in all."""
    # at most MOST_PARTS / TOGETHER entries
    blocks = F.create_map(*[F.lit(x).cast("int") for g, c in sizes.items()
                            for x in (g, -(-c // BLOCK))])[F.col("group")]
    query_blocks = max(1, -(-asked // QUERIES))
    queries = (queries.where(blocks.isNotNull())
               .withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
               .withColumn("query_block", F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).cast("int")))
    candidates = (candidates.withColumn("block", F.pmod(F.xxhash64("v"), blocks).cast("int"))
                  .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    return queries, candidates


def ranked(q: pd.DataFrame, c: pd.DataFrame, k: int) -> pd.DataFrame:
    """query_id, vec_id, score: the ``k`` best of ``c`` for each query, its own id left out."""
    qids, found, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    if len(q) and len(c):
        cv = np.array(c["v"].tolist())
        part = c["part"].to_numpy() % TOGETHER
        first = np.array([i[0] for i in c["ids"]])
        ids = c["ids"].tolist()
        qid, bits = q["query_id"].to_numpy(), q["bits"].to_numpy()
        most = min(k + 1, len(cv))
        for s in range(0, len(q), 500):
            qv = np.array(q["q"].iloc[s:s + 500].tolist())
            sim = qv @ cv.T
            sim[(bits[s:s + 500, None] >> np.arange(TOGETHER) & 1 == 0)[:, part]] = -np.inf
            cut = np.partition(sim, len(cv) - most, axis=1)[:, len(cv) - most]
            for a in range(len(qv)):
                slack = 1e-9 * max(1.0, abs(cut[a])) if np.isfinite(cut[a]) else 0.0
                near = np.flatnonzero((sim[a] >= cut[a] - slack) & (sim[a] > -np.inf))
                if not len(near):
                    continue
                score = (cv[near] * qv[a]).sum(axis=1)  # same order of sums for every row
                best = np.lexsort((first[near], -score))[:most]
                own = [ids[b] for b in near[best]]
                named = np.concatenate(own).astype(np.int64)
                score = np.repeat(score[best], [len(i) for i in own])
                other = named != qid[s + a]
                named, score = named[other], score[other]
                best = np.lexsort((named, -score))[:k]
                found.append(named[best])
                scores.append(score[best])
                qids.append(np.full(len(best), qid[s + a], np.int64))
    return pd.DataFrame({"query_id": np.concatenate(qids), "vec_id": np.concatenate(found),
                         "score": np.concatenate(scores)})


def search(table: DataFrame, *, k: int = 20, every: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding", parts: int | None = None) -> DataFrame:
    """Queries are the rows whose id is divisible by ``every``.  Returns query_id, rank,
    vec_id, score: the ``k`` nearest found of each query, its own row left out."""
    spark = table.sparkSession
    ship(spark)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = saved(valid_vectors(table, id_col, vector_col), "vectors")
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not dims:
        return empty
    rows = rows.where(F.size("v") == dims[0]["d"])
    # equal vectors: one, with its k + 1 smallest ids (limited in every map task first)
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    distinct = saved(rows.withColumn("n", place).where(F.col("n") <= k + 1)
                     .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")), "distinct")
    n = distinct.count()
    sample = distinct.orderBy(F.xxhash64("v"), F.col("ids")[0]).limit(SAMPLE).select("v").collect()
    router = learn(np.array([r["v"] for r in sample]),
                   parts or int(np.clip(n // PER_PART, 1, MOST_PARTS)), k)
    probes = router.probes

    def assign(batches):
        for batch in batches:
            x = np.array(batch.column(0).to_pylist())
            if len(x):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(router.top(x, 1)[:, 0].astype(np.int32)), batch.column(0),
                     batch.column(1)], names=["part", "v", "ids"])

    def visit(batches):
        for batch in batches:
            x = np.array(batch.column(1).to_pylist())
            if len(x):
                top = router.top(x, probes)
                # one row per group of parts, with a bit for each of its parts to be searched
                group = top // TOGETHER
                bits = np.zeros((len(x), -(-router.parts // TOGETHER)), np.int64)
                np.bitwise_or.at(bits, (np.arange(len(x))[:, None], group), 1 << (top % TOGETHER))
                row, col = np.nonzero(bits)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col.astype(np.int32)), pa.array(bits[row, col].astype(np.int32)),
                     batch.column(0).take(at), batch.column(1).take(at)],
                    names=["group", "bits", "query_id", "q"])

    indexed = saved(distinct.select("v", "ids")
                    .mapInArrow(assign, "part int, v array<double>, ids array<long>"), "index")
    group = F.floor(F.col("part") / TOGETHER).cast("int")
    sizes = {r["group"]: r["count"] for r in indexed.groupBy(group.alias("group")).count().collect()}
    asked = rows.where(F.col("id") % every == 0).select("id", "v")
    queries, candidates = dealt(
        asked.mapInArrow(visit, "group int, bits int, query_id long, q array<double>"),
        indexed.withColumn("group", group), sizes, asked.count())

    def rank(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        return ranked(q, c, k)

    keys = ["group", "block", "query_block"]
    found = (queries.groupBy(*keys).cogroup(candidates.groupBy(*keys))
             .applyInPandas(rank, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
