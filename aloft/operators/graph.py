"""Social graph as two DataFrames.

GraphX has no Python API; a graph here is ``vertices(id)`` plus
``edges(src, dst, weight)`` with one edge per ordered pair and the pair's
multiplicity as weight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.constants import PAGERANK_RESET, PAGERANK_TOL
from aloft.session import bucketed, saved

#: targets in one adjacency row, about
CHUNK = 1024


def edges_from_pairs(pairs: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """A12 (Q19): one edge per ordered (src, dst) pair, weight = multiplicity.
    Stays distributed (a grouped count, combined map-side)."""
    return (pairs.groupBy(F.col(src).alias("src"), F.col(dst).alias("dst"))
            .agg(F.count(F.lit(1)).alias("weight")))


def vertices_of(edges: DataFrame) -> DataFrame:
    """Every id that is an end point of an edge (one pass over the
    edges: both end points are exploded from each row, then de-duplicated
    with map-side partial aggregation)."""
    return (edges.select(F.explode(F.array(F.col("src"), F.col("dst"))).alias("id"))
            .distinct())


def out_degree(edges: DataFrame) -> DataFrame:
    """Outgoing edges per vertex (distinct targets, weight ignored)."""
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))


def most_active(edges: DataFrame) -> DataFrame:
    """Q20: the vertex with the most outgoing edges; ties -> smallest id."""
    return out_degree(edges).orderBy(F.desc("out_degree"), F.asc("id")).limit(1)


class NotConverged(RuntimeError):
    """PageRank reached ``max_iter`` rounds before its tolerance."""


def store_adjacency(edges: DataFrame, vertices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The graph as two written tables that rounds of messages need not shuffle.

    The targets of a vertex lie in ``chunks`` rows of about :data:`CHUNK`, by target hash, so that a hub is
    many rows: (id, chunk, out array<id>, w) with the weight 1 / out-degree, bucketed and sorted by (id, chunk).
    The other table is (id, chunks, deg), both 0 for a sink."""
    deg = edges.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))
    deg = saved(deg.withColumn("chunks", F.ceil(F.col("deg") / CHUNK).cast("int")), "degrees")
    rows = (edges.join(deg, "src")
            .withColumn("chunk", F.pmod(F.xxhash64("dst"), F.col("chunks")).cast("int"))
            .groupBy(F.col("src").alias("id"), "chunk", "deg").agg(F.collect_list("dst").alias("out"))
            .select("id", "chunk", "out", (F.lit(1.0) / F.col("deg")).alias("w")))
    sized = (vertices.select("id").join(deg.withColumnRenamed("src", "id"), "id", "left")
             .fillna(0, ["chunks", "deg"]))
    return bucketed(rows, "adjacency", ["id", "chunk"]), saved(sized, "vertices")


def _round(state: DataFrame, adjacency: DataFrame, reset: float, least: float, first: bool) -> DataFrame:
    """One synchronous round: the frontier tells its targets, what came adds to the rank and is told on in a
    later round; columns ``sent<n>`` and ``change<n>`` are added, the number of messages of each vertex
    and what it has to tell after the round.

    A vertex meets the rows of its adjacency, which stay where they are, once for each chunk, and once more
    (chunk -1) to send its own state to itself: so the state is read once, and one aggregation does."""
    told = state.withColumn("active", (F.abs("pending") >= least) & (F.col("pending") != 0)).withColumn("chunk", F.explode(F.expr(
        "if(active AND chunks > 0, sequence(-1, chunks - 1), array(-1))")))
    before = [c for c in state.columns if c.startswith(("sent", "change"))]
    now, change = f"sent{len(before) // 2}", f"change{len(before) // 2}"
    own = {"id": "id", "chunks": "chunks", "deg": "deg", "rank": "rank", "kept": "if(active, 0.0D, pending)",
           "c": "0.0D", **{c: c for c in before}, now: "if(active, deg, 0L)"}
    types = {"chunks": "int", "rank": "double", "kept": "double"} | {c: "double" for c in own if c.startswith("change")}
    message = {c: f"cast(null AS {types.get(c, 'bigint')})" for c in own} | {"id": "d", "c": "pending * w"}

    def struct(values: dict) -> str:
        return "named_struct(" + ", ".join(f"'{c}', {v}" for c, v in values.items()) + ")"
    rows = told.join(adjacency, ["id", "chunk"], "left").select(F.explode(F.expr(
        f"if(chunk < 0, array({struct(own)}), transform(out, d -> {struct(message)}))")).alias("s")).select("s.*")
    summed = rows.groupBy("id").agg(*[F.max(c).alias(c) for c in own if c not in ("id", "c")],
                                    (F.lit(1.0 - reset) * F.sum("c")).alias("c"))
    rank = F.col("rank") + F.col("c")
    # all vertices told their starting rank of 1 in the first round; what they have to tell is the change
    pending = rank - 1.0 if first else F.col("kept") + F.col("c")
    return summed.select("id", "chunks", "deg", rank.alias("rank"), pending.alias("pending"), *before, now,
                         pending.alias(change))


def pagerank(edges: DataFrame, vertices: DataFrame | None = None,
             reset: float = PAGERANK_RESET, max_iter: int | None = None,
             tol: float = PAGERANK_TOL, rounds_per_job: int = 6,
             normalize: bool = False, sent: list[int] | None = None, least: float | None = None) -> DataFrame:
    """G03 (Q21): unweighted PageRank ``r(v) = reset + (1 - reset) * sum(r(u) / deg(u))``
    over in-edges u -> v, starting from 1.0.

    Changes, not ranks, are sent: a vertex adds up what its rank changed since it last told
    its targets and tells them when that is ``least`` (``tol`` unless given) or more (with either sign).  Only
    this frontier is joined with the adjacency; the ranks are final in the first round without one.  While
    all vertices are in the frontier (always, with ``tol=0``) a round equals one of the power iteration.

    With ``least=0`` every change is told in the next round, so all rounds equal those of the power
    iteration, and the ranks are those of the first round in which no rank changes by ``tol`` or more.

    There is no round limit unless ``max_iter`` is given; reaching it first raises
    :class:`NotConverged` (with ``tol=0``, ``max_iter`` rounds are what is asked for).  ``sent`` gets the
    number of messages of each round appended.

    ``rounds_per_job`` rounds run as one Spark job.  Rounds after the last have no frontier and change nothing;
    with ``least=0`` what rounds after the last one changed is taken off again: so the
    setting moves no result.  The state (rank, what is still to be told) is written to
    ``spark.checkpoint.dir`` after each job (lineage cut, safe against lost executors).  A round
    shuffles the state and the frontier to the buckets of :func:`store_adjacency`, and messages, combined
    map-side, to their targets; edges are never shuffled again.  ``normalize`` rescales the result so ranks
    sum to the vertex count.
    """
    if max_iter is None and tol <= 0:
        raise ValueError("tol=0 needs max_iter")
    e = saved(edges.select("src", "dst"), "edges")
    v = vertices_of(e) if vertices is None else vertices.select("id").union(vertices_of(e)).distinct()
    adjacency, sized = store_adjacency(e, v)
    state = sized.withColumns({"rank": F.lit(reset), "pending": F.lit(1.0)})
    least = tol if least is None else least
    if not 0 <= least <= tol:
        raise ValueError("least must be in [0, tol]")
    done = 0
    while max_iter is None or done < max_iter:
        n = rounds_per_job if max_iter is None else min(rounds_per_job, max_iter - done)
        state = state.select("id", "chunks", "deg", "rank", "pending")
        for k in range(n):
            state = _round(state, adjacency, reset, least, done + k == 0)
        state = saved(state, "ranks")
        seen = state.agg(*[F.max((F.abs(f"change{k}") >= tol).cast("int")).alias(f"left{k}") for k in range(n)],
                         *[F.sum(f"sent{k}").alias(f"sent{k}") for k in range(n)]).first()
        # where small changes are held back, a round without large ones ends it, and all later rounds are alike
        last = next((k for k in range(n) if not seen[f"left{k}"]), None)
        done += n
        if sent is not None:
            sent += [seen[f"sent{k}"] or 0 for k in range(n)]
        if last is not None and least < tol:
            late = sum((F.col(f"change{k}") for k in range(last + 1, n)), F.lit(0.0))
            state = state.withColumn("rank", F.col("rank") - late)
        if last is not None:
            break
    else:
        if tol > 0:
            raise NotConverged(f"a rank still changes by {tol:g} or more after {max_iter} rounds")
    ranks = state.select("id", "rank")
    if normalize:
        total, count = ranks.agg(F.sum("rank"), F.count(F.lit(1))).first()
        ranks = ranks.select("id", (F.col("rank") * F.lit(count / total)).alias("rank"))
    return ranks


def top_ranked(ranks: DataFrame) -> DataFrame:
    """The highest-ranked vertex; ties -> smallest id."""
    return ranks.orderBy(F.desc("rank"), F.asc("id")).limit(1)
