"""Q19-Q21: social graph from a text dump, out-degree, PageRank."""

import numpy as np
import pytest

from aloft.operators import NotConverged, edges_from_pairs, pagerank, triplets, vertices_of
from aloft.operators import graph as graph_ops
from aloft.plans import SocialGraph
from tests.conftest import write_text

# The layout of the dump and the golden edges.
DUMP = """ first_user_id | second_user_id
---------------+----------------
             1 |             10
            10 |              1
             1 |             11
            11 |              1
             1 |             12
(5 rows)

    table_name
-------------------
 api_accounts
 checkins
(2 rows)
"""


@pytest.fixture(scope="module")
def graph(spark, tmp_path_factory):
    path = write_text(tmp_path_factory.mktemp("g"), "social_dump.txt", DUMP)
    return SocialGraph.load_social(spark, path)


def test_q19_load_social(graph):
    assert sorted(tuple(r) for r in graph.edges.collect()) == [
        (1, 10, 1), (1, 11, 1), (1, 12, 1), (10, 1, 1), (11, 1, 1)]
    assert sorted(r["id"] for r in graph.vertices.collect()) == [1, 10, 11, 12]
    trip = sorted(tuple(r) for r in graph.triplets().collect())
    assert trip == [(1, 1, 10, 10, 1), (1, 1, 11, 11, 1), (1, 1, 12, 12, 1),
                    (10, 10, 1, 1, 1), (11, 11, 1, 1, 1)]


def test_q19_multiplicity(spark):
    pairs = spark.createDataFrame([(1, 2), (1, 2), (2, 1), (1, 3), (2, 3)], "src long, dst long")
    got = sorted(tuple(r) for r in edges_from_pairs(pairs).collect())
    assert got == [(1, 2, 2), (1, 3, 1), (2, 1, 1), (2, 3, 1)]


def test_q20_most_active(graph):
    assert tuple(graph.most_active_user().first()) == (1, 3)


def test_q21_pagerank_highest(graph):
    assert graph.page_rank_highest().first()["id"] == 1


def _numpy_pagerank(n, edges, rounds, reset=0.15):
    deg = np.zeros(n)
    for s, _ in edges:
        deg[s] += 1
    r = np.ones(n)
    for _ in range(rounds):
        nxt = np.zeros(n)
        for s, d in edges:
            nxt[d] += r[s] / deg[s]
        r = reset + (1 - reset) * nxt
    return r


def test_pagerank_matches_power_iteration_with_hub(spark, monkeypatch):
    rng = np.random.default_rng(7)
    n = 60
    pairs = {(0, int(d)) for d in range(1, n)}              # vertex 0: hub, a third of edges
    pairs |= {(int(a), int(b)) for a, b in rng.integers(1, n, size=(110, 2)) if a != b}
    pairs = sorted(pairs)
    edges = spark.createDataFrame([(a, b, 1) for a, b in pairs],
                                  "src long, dst long, weight long")
    ids = sorted({a for a, _ in pairs} | {b for _, b in pairs})
    exp = _numpy_pagerank(n, pairs, 8)
    for chunk in (1024, 4):                                 # the hub as one chunk and as many
        monkeypatch.setattr(graph_ops, "CHUNK", chunk)
        ranks = pagerank(edges, max_iter=8, tol=0.0, rounds_per_job=3)
        got = {r["id"]: r["rank"] for r in ranks.collect()}
        assert [got[i] for i in ids] == pytest.approx([exp[i] for i in ids], rel=1e-9)


def test_pagerank_converges_and_normalizes(spark):
    edges = spark.createDataFrame([(1, 2, 1), (2, 3, 1), (3, 1, 1), (3, 4, 1)],
                                  "src long, dst long, weight long")
    ranks = pagerank(edges, tol=1e-5, normalize=True)
    got = {r["id"]: r["rank"] for r in ranks.collect()}
    assert sum(got.values()) == pytest.approx(4.0)
    assert max(got, key=got.get) in (1, 3)
    assert vertices_of(edges).count() == 4


def test_pagerank_rounds_per_job_moves_no_result(spark):
    edges = spark.createDataFrame([(1, 2, 1), (2, 3, 1), (3, 1, 1), (3, 4, 1), (4, 1, 1)],
                                  "src long, dst long, weight long")
    a, b = ({r["id"]: r["rank"] for r in pagerank(edges, tol=1e-4, rounds_per_job=n).collect()}
            for n in (1, 7))
    assert a == pytest.approx(b, rel=1e-12)


def test_pagerank_bound_raises(spark):
    edges = spark.createDataFrame([(1, 2, 1), (2, 1, 1), (3, 1, 1)], "src long, dst long, weight long")
    with pytest.raises(NotConverged):
        pagerank(edges, max_iter=5)
    with pytest.raises(ValueError):
        pagerank(edges, tol=0.0)


def test_pagerank_slow_hub_converges(spark):
    # a cycle of two fed by 398 leaves: far more rounds than a usual cap
    pairs = [(0, 1), (1, 0)] + [(k, 0) for k in range(2, 400)]
    edges = spark.createDataFrame([(a, b, 1) for a, b in pairs], "src long, dst long, weight long")
    got = {r["id"]: r["rank"] for r in pagerank(edges, rounds_per_job=12).collect()}
    exp = _numpy_pagerank(400, pairs, 400)
    assert max(abs(got[i] - exp[i]) for i in range(400)) < 1e-5
    assert got[0] == pytest.approx(183.9, abs=0.05)


def test_pagerank_sink_and_isolated_source(spark):
    edges = spark.createDataFrame([(5, 6, 1)], "src long, dst long, weight long")
    got = {r["id"]: r["rank"] for r in pagerank(edges, max_iter=3, tol=0.0).collect()}
    assert got == pytest.approx({5: 0.15, 6: 0.15 + 0.85 * 0.15})


def test_triplets_complete_the_vertex_set(spark):
    edges = spark.createDataFrame([(1, 2, 1), (2, 3, 4)], "src long, dst long, weight long")
    vertices = spark.createDataFrame([(1, "a"), (2, None)], "id long, attr string")
    got = sorted(tuple(r) for r in triplets(vertices, edges, default_attr="z").collect())
    assert got == [(1, "a", 2, None, 1), (2, None, 3, "z", 4)]


def _fixpoint(pairs, reset=0.15):
    ids = sorted({x for p in pairs for x in p})
    at = {v: k for k, v in enumerate(ids)}
    deg = np.bincount([at[a] for a, _ in pairs], minlength=len(ids))
    m = np.zeros((len(ids), len(ids)))
    for a, b in pairs:
        m[at[b], at[a]] += 1 / deg[at[a]]
    return dict(zip(ids, np.linalg.solve(np.eye(len(ids)) - (1 - reset) * m, np.full(len(ids), reset)), strict=True))


def _skewed_pairs():
    """Vertex 0 is the source of a third of all edges."""
    rng = np.random.default_rng(7)
    pairs = {(0, k) for k in range(1, 120)} | {(int(a), int(b)) for a, b in rng.integers(1, 120, size=(240, 2))}
    return sorted(p for p in pairs if p[0] != p[1])


def test_frontier_sends_less_and_less(spark, monkeypatch):
    pairs = _skewed_pairs()
    edges = spark.createDataFrame([(a, b, 1) for a, b in pairs], "src long, dst long, weight long")
    monkeypatch.setattr(graph_ops, "CHUNK", 8)
    sent = []
    got = {r["id"]: r["rank"] for r in pagerank(edges, rounds_per_job=5, sent=sent).collect()}
    exp = _fixpoint(pairs)
    assert max(abs(got[i] - exp[i]) for i in exp) < 1e-5
    assert sent[0] == len(pairs)                          # all vertices tell their starting rank
    assert sent == sorted(sent, reverse=True) or sent[-1] == 0
    assert 0 < [s for s in sent if s][-1] < len(pairs) / 4  # the last senders are few


def test_round_leaves_the_edges_where_they_are(spark, monkeypatch):
    """Without broadcasts the adjacency side of the join is a bucketed scan with neither exchange nor Python."""
    pairs = _skewed_pairs()
    edges = spark.createDataFrame([(a, b, 1) for a, b in pairs], "src long, dst long, weight long")
    monkeypatch.setattr(graph_ops, "CHUNK", 8)
    adjacency, sized = graph_ops.store_adjacency(edges, vertices_of(edges))
    hub = adjacency.where("id = 0")
    assert hub.count() > 10 and hub.agg({"chunk": "max"}).first()[0] > 10  # a hub is many rows
    from pyspark.sql import functions as F
    state = sized.withColumns({"rank": F.lit(0.15), "pending": F.lit(1.0)})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = graph_ops._round(state, adjacency, 0.15, 1e-6, True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    above, below = plan.split("SortMergeJoin")
    left = [line for line in below.splitlines() if line.lstrip().startswith(":")]
    right = [line for line in below.splitlines() if not line.lstrip().startswith(":")]
    assert above.count("Exchange") == 1 and "".join(left).count("Exchange") == 1
    assert "Exchange" not in "".join(right) and "Bucketed: true" in "".join(right)
    assert "SortAggregate" not in plan
    assert "Python" not in plan and "Arrow" not in plan


def _power_iteration(pairs, tol, reset=0.15):
    """Ranks after the first round in which none changes by ``tol`` or more, and the number of rounds."""
    n, rank, rounds = 1 + max(map(max, pairs)), None, 0
    deg = np.bincount([a for a, _ in pairs], minlength=n)
    rank = np.ones(n)
    while True:
        came = np.zeros(n)
        for a, b in pairs:
            came[b] += rank[a] / deg[a]
        rounds, old, rank = rounds + 1, rank, reset + (1 - reset) * came
        if max(abs(rank - old)) < tol:
            return rank, rounds


@pytest.mark.parametrize("rounds_per_job", [1, 4, 6])
def test_pagerank_tells_every_change(spark, rounds_per_job):
    """With least=0 no small change is held back, and the ranks are those of the very round that converged."""
    pairs = _skewed_pairs()
    edges = spark.createDataFrame([(a, b, 1) for a, b in pairs], "src long, dst long, weight long")
    for tol in (1e-2, 1e-3):
        exp, _ = _power_iteration(pairs, tol)
        got = {r["id"]: r["rank"] for r in pagerank(edges, tol=tol, least=0.0, rounds_per_job=rounds_per_job).collect()}
        assert max(abs(got[i] - exp[i]) for i in got) < 1e-12


def test_pagerank_query_runs_all_rounds(spark, tmp_path):
    """The query's ranks are those of the whole power iteration, also for vertices whose last changes are small."""
    from aloft.plans.tables import QUERIES
    pairs = _skewed_pairs()
    rows = [(k, a, "purchase", '{"k": %d}' % b) for k, (a, b) in enumerate(pairs)]
    (spark.createDataFrame(rows, "event_id long, user_id long, event_type string, props string")
     .write.parquet(str(tmp_path / "events.parquet")))
    exp, _ = _power_iteration(pairs, 1e-6)
    got = {r["id"]: r["rank"] for r in QUERIES["pagerank"](spark, str(tmp_path)).collect()}
    # the ranks are given to 6 digits
    assert set(got) == {x for p in pairs for x in p} and max(abs(got[i] - exp[i]) for i in got) < 5.1e-7
