import numpy as np
import pandas as pd
import pytest

from aloft.llm import ann
from aloft.llm.queries import QUERIES


def exact(ids, x, k, every=20):
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            s = (x * q).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    assert got.keys() == want.keys()
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    for q in got:
        assert [v for v, _ in got[q]] == [v for v, _ in sorted(got[q], key=lambda x: (-x[1], x[0]))]
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("parts", [None, 12])
def test_recall_on_the_table(spark, parts):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    t = table.toPandas()
    x, ids = np.array(t.embedding.tolist(), float), t.vec_id.to_numpy()
    got = found(ann.search(table, parts=parts))
    want = exact(ids, x, 20)
    assert recall(got, want) >= 0.9
    at = {i: k for k, i in enumerate(ids)}
    for q, near in list(got.items())[:20]:
        for v, s in near:
            assert abs(s - float(x[at[q]] @ x[at[v]])) < 1e-12


def test_query(spark, sf):
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    got = found(QUERIES["op5_nearest_neighbours"](spark, sf))
    assert recall(got, exact(t.vec_id.to_numpy(), np.array(t.embedding.tolist(), float), 20)) >= 0.9


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    same = [0.5, 0.5, 0.0]
    rows = [(i, same) for i in range(0, 60)] + [(i, rng.normal(size=3).tolist()) for i in range(60, 100)]
    odd = [(100, None), (120, [0.0, 0.0, 0.0]), (140, [1.0, None, 2.0]), (160, [float("nan"), 1.0, 1.0]),
           (180, [float("inf"), 1.0, 1.0]), (200, [1.0, 2.0]), (None, same), (220, []), (60, rows[60][1])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd],
                               "vec_id long, embedding array<double>, part string, rank int")
    got = found(ann.search(df))
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    want = exact(ids, x, 20)
    assert {q: [v for v, _ in n] for q, n in got.items()} == {q: [v for v, _ in n] for q, n in want.items()}
    assert ann.search(df.limit(0)).count() == 0
    assert found(ann.search(df.where("vec_id = 60"))) == {}
    assert len(found(ann.search(df.where("vec_id < 3")))[0]) == 2


def test_blocks_of_a_large_part(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert recall(found(ann.search(df, parts=1)), exact(np.arange(900), x, 20)) == 1.0


def test_parts_are_balanced():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(n, 6)) + 6 * rng.normal(size=6) for n in (500, 60, 40, 200)])
    part = ann.balanced_parts(ann.nearest_graph(x, 8), 10)
    assert np.bincount(part, minlength=10).max() <= 82 and np.bincount(part).min() >= 78


def test_blocks_of_many_queries(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 100)
    monkeypatch.setattr(ann, "QUERIES", 50)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert recall(found(ann.search(df, parts=1, every=2)), exact(np.arange(900), x, 20, every=2)) == 1.0
    queries = spark.range(450).selectExpr("0 AS `group`", "id AS query_id")
    candidates = df.selectExpr("0 AS `group`", "vec_id", "embedding AS v")
    queries, candidates = ann.dealt(queries, candidates, {0: 900}, 450)
    keys = ["group", "block", "query_block"]
    for side in (queries, candidates):
        assert max(r["count"] for r in side.groupBy(*keys).count().collect()) <= 200
    met = queries.join(candidates, keys)
    assert met.count() == met.select("query_id", "vec_id").distinct().count() == 450 * 900


def test_a_block_passes_on_the_k_best():
    v = [1.0, 0.0]
    c = pd.DataFrame({"v": [v, [0.5, 0.5], [0.1, 0.2]], "part": [0, 1, 2], "ids": [[1, 2, 3, 4], [5, 6], [7]]})
    q = pd.DataFrame({"query_id": [2, 9], "bits": [7, 2], "q": [v, v]})
    got = ann.ranked(q, c, 4)
    assert got.values.tolist() == [[2, 1, 1.0], [2, 3, 1.0], [2, 4, 1.0], [2, 5, 0.5], [9, 5, 0.5], [9, 6, 0.5]]
    assert len(ann.ranked(q.iloc[:0], c, 4)) == 0
