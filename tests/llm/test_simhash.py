import numpy as np
import xxhash

from aloft.llm import simhash
from aloft.llm.components import components, forest
from aloft.llm.queries import QUERIES


def brute_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, bits):
    label = list(range(len(fps)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                label[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for i, x in enumerate(ids):
        if x is not None:
            low[root(i)] = min(x, low.get(root(i), x))
    return [low.get(root(i)) for i in range(len(ids))]


def test_spark_hash_is_the_same(spark):
    r = spark.sql("SELECT xxhash64('alo beri Cado') AS h").first()
    assert r.h % 2 ** 64 == xxhash.xxh64_intdigest(b"alo beri Cado", 42)


def compare(rows, docs):
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows)
    ids = [r.doc_id for r in docs]
    fps = [brute_fingerprint(r.text) for r in docs]
    want = brute_components(ids, fps, 3)
    assert got == sorted((str(i), f"{f:016x}", str(c)) for i, f, c in zip(ids, fps, want))


def test_odd_rows(odd_docs, no_docs):
    compare(simhash.near_duplicates(odd_docs).collect(), odd_docs.select("doc_id", "text").collect())
    assert simhash.near_duplicates(no_docs).count() == 0


def test_query(spark, sf, documents):
    compare(QUERIES["op8_simhash_near_dedup"](spark, sf).collect(), documents.collect())


def test_tree_loses_no_pair(spark, monkeypatch):
    # many shards, clusters and single points; links are those of brute force
    rng = np.random.default_rng(0)
    centre = rng.integers(0, 2 ** 63, 60, dtype=np.uint64)
    near = [c ^ sum(np.uint64(1) << np.uint64(b) for b in rng.choice(64, rng.integers(1, 6), False))
            for c in centre for _ in range(6)]
    points = np.unique(np.concatenate([centre, np.array(near, np.uint64),
                                       rng.integers(0, 2 ** 63, 800, dtype=np.uint64)]))
    monkeypatch.setattr(simhash, "SHARD", 60)
    monkeypatch.setattr(simhash, "BLOCK", 200)
    fps = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    edges = [(r.u, r.v) for r in simhash.links(fps, 3).collect()]
    values = points.view(np.int64)
    at = {int(v): i for i, v in enumerate(values)}
    i, j = (np.array([at[e[k]] for e in edges]) for k in (0, 1))
    assert (np.bitwise_count(points[i] ^ points[j]) > 0).all()
    a, b = np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3)
    assert (forest(i, j, len(points)) == forest(a, b, len(points))).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(5, 5), (7, 3), (3, 7), (9, 3)]
    got = {r.u: r.v for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {i: 100 for i in range(101, 141)} | {7: 3, 9: 3}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
