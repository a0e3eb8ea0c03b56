import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aloft.llm import lm
from aloft.llm.queries import QUERIES


def tokens(t):
    return [*(t or "").encode().lower().split(), None]


def fold(i, n=7):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def check(rows, docs):
    c = Counter()
    for r in docs:
        if fold(r.doc_id) != 2:
            c.update(tokens(r.text))
    n, v = sum(c.values()), len(c)
    want = []
    for r in docs:
        w = tokens(r.text)
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
        want.append((str(r.doc_id), fold(r.doc_id) == 2, len(w), sum(c[x] > 0 for x in w), n, round(base, 6)))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
           for r in rows]
    assert sorted(got) == sorted(want)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)


def test_query_and_model_beats_base(spark, sf, documents):
    rows = QUERIES["op3_lm_scoring"](spark, sf).collect()
    check(rows, documents.collect())
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.2 * sum(r.n_tokens for r in held)


def test_odd_rows(odd_docs, no_docs):
    check(lm.score(odd_docs).collect(), odd_docs.select("doc_id", "text").collect())
    assert lm.score(no_docs).count() == 0


def test_blocks_and_buckets_do_not_change_the_counts(spark, sf, documents, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", (40_000, 40_000))
    monkeypatch.setattr(lm, "BUCKET_BYTES", (50_000, 50_000))
    check(lm.score(documents).collect(), documents.collect())


def test_a_row_that_is_a_third_of_all_rows_spreads(spark, documents, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", (40_000, 40_000))
    kept = {}
    plain = lm.saved

    def keep(df, name):
        kept[name] = plain(df, name)
        return kept[name]
    monkeypatch.setattr(lm, "saved", keep)
    few = documents.select("doc_id", "text").limit(150)
    for text, copies in (("a hot row, " * 60, 400), ("", 8000), (None, 8000)):
        docs = few.union(spark.range(copies).select(F.lit(None).cast("long"), F.lit(text).cast("string")))
        docs = plain(docs, "rows")
        check(lm.score(docs).collect(), docs.collect())
        per = [r.n for r in kept["packed"].groupBy("block").agg(F.sum(F.size("ids")).alias("n")).collect()]
        assert sum(per) == 150 + copies and max(per) < 0.3 * copies


def test_without_training_rows(spark):
    ids = [i for i in range(100) if fold(i) == 2][:4]
    rows = lm.score(spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")).collect()
    assert all(r.train_tokens == 0 and r.score == r.base_score for r in rows) and len(rows) == 4


def test_score_is_the_mixture(spark, sf, documents):
    # the registered formula, with the weights of the same run, by plain counting
    seen = {}
    plain = lm.learn_weights

    def keep(h):
        seen["w"] = plain(h)
        return seen["w"]
    lm.learn_weights = keep
    try:
        rows = {r.doc_id: r for r in lm.score(documents).collect()}
    finally:
        lm.learn_weights = plain
    docs = documents.collect()
    uni, pair = Counter(), Counter()
    for r in docs:
        if fold(r.doc_id) != 2:
            w = tokens(r.text)
            uni.update(w)
            pair.update(zip([None, *w], w))
    n, v, w3 = sum(uni.values()), len(uni), seen["w"]
    assert np.allclose(w3.sum(axis=1), 1)
    for r in docs[:60]:
        total, before = 0.0, None
        for x in tokens(r.text):
            c = uni[before]
            a, u, z = w3[min(math.frexp(c)[1], lm.CONTEXTS - 1)]
            total += math.log10((a * pair[before, x] / c if c else 0) + u * uni[x] / n
                                + z * (uni[x] + 1) / (n + v + 1))
            before = x
        assert rows[r.doc_id].score == pytest.approx(total, rel=1e-9)


def test_em_raises_likelihood():
    h = [(3, 90, 70, 50.0), (3, -1, 75, 20.0), (3, -1, -1, 5.0), (5, 100, 60, 9.0)]

    def loglik(w):
        r = lambda x: 2 ** ((x + .5) / lm.STEPS - lm.RANGE / 2) if x >= 0 else 0
        return sum(n * math.log(w[b][0] * r(x) + w[b][1] * r(y) + w[b][2]) for b, x, y, n in h)
    assert loglik(lm.learn_weights(h, 30)) > loglik(lm.learn_weights(h, 1)) > loglik(lm.learn_weights([]))
