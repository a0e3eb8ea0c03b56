import numpy as np

from aloft.llm import toxicity
from aloft.llm.common import fold
from aloft.llm.queries import QUERIES


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    a = np.exp(rng.normal(size=(2, 2)))
    lengths = [0, 1, 5, 3, 0, 6]
    e = np.exp(rng.normal(size=sum(lengths)))
    r, b = toxicity.Chains(lengths).run(e, a)
    p = r * b / (1 + r * b)
    at = 0
    for n in lengths:
        total, marked = 0.0, np.zeros(n)
        for path in range(2 ** n):
            s = [path >> t & 1 for t in range(n)]
            w = np.prod([e[at + t] if s[t] else 1.0 for t in range(n)]) * np.prod(
                [a[x, y] for x, y in zip(s, s[1:])])
            total += w
            marked += w * np.array(s)
        assert np.allclose(p[at:at + n], marked / total if n else [])
        at += n


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op7_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.95 * len(rows)
    assert got.count() == 1000 and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert got.where("predicted <> int(score >= 0.5)").count() == 0


def test_spans_point_at_the_words(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tagger = toxicity.train(docs, labels)
    new = spark.createDataFrame([(1, "You are such an idiot, a moron and stupid scum. Fine day."),
                                 (2, "the of and that is to."), (3, None), (4, "")],
                                "doc_id long, text string")
    rows = {r.doc_id: r for r in toxicity.score(new, tagger).collect()}
    text = "You are such an idiot, a moron and stupid scum. Fine day."
    words = {text[s.start:s.stop] for s in rows[1].spans}
    assert {"idiot,", "moron", "stupid", "scum."} <= words and rows[1].predicted == 1
    assert rows[2].predicted == 0 and rows[2].spans == [] and rows[3].score == rows[4].score
    assert toxicity.keep_clean(new, tagger).count() == 3


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 0), (None, 1), (7, None), (77, 1)],
                                   "doc_id long, toxic int")
    tagger = toxicity.train(odd_docs, labels)
    assert toxicity.score(odd_docs, tagger).count() == odd_docs.count()
    assert toxicity.score(no_docs, tagger).count() == 0
    kept = toxicity.keep_clean(odd_docs, tagger)
    assert kept.schema == odd_docs.schema
    nothing = toxicity.train(odd_docs, labels.where("toxic > 5"))
    assert {r.score for r in toxicity.score(odd_docs, nothing).collect()} == {0.0}
    one = toxicity.train(odd_docs, labels.where("toxic = 1"))
    assert {r.score for r in toxicity.score(odd_docs, one).collect()} == {1.0}


def test_fold_of_null_ids(spark):
    df = spark.createDataFrame([(None,), (7,)], "doc_id long")
    assert [r[0] for r in df.select(fold("doc_id", 5)).collect()][0] == 0


def test_long_chains_equal_unbroken_ones(monkeypatch):
    rng = np.random.default_rng(4)
    a, lengths = np.exp(rng.normal(size=(2, 2))), [0, 1, 40, 7, 0, 8, 9, 21]
    e = np.exp(rng.normal(size=sum(lengths)))
    want = toxicity.Chains(lengths).run(e, a)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    chains = toxicity.Chains(lengths)
    assert len(chains.links) == 5
    assert np.allclose(chains.run(e, a), want, rtol=1e-12)


def _labelled(spark, n, toxic_words, clean_words):
    """``n`` rows of each class; toxic ones hold two words of their own in 100."""
    rng = np.random.default_rng(5)
    stems = ["lum", "per", "dor", "nis", "tak", "wel", "osa", "bri"]
    plain = ["".join(rng.choice(stems, 2)) + str(i) for i in range(300)]
    rows = []
    for i in range(2 * n):
        words = list(rng.choice(plain, toxic_words if i % 2 else clean_words))
        if i % 2:
            for k in rng.integers(len(words), size=max(2, len(words) // 50)):
                words[k] = rng.choice(["gruk", "zzarg", "vloth", "xemm"])
        rows.append((i, " ".join(words), i % 2))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return docs.select("doc_id", "text"), docs.select("doc_id", "toxic")


def test_long_toxic_documents_only(spark):
    docs, labels = _labelled(spark, 40, 1_500, 150)
    assert docs.where("doc_id % 2 = 1 AND length(text) <= 8000").count() == 0
    tagger = toxicity.train(docs, labels.where("doc_id < 60"))
    rows = toxicity.score(docs, tagger).where("doc_id >= 60").collect()
    assert [r.predicted for r in rows] == [r.doc_id % 2 for r in rows]
    assert toxicity.keep_clean(docs, tagger).count() == 40


def test_sample_is_filled_from_rows_with_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic, prior: seen.append((texts, toxic)))
    monkeypatch.setattr(toxicity, "MOST", {1: 5, 0: 5})
    docs, labels = _labelled(spark, 40, 30, 30)
    missing = spark.createDataFrame([(i, 1) for i in range(1000, 1200)], "doc_id long, toxic int")
    toxicity.train(docs.union(docs), labels.union(missing))
    assert sorted(seen[0][1]) == [0] * 5 + [1] * 5 and len(set(seen[0][0])) == 10
    monkeypatch.setattr(toxicity, "CHARS", {1: 1, 0: 500})
    toxicity.train(docs, labels)
    assert seen[1][1].count(1) == 1 and 1 < seen[1][1].count(0) < 5
    assert sum(len(t) for t, y in zip(*seen[1]) if not y) >= 500
