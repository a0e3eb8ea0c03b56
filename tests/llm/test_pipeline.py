import numpy as np

import corpus_pipeline
from aloft.llm import bpe, toxicity

from .conftest import prose
from .test_decontaminate import brute as contaminated
from .test_secrets import brute as secret_spans
from .test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "byte_bpe"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        had, has = before.collect(), after.collect()
        if name != "byte_bpe":
            assert after.columns == docs.columns
        ids = {r.doc_id for r in has}
        if name == "toxicity":
            labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert sum(labels.get(i) == 1 for i in ids) <= 0.2 * sum(v == 1 for v in labels.values())
            clean = [r.doc_id for r in had if labels.get(r.doc_id) == 0]
            assert sum(i in ids for i in clean) >= 0.98 * len(clean)
        elif name == "simhash_near_dedup":
            low = brute_components([r.doc_id for r in had], [brute_fingerprint(r.text) for r in had], 3)
            assert ids == {r.doc_id for r, c in zip(had, low) if c == r.doc_id}
        elif name == "benchmark_decontamination":
            leaked = {x[0] for x in contaminated([(r.doc_id, r.text) for r in had], items)}
            assert leaked and ids == {r.doc_id for r in had} - {int(x) for x in leaked}
        elif name == "secret_scans":
            assert ids == {r.doc_id for r in had} and not any(secret_spans(r.text) for r in has)
            old = {r.doc_id: r for r in had}
            for r in has:
                if not secret_spans(old[r.doc_id].text):
                    assert r == old[r.doc_id]
                else:
                    assert r.n_chars == len(r.text) and "[SECRET]" in r.text
        else:
            replay = bpe.MergeReplay(bpe.load_ranks(bpe.default_vocabulary()), bpe.public_tokenizers.PATTERN)
            texts = {r.doc_id: r.text for r in had}
            assert ids == set(texts)
            assert all(replay.decode(r.ids).decode() == texts[r.doc_id] for r in has)
        before = after
    assert sorted(r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()) == sorted(
        r.ids_sha256 for r in before.collect())


def test_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(toxicity, "train", lambda *a, **k: toxicity.fit([], [], 0.0))
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "byte_bpe":
                assert out.schema.simpleString() == docs.schema.simpleString()
                docs = spark.createDataFrame(out.collect(), out.schema)
    clean = spark.createDataFrame([(i, prose(i, 50), None) for i in range(10)], "doc_id long, text string, lang string")
    assert np.unique([stage(spark, clean, SF).count() for _, stage in corpus_pipeline.STAGES]).tolist() == [10]


def test_null_and_repeated_ids_are_judged_row_by_row(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    docs = spark.createDataFrame(
        [(None, a), (None, a), (None, b), (5, b), (7, c), (7, c), (9, c)], "doc_id long, text string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(0, a), (5, b), (7, c)])
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    docs = spark.createDataFrame([(None, item), (None, a), (4, f"{b} {item}"), (4, b)], "doc_id long, text string")
    got = corpus_pipeline.decontaminate_docs(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(0, a), (4, b)])


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Columns that the stages would use themselves, and one with a dot."""
    item = prose(3, 30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, prose(1, 50), "k1", 1.5), (2, prose(1, 50), "k2", 2.5), (3, f"{prose(4, 40)} {item}", "k3", 3.5),
            (4, f"{prose(5, 40)} token=abcdef77", "k4", 4.5)]
    docs = spark.createDataFrame([(i, t, k, k, k, x) for i, t, k, x in rows],
                                 "doc_id long, text string, __key string, __blob string, __spans string, `a.b` double")
    one = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path))
    assert one.columns == docs.columns and {(r["doc_id"], r["__key"]) for r in one.collect()} == {(1, "k1"), (3, "k3"), (4, "k4")}
    two = corpus_pipeline.decontaminate_docs(spark, one, str(tmp_path))
    assert two.columns == docs.columns and {(r["doc_id"], r["a.b"]) for r in two.collect()} == {(1, 1.5), (4, 4.5)}
    three = corpus_pipeline.mask_secrets(spark, two, str(tmp_path))
    assert three.columns == docs.columns
    assert {(r["doc_id"], r["__blob"], r["__spans"], "[SECRET]" in r["text"]) for r in three.collect()} == {
        (1, "k1", "k1", False), (4, "k4", "k4", True)}
