import math

from aloft.llm import decontaminate

from .conftest import prose


def shingles(text, k):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {b" ".join(t[i:i + k]) for i in range(len(t) - k + 1)}


def brute(docs, items):
    out, parts = [], {}
    for i, t in items:
        n = len((t or "").encode().split())
        if n:
            k = min(n, 5)
            parts.setdefault(i, set()).update((k, s) for s in shingles(t, k))
    texts = {}
    for i, t in docs:
        texts.setdefault(i, set()).update((k, s) for k in range(1, 6) for s in shingles(t, k))
    for d, have in texts.items():
        for i, want in parts.items():
            if len(have & want) >= math.ceil(0.8 * len(want) - 1e-9):
                out.append((str(d), str(i), len(want), len(have & want)))
    return sorted(out)


def rows(df):
    return sorted((str(r.doc_id), str(r.item_id), r.n_shingles, r.n_common) for r in df.collect())


def test_containment_of_short_items_in_long_documents(spark):
    words = prose(5, 3000).split()
    items = [(k, " ".join(words[100 * k:100 * k + n])) for k, n in
             enumerate([5, 6, 9, 12, 17, 31, 64, 1, 2, 4])] + [(10, None), (11, ""), (12, " "), (13, words[7])]
    broken = words[500:531]
    broken[15] = "other"  # 5 of 27 shingles go: 0.81 stays
    worse = list(broken)
    worse[3] = "again"  # 4 more: 0.67
    docs = [(1, " ".join(words)), (2, " ".join(words[90:140]).upper()), (3, " ".join(broken)),
            (4, " ".join(worse)), (5, None), (6, ""), (None, " ".join(words[:1200])), (1, "tail"),
            (7, "\n".join(words[300:330]))]
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, hash string")
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, n string")
    got = rows(decontaminate.contamination(d, b))
    assert got == brute(docs, items) and len(got) > 15


def test_shuffled_path_gives_the_same(spark, sf, documents, monkeypatch):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    first = rows(decontaminate.contamination(documents, items))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert rows(decontaminate.contamination(documents, items)) == first


def test_empty_tables_and_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(odd_docs, none).count() == 0
    items = spark.createDataFrame([(1, prose(1, 60)), (2, prose(9, 30)), (2, prose(9, 30))],
                                  "item_id long, text string")
    assert decontaminate.contamination(no_docs, items).count() == 0
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert rows(decontaminate.contamination(odd_docs, items)) == brute(
        docs, [(1, prose(1, 60)), (2, prose(9, 30))])


def test_no_python_in_the_plan(spark, sf, documents):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    plan = decontaminate.contamination(documents, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
