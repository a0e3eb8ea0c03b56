import hashlib
import random

import numpy as np

from aloft.llm import suffix_dedup as sd

from .conftest import prose


def brute(docs):
    docs = [(sd.LAST if i is None else i, i, (t or "").encode()) for i, t in docs]
    low = {}
    for k, _, b in docs:
        for p in range(len(b) - 49):
            low[b[p:p + 50]] = min(k, low.get(b[p:p + 50], k))
    out = []
    for k, i, b in docs:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 49):
            if low[b[p:p + 50]] < k:
                gone[p:p + 50] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((str(i), len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def rows(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def tangled(seed, n=60):
    """Texts that share passages of many lengths, around and at 50 bytes, also within a text."""
    r = random.Random(seed)
    parts = [prose(100 + k, 30)[:r.choice([10, 48, 49, 50, 51, 70, 120])] for k in range(25)]
    out = []
    for i in range(n):
        t = "".join(r.choice([r.choice(parts), prose(1000 * seed + 7 * i + j, 5), "é" * r.randint(1, 30), "a" * 60])
                    for j in range(r.randint(0, 9)))
        out.append((r.randint(0, 40), t))
    return out


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sd, "BLOCK_BYTES", (3_000, 3_000))
    monkeypatch.setattr(sd, "BUCKET_BYTES", (2_000, 2_000))
    for seed, hot in ((1, 5_000), (2, 2)):  # every frequent minimiser is hot in the second run
        monkeypatch.setattr(sd, "HOT", hot)
        docs = tangled(seed)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        assert rows(sd.deduplicate(df)) == brute(docs)


def test_odd_rows(odd_docs, no_docs):
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert rows(sd.deduplicate(odd_docs)) == brute(docs)
    assert sd.deduplicate(no_docs).count() == 0


def test_hot_passage_in_many_texts(spark):
    line = prose(4, 14)
    docs = [(i, prose(500 + i, 12) + " " + line + " " + prose(900 + i, 12)) for i in range(200)]
    docs += [(1000 + i, "same " + line * 2) for i in range(100)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows(sd.deduplicate(df)) == brute(docs)


def test_transform_and_merge_invert():
    # the transform of a collection gives its strings back by LF steps
    r = random.Random(5)
    strings = [bytes(r.choice(b"ab c") for _ in range(r.randint(1, 40))) for _ in range(50)]
    raw = np.frombuffer(b"".join(strings), np.uint8)
    size = np.array([len(s) for s in strings])
    bwt = sd.transform(raw, np.cumsum(size) - size, size)
    lf = np.empty(len(bwt), int)
    lf[np.argsort(bwt, kind="stable")] = np.arange(len(bwt))
    for k, s in enumerate(strings):
        at, out = k, []
        while bwt[at]:
            out.append(bwt[at] - 1)
            at = lf[at]
        assert bytes(out[::-1]) == s


def test_minimisers_cover_every_window():
    text = (prose(3, 400) + "a" * 300).encode()
    raw = np.frombuffer(text, np.uint8)
    fp, first, run = sd.minimisers(raw, np.array([700, 700, 730, len(text)]))
    seen = np.concatenate([np.arange(f, f + n) for f, n in zip(first, run)])
    want = [p for a, b in ((0, 700), (730, len(text))) for p in range(a, b - 49)]
    assert sorted(seen.tolist()) == want and run.max() <= sd.LENGTH - sd.SEED + 1
    by = {}
    for f, p, n in zip(fp.tolist(), first.tolist(), run.tolist()):
        for q in range(p, p + n):
            assert by.setdefault(text[q:q + 50], f) == f
