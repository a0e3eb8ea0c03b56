import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from aloft.llm import divergence, queries
from tools.compare import rows_key, spark_rows, sql_rows, views

from .conftest import SF, prose

ONE = 1_000_000_000


def brute(rows, least=3, most=200):
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        groups[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        mine = {s: c for (g, s), c in groups.items() if g == lang}

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + ONE * (count[t] + 1) // (total + len(kept)) for t in kept}
        p = shares(mine[source])
        whole = shares(sum(mine.values(), Counter()))
        pairs = [(s, sum((p[t] - q) ** 2 // q for t, q in shares(c).items())) for s, c in mine.items() if s != source]
        terms = [(t, (p[t] - whole[t]) ** 2 // whole[t]) for t in kept if mine[source][t] and p[t] > whole[t]]
        for part, items, cut in (("pair", pairs, None), ("term", terms, most)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, v, k) for k, (item, v) in enumerate(items[:cut], 1)]
    return sorted(out)


def rows(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


def test_equals_sql(spark, sf):
    con = duckdb.connect()
    views(con, SF)
    cols, got = spark_rows(queries.op13_divergence_audit(spark, sf))
    want_cols, want = sql_rows(con, divergence.ORACLE)
    assert cols == want_cols and rows_key(got) == rows_key(want) and len(got) > 1000


@pytest.fixture(scope="module")
def many(spark):
    """More sources than a tile, one with half of all rows, some without any term."""
    r = random.Random(4)
    rows = [(prose(k, r.randint(1, 40)), r.choice("xy"), r.choice(["big", f"s{r.randint(0, 70)}"])) for k in range(400)]
    rows += [("12 34", "x", "none"), (None, "y", None), ("", None, "alone"), ("Ünï ünï, ÀB", "x", "s1")] * 3
    rows += [("rare words here", "z", "a"), (None, "z", "b"), ("a", "z", "b")]
    return rows, spark.createDataFrame(rows, "text string, lang string, source string").repartition(6)


@pytest.mark.parametrize("block", [16, 8_192])
def test_equals_brute_force(many, monkeypatch, block):
    data, docs = many
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "HELD", 50)
    got = rows(divergence.audit(docs, most_terms=20))
    assert got == brute(data, most=20)
    assert {g[:2] for g in got} >= {("x", "none"), ("y", ""), ("z", "a")}


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumnRenamed("part", "lang").withColumnRenamed("block", "source")
    docs = docs.withColumnRenamed("spans", "term").withColumnRenamed("id", "gid")
    data = [(r.text, r.lang, r.source) for r in docs.collect()]
    assert rows(divergence.audit(docs, least_docs=2)) == brute(data, least=2)
    assert divergence.audit(no_docs).count() == 0


def test_traversal_leaves_zero_quadrants_out():
    """Both strips empty in a square: none of it is seen; else sums equal the plain double loop."""
    rng = np.random.default_rng(1)
    strips, dense = [], []
    for k in range(2):
        some = rng.random((32, 96)) < 0.05
        some[:, 32:64] = False
        row, col = np.nonzero(some)
        p = rng.integers(1, ONE, len(row))
        zero = rng.integers(1, 1000, 32)
        all_rows = np.arange(32)
        strips.append(divergence.Strip(np.r_[row, all_rows], np.r_[col, np.full(32, -1)], np.r_[p, np.ones(32, int)],
                                       np.r_[zero[row], zero], 96))
        cells = np.repeat(zero[:, None], 96, axis=1)
        cells[some] = p
        dense.append((cells, some, zero))
    real = 90
    there, back, seen = divergence.traverse(*strips, real)
    (a, sa, za), (b, sb, zb) = dense
    assert 0 < seen.max() <= 58  # 32 of 90 columns lie in the empty square
    for i in range(32):
        for j in range(32):
            full = sum((int(x) - int(y)) ** 2 // int(y) for x, y in zip(a[i, :real], b[j, :real], strict=True))
            rest = int(real - seen[i, j]) * ((int(za[i]) - int(zb[j])) ** 2 // int(zb[j]))
            assert int(there[i, j]) + rest == full
            full = sum((int(x) - int(y)) ** 2 // int(x) for x, y in zip(a[i, :real], b[j, :real], strict=True))
            assert int(back[i, j]) + int(real - seen[i, j]) * ((int(za[i]) - int(zb[j])) ** 2 // int(za[i])) == full
