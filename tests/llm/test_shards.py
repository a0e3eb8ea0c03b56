import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from aloft.llm import queries, shards
from tools.compare import rows_key, spark_rows, sql_rows, views

from .conftest import SF, prose


def laws(rows, n_shards, mixture):
    """Counts at most one apart, slots gapless, every source in its share."""
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) <= set(range(n_shards))
    full = [sizes.get(s, 0) for s in range(n_shards)]
    assert max(full) - min(full) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    share = Counter(r.source for r in rows)
    held = Counter((r.shard, r.source) for r in rows)
    for s in range(n_shards):
        for source, n in share.items():
            assert abs(held[s, source] - n / n_shards) <= mixture, (s, source)


def test_equals_sql(spark, sf):
    con = duckdb.connect()
    views(con, SF)
    cols, got = spark_rows(queries.op11_sharding(spark, sf))
    want_cols, want = sql_rows(con, shards.ORACLE)
    assert cols == want_cols and rows_key(got) == rows_key(want) and len(got) == 200


def test_rows_keep_their_identity(spark, documents):
    got = shards.interleave(documents).collect()
    want = Counter((r.doc_id, r.source, len((r.text or "").encode()) + 16,
                    zlib.crc32((r.text or "").encode())) for r in documents.collect())
    assert Counter((r.doc_id, r.source, r.size, r.text_crc32) for r in got) == want
    laws(got, 40, 3)


def test_hot_rows_and_sources(spark, monkeypatch):
    """A third of all rows one repeated row without an id, a third one source, many sources of one row."""
    rows = [(None, "same", "a")] * 900 + [(i, f"t{i}", "hot") for i in range(900)] + \
           [(i, f"u{i}", f"s{i}") for i in range(700)] + [(i, None, None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    want = sorted(shards.interleave(docs, shards=7).collect(), key=str)
    laws(want, 7, 12)
    once = [sum(r.shard == s and (r.source or "").startswith("s") for r in want) for s in range(7)]
    assert max(once) - min(once) < 40  # small sources do not crowd in one shard
    monkeypatch.setattr(shards, "CHUNK", 7)
    monkeypatch.setattr(shards, "RANGE_ROWS", 50)
    assert sorted(shards.interleave(docs.repartition(2), shards=7).collect(), key=str) == want
    other = shards.interleave(docs, shards=7, seed=5).collect()
    laws(other, 7, 12)
    assert sorted(other, key=str) != want


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumnRenamed("part", "source").withColumnRenamed("score", "hash")
    got = shards.interleave(docs, shards=4).collect()
    assert len(got) == docs.count()
    laws(got, 4, 1)
    assert {r.size for r in got if r.doc_id == 3} == {16}
    assert shards.interleave(no_docs).count() == 0


@pytest.mark.parametrize("chunk", [2, 10_000])
def test_written_shards_hold_every_text(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(shards, "CHUNK", chunk)
    rows = [(1, prose(1, 20), "a")] * 7 + [(None, None, "b")] * 3 + [(i, prose(i, 30), "c") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    shards.write_shards(docs, f"{tmp_path}/out", shards=3)
    back = spark.read.parquet(f"{tmp_path}/out").collect()
    assert Counter((r.doc_id, r.text, r.source) for r in back) == Counter((i, t or "", s) for i, t, s in rows)
    laws(back, 3, 2)


def test_no_python_in_the_plan(spark, documents):
    plan = shards.interleave(documents)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))
