"""Catalog tables kept by join key, and lines of the smaller inputs."""

import random

import pytest
from pyspark.sql import functions as F

from aloft.operators.catalog import joined_totals, keyed_table
from aloft.plans import tables
from aloft.sources import parse_airport_lines, parse_carrier_lines, parse_country_code_lines


@pytest.fixture()
def kept(spark, tmp_path):
    """A third of the fact rows share one key, a third has none; the dimension repeats a key 60 times."""
    r = random.Random(5)
    fact = [(7, i) for i in range(200)] + [(None, i) for i in range(200)] + [(r.randint(0, 90), i) for i in range(200)]
    dim = [(k, f"n{k % 4}") for k in range(0, 80)] + [(11, "again")] * 60 + [(None, "none")]
    spark.createDataFrame(fact, "k int, v int").repartition(4).write.parquet(f"{tmp_path}/fact")
    spark.createDataFrame(dim, "d int, name string").write.parquet(f"{tmp_path}/dim")

    def make(hot_rows):
        return (keyed_table(spark.read.parquet(f"{tmp_path}/fact"), "fact", "k", ["k", "v"], 6, hot_rows),
                keyed_table(spark.read.parquet(f"{tmp_path}/dim"), "dim", "d", ["d", "name"], 6, hot_rows))
    return make, fact, dim


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_totals_equal_plain_join(kept, hot_rows):
    make, fact, dim = kept
    f, d = make(hot_rows)
    assert f.whole().count() == len(fact) and d.whole().count() == len(dim)
    assert {x.k for x in f.hot.distinct().collect()} == ({7, None} if hot_rows == 1 else set())
    assert {x.d for x in d.hot.distinct().collect()} == ({11} if hot_rows == 1 else set())
    got = joined_totals(f, d, {"n": F.count(F.lit(1)), "s": F.sum("v")})
    assert sorted((x.d, x.name, x.n, x.s) for x in got.collect()) == sorted(
        (k, name, len(vs), sum(vs)) for k, name in dim if k is not None
        for vs in [[v for a, v in fact if a == k]] if vs)


def test_no_shuffle_below_the_join(spark, kept):
    make, _, _ = kept
    f, d = make(1_000_000)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = joined_totals(f, d, {"n": F.count(F.lit(1))})
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    cold = plan[plan.index("SortMergeJoin"):plan.index("BroadcastHashJoin")]
    assert "Exchange" not in cold and cold.count("Bucketed: true") == 2


def test_table_is_found_again_until_its_source_changes(spark, tmp_path):
    path = f"{tmp_path}/t"
    source = lambda: spark.read.parquet(path)
    spark.range(10).select("id").write.parquet(path)
    first = keyed_table(source(), "again", "id", ["id"], 4)
    assert keyed_table(source(), "again", "id", ["id"], 4).rows.inputFiles() == first.rows.inputFiles()
    assert keyed_table(source(), "again", "id", ["id"], 5).rows.inputFiles() != first.rows.inputFiles()
    spark.range(5).select("id").write.mode("append").parquet(path)
    assert keyed_table(source(), "again", "id", ["id"], 4).whole().count() == 15


def test_empty_source(spark, tmp_path):
    spark.range(0).select("id").write.parquet(f"{tmp_path}/none")
    t = keyed_table(spark.read.parquet(f"{tmp_path}/none"), "none", "id", ["id"], 4)
    assert joined_totals(t, t, {"n": F.count(F.lit(1))}).count() == 0


def test_registered_queries_share_their_tables(spark):
    sf = "/root/testdata/sf0.001"
    a, b = tables._kept(spark, sf), tables._kept(spark, sf)
    assert [t.rows.inputFiles() for t in a] == [t.rows.inputFiles() for t in b]


def test_lines_bind_by_header_and_fail_fast(spark):
    def lines(*text):
        return spark.createDataFrame([(t,) for t in text], "value string")
    got = parse_carrier_lines(lines('"Air, \\"A\\" Inc.",XY', "Plain,NA"), ["Description", "Code"])
    assert [tuple(x) for x in got.collect()] == [("XY", 'Air, "A" Inc.'), ("NA", "Plain")]
    header = ["lat", "long", "iata", "airport", "city", "state", "country"]
    got = parse_airport_lines(lines('-1.5,20,ABC,"One, Field",,S,USA'), header)
    assert [tuple(x) for x in got.collect()] == [("ABC", "One, Field", None, "S", "USA", -1.5, 20.0)]
    with pytest.raises(Exception, match="(?i)malformed"):
        parse_airport_lines(lines("north,20,ABC,One,,S,USA"), header).collect()
    with pytest.raises(ValueError, match="Code"):
        parse_country_code_lines(lines("x"), ["Name"])
    got = parse_country_code_lines(lines('"Bolivia, State of",BO', "Namibia,NA"), ["Name", "Code"])
    assert [x.Code for x in got.collect()] == ["BO", "NA"]
