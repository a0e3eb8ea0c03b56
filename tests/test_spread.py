"""Operators that spread over tasks what a single window, centre or group would keep in one."""

import math
import random
import re

import numpy as np
import pytest

from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from aloft.operators import geo as geo_ops
from aloft.operators import bloom_filter, bloom_semi_filter, grouped_percentile, ml, percentile, radius_join, range_mean
from aloft.sources import quarantine_csv_lines


def _km(a, b):
    p1, l1, p2, l2 = map(math.radians, (*a, *b))
    h = math.sin((p1 - p2) / 2) ** 2 + math.sin((l1 - l2) / 2) ** 2 * math.cos(p1) * math.cos(p2)
    return 2 * geo_ops.EARTH_RADIUS_KM * math.asin(math.sqrt(min(1.0, h)))


@pytest.mark.parametrize("radius, cell_rows", [(30.0, 100_000), (700.0, 20), (25_000.0, 100_000)])
def test_radius_join_equals_all_pairs(spark, monkeypatch, radius, cell_rows):
    """Poles, the date line, longitudes beyond it, equal places, a third of the points in one place."""
    monkeypatch.setattr(geo_ops, "CELL_ROWS", cell_rows)
    r = random.Random(2)
    odd = [(90.0, 0.0), (-90.0, 77.0), (89.9, 179.9), (89.9, -0.1), (0.0, 180.0), (0.0, -180.0), (0.1, 179.99), (0.0, 359.95)]
    centres = odd + [(math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180)) for _ in range(60)]
    points = odd + [(math.degrees(math.asin(r.uniform(-1, 1))), r.uniform(-180, 180)) for _ in range(150)]
    points += [(a + r.uniform(-.2, .2) * (abs(a) < 89), o + r.uniform(-.2, .2)) for a, o in centres] + [centres[20]] * 100
    schema = "id long, lat double, lon double"
    c = spark.createDataFrame([(i, *x) for i, x in enumerate(centres)] + [(900, None, 1.0)], schema)
    p = spark.createDataFrame([(i, *x) for i, x in enumerate(points)] + [(901, 1.0, None)], schema)
    made = radius_join(c.withColumnRenamed("id", "c"), p.withColumnRenamed("id", "p"), radius, centre_id="c", point_id="p")
    got = sorted((x.c, x.p) for x in made.collect())
    want = sorted((i, j) for i, a in enumerate(centres) for j, b in enumerate(points) if _km(a, b) <= radius)
    assert got == want and len(want) > 50
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_radius_join_spreads_pairs_of_one_place(spark, monkeypatch):
    """All rows in one place: pairs are dealt to tasks by their number, though the rows are few bytes."""
    monkeypatch.setattr(geo_ops, "CELL_ROWS", 50)
    monkeypatch.setattr(geo_ops, "TASK_PAIRS", 5_000, raising=False)
    c = spark.range(300).selectExpr("id AS c", "10.0D AS lat", "20.0D AS lon")
    p = spark.range(400).selectExpr("id AS p", "10.1D AS lat", "20.0D AS lon")
    made = radius_join(c, p, 50.0, centre_id="c", point_id="p")
    assert made.select("c", "p").distinct().count() == made.count() == 120_000
    of_task = [r["count"] for r in made.groupBy(F.spark_partition_id().alias("t")).count().collect()]
    assert len(of_task) >= 8 and max(of_task) <= 30_000


@pytest.mark.parametrize("width", [None, 1, 7, 1000])
def test_range_mean_equals_plain_windows(spark, width):
    """Negative instants, gaps, nulls, one instant with a third of all rows, two series."""
    r = random.Random(3)
    rows = [(r.choice("ab"), r.randint(-60, 200), r.choice([1.0, 2.5, None, -4.0])) for _ in range(300)]
    rows += [("a", 11, 3.0)] * 200 + [("a", None, 1.0), (None, 5, 1.0), ("b", 10_000, 2.0)]
    df = spark.createDataFrame(rows, "s string, t long, v double").repartition(5)
    got = {(x.s, x.at): x["mean"] for x in range_mean(df, df.t, "v", 6, ["s"], width).collect()}
    assert set(got) == {(s, t) for s, t, _ in rows if t is not None}
    for (s, t), m in got.items():
        near = [v for a, b, v in rows if a == s and b is not None and abs(b - t) <= 6 and v is not None]
        assert m == (pytest.approx(sum(near) / len(near)) if near else None)


def test_range_mean_orders_no_whole_time_line(spark):
    df = spark.range(2000).selectExpr("id AS t", "id * 1.0D AS v")
    plan = range_mean(df, df.t, "v", 5)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" in plan


def test_range_mean_frames_are_not_summed_anew(spark):
    """Frames of many instants come from running sums; a frame with both ends would be summed for each row."""
    df = spark.range(20_000).selectExpr("id * 3 AS t", "cast(id % 7 AS double) AS v")
    made = range_mean(df, df.t, "v", 30_000)
    plan = made._jdf.queryExecution().executedPlan().toString()
    frames = re.findall(r"specifiedwindowframe\((\w+), (.*?), (.*?)\)", plan)
    assert frames and all(low == "unboundedpreceding$()" for _, low, _ in frames)
    got = {x["at"]: x["mean"] for x in made.collect()}
    v = np.arange(20_000) % 7
    assert len(got) == 20_000
    for i in (0, 1, 4_999, 10_000, 19_999):
        assert got[3 * i] == pytest.approx(v[max(0, i - 10_000):i + 10_001].mean(), rel=1e-12)


def test_range_mean_keeps_small_values_beside_huge_ones(spark):
    rows = [(0, 1e300), (5, float("inf")), (100, 1.0), (101, 3.0), (205, float("nan")), (300, 0.1), (306, 0.2)]
    df = spark.createDataFrame(rows, "t long, v double")
    got = {x["at"]: x["mean"] for x in range_mean(df, df.t, "v", 6).collect()}
    assert got[100] == 2.0 and got[300] == pytest.approx(0.15, rel=1e-15)
    assert got[0] == math.inf and math.isnan(got[205])


@pytest.mark.parametrize("p", [0.0, 0.37, 0.5, 0.95, 1.0])
def test_grouped_percentile_equals_numpy(spark, monkeypatch, p):
    """A group of a third of all rows, one value, ties, no values, null keys, values far apart."""
    monkeypatch.setattr(percentile, "BINS", 8)
    r = random.Random(4)
    data = {("hot", 1): [r.gauss(0, 1) for _ in range(400)], ("one", 1): [3.0], ("ties", 2): [1.0] * 30 + [2.0] * 31,
            (None, 1): [1e-300, 1e300, -1e300, 5.0], ("two", None): [1.0, 4.0], ("none", 0): [None, None],
            ("mix", 5): [r.choice([None, r.uniform(-1e6, 1e6), 7.0]) for _ in range(200)]}
    rows = [(*k, v) for k, values in data.items() for v in values]
    df = spark.createDataFrame(rows, "a string, b int, v double").repartition(4)
    got = {(x.a, x.b): x.q for x in grouped_percentile(df, ["a", "b"], "v", p, "q").collect()}
    assert set(got) == set(data)
    for k, values in data.items():
        some = [v for v in values if v is not None]
        assert got[k] == (pytest.approx(float(np.quantile(some, p)), rel=1e-12, abs=1e-310) if some else None), k


def test_grouped_percentile_bounds(spark):
    none = spark.createDataFrame([], "a string, v double")
    assert grouped_percentile(none, ["a"], "v", 0.5, "q").count() == 0
    with pytest.raises(ValueError):
        grouped_percentile(none, ["a"], "v", 1.5, "q")


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_exact_split_has_exact_sizes(spark, monkeypatch, fraction):
    """Strata of one row and of a third of all rows, null strata, null and repeated keys."""
    monkeypatch.setattr(percentile, "BINS", 16)
    rows = [(i, "hot", "x") for i in range(300)] + [(i, f"s{i % 9}", None) for i in range(200)]
    rows += [(None, None, "y")] * 41 + [(7, "same", "z")] * 60 + [(1, "one", "q")]
    df = spark.createDataFrame(rows, "id long, s string, v string").repartition(4)
    got = ml.exact_split(df, "id", ["s", "v"], fraction, seed=3).collect()
    assert Counter((r.id, r.s, r.v) for r in got) == Counter(rows)
    size, train = Counter((r.s, r.v) for r in got), Counter((r.s, r.v) for r in got if r.in_train)
    assert all(train[k] == math.floor(n * fraction + 0.5) for k, n in size.items())


def test_exact_split_grows_with_the_fraction(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(200)], "id long, s int")
    few, many = ({r.id for r in ml.exact_split(df, "id", ["s"], f).collect() if r.in_train} for f in (0.3, 0.7))
    assert few < many
    assert few == {r.id for r in ml.exact_split(df.repartition(7), "id", ["s"], 0.3).collect() if r.in_train}


def test_quarantine_parts_every_line(spark):
    schema = StructType([StructField("a", IntegerType()), StructField("b", DoubleType()), StructField("c", StringType())])
    lines = ["1,2.5,x", "NA,NA,NA", "1,2.5", "1,2.5,x,y", "one,2.5,x", "1,two,x", "one,two,x", '3,4,"q,r"', "", "5,,", None]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(lines)], "k int, value string")
    rows = {r.k: r for r in quarantine_csv_lines(df, schema, options={"nullValue": "NA"}, keep=["k"]).collect()}
    assert len(rows) == len(lines)
    good = {k: tuple(r)[1:4] for k, r in rows.items() if r.reason is None}
    assert good == {0: (1, 2.5, "x"), 1: (None, None, None), 7: (3, 4.0, "q,r"), 9: (5, None, None)}
    assert {k: r.reason for k, r in rows.items() if r.reason} == {
        2: "field count", 3: "field count", 4: "a", 5: "b", 6: "a", 8: "field count", 10: "no line"}
    assert all((r.raw == lines[k] and tuple(r)[1:4] == (None,) * 3) if r.reason else r.raw is None for k, r in rows.items())


def test_bloom_filter_lets_few_others_through(spark):
    fact = spark.range(20_000).selectExpr("id % 5000 AS k", "id")
    allowed = spark.range(500).selectExpr("id * 10 AS a").union(spark.createDataFrame([(None,), (10,)], "a long"))
    kept = bloom_filter(fact, "k", allowed, "a").cache()
    exact = {r.id for r in fact.where("k % 10 = 0").collect()}
    got = {r.id for r in kept.collect()}
    assert exact <= got and len(got) - len(exact) < 0.02 * (20_000 - len(exact))
    made = bloom_semi_filter(fact, "k", allowed, "a")
    assert {r.id for r in made.collect()} == exact and made.columns == fact.columns
    nulls = spark.createDataFrame([(None, 1), (10, 2)], "k long, id long")
    assert [r.id for r in bloom_semi_filter(nulls, "k", allowed, "a").collect()] == [2]
    assert bloom_semi_filter(fact, "k", allowed.where("a < 0"), "a").count() == 0


def test_bloom_filter_comes_before_the_shuffle(spark):
    """Without small sides to broadcast, what is shuffled of the fact has passed the filter."""
    fact = spark.range(20_000).selectExpr("id % 5000 AS k", "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = bloom_semi_filter(fact, "k", spark.range(500).selectExpr("id * 10 AS a"), "a")
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = text[text.index("SortMergeJoin"):]
    assert join.index("Exchange hashpartitioning(k") < join.index("BroadcastHashJoin") < join.index("BroadcastExchange")
