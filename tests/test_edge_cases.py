"""Edge cases (empty input, all-NULL columns, NULL keys, ties) and
brute-force cross-checks of the operators on random data."""

import datetime
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from aloft.operators import (anti_lookup, conditional_share, count_by_key, count_within,
                             least_squares, moving_average, route_counts, two_sided_mean,
                             word_count)
from aloft.functions import haversine_km


def test_empty_inputs(spark):
    e = spark.createDataFrame([], "k string, a string, v int, b string, w int, d date, t string")
    assert count_by_key(e, "k").collect() == []
    assert two_sided_mean(e, "a", "v", "b", "w").collect() == []
    assert moving_average(e, F.col("d"), "v").collect() == []
    assert word_count(e, "t").collect() == []
    assert tuple(least_squares(e, "v", "w").first()) == (0.0, 0.0)


def test_all_null_measure(spark):
    df = spark.createDataFrame([(datetime.date(2020, 1, 1), None), (datetime.date(2020, 1, 2),
                                                                    None)], "d date, v int")
    rows = moving_average(df, F.col("d"), "v").collect()
    assert [r["moving_average"] for r in rows] == [None, None]   # 0/0 -> NULL, no error


def test_null_keys_and_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",), ("b",), (None,)], "k string")
    assert [tuple(r) for r in count_by_key(df, "k").collect()] == [(None, 2), ("a", 2), ("b", 2)]
    words = spark.createDataFrame([("b a",), (None,), ("",), ("a  b",)], "t string")
    assert [tuple(r) for r in word_count(words, "t").collect()] == [("a", 2), ("b", 2)]


def test_anti_lookup_null_dim_key_kept(spark):
    dim = spark.createDataFrame([("X", "x"), (None, "n"), ("Y", "y")], "code string, d string")
    fact = spark.createDataFrame([("X",), (None,)], "c string")
    got = sorted(r["d"] for r in anti_lookup(dim, fact, "code", "c", ["d"]).collect())
    assert got == ["n", "y"]


def test_route_counts_and_share_against_brute_force(spark):
    rnd = random.Random(5)
    # key 0 holds a third of all fact rows
    fact = [(0 if i % 3 == 0 else rnd.randint(1, 40), rnd.choice("AB"), rnd.random() < 0.3)
            for i in range(3000)]
    dim = [(k, f"name{k % 7}") for k in range(0, 45)]
    fdf = spark.createDataFrame(fact, "k int, s string, flag boolean")
    ddf = spark.createDataFrame(dim, "dk int, label string")
    got = {r["label"]: r["Num"] for r in
           route_counts(fdf, ddf, "k", "dk", "label", F.col("s") == "A").collect()}
    exp = Counter(f"name{k % 7}" for k, s, _ in fact if s == "A")
    assert got == dict(exp)
    share = {r["label"]: r["percentage"] for r in
             conditional_share(fdf, ddf, "k", "dk", F.col("flag"), ["label"]).collect()}
    tot, hit = Counter(), Counter()
    for k, _, flag in fact:
        tot[f"name{k % 7}"] += 1
        hit[f"name{k % 7}"] += flag
    assert share == pytest.approx({n: hit[n] / tot[n] for n in tot if hit[n] > 0})


def test_two_sided_mean_against_brute_force(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice("PQRST"), rnd.choice([None, rnd.randint(0, 20)]),
             rnd.choice("RSTUV"), rnd.randint(0, 20)) for _ in range(500)]
    df = spark.createDataFrame(rows, "a string, va int, b string, vb int")
    got = {r["airport"]: r["taxi"] for r in two_sided_mean(df, "a", "va", "b", "vb").collect()}
    vals, sa, sb = defaultdict(list), set(), set()
    for a, va, b, vb in rows:
        sa.add(a)
        sb.add(b)
        if va is not None:
            vals[a].append(va)
        vals[b].append(vb)
    exp = {k: sum(v) / len(v) for k, v in vals.items() if k in sa and k in sb}
    assert got == pytest.approx(exp)


def test_moving_average_against_brute_force(spark):
    rnd = random.Random(11)
    base = datetime.date(2021, 1, 1)
    rows = [(base + datetime.timedelta(days=rnd.choice([0, 1, 2, 9, 10, 17, 30, 31])),
             rnd.randint(-10, 50), rnd.choice("xy")) for _ in range(300)]
    df = spark.createDataFrame(rows, "d date, v int, s string")
    for parts in (None, ["s"]):
        got = {(r["s"] if parts else None, r["date"]): r["moving_average"]
               for r in moving_average(df, F.col("d"), "v", partition_cols=parts).collect()}
        exp = {}
        for s, d in {(r[2] if parts else None, r[0]) for r in rows}:
            win = [v for dd, v, ss in rows if abs((dd - d).days) <= 5
                   and (parts is None or ss == s)]
            exp[(s, d.isoformat())] = sum(win) / len(win)
        assert got == pytest.approx(exp)


def test_count_within_against_brute_force(spark):
    import math
    rnd = random.Random(13)
    pts = [(f"{rnd.choice(['Hotel', 'hostel', 'HOTEL x', 'inn'])}", rnd.uniform(36, 39),
            rnd.uniform(-124, -120)) for _ in range(400)]
    df = spark.createDataFrame(pts, "name string, lat double, lon double")
    lat0, lon0, r = 37.5, -122.0, 60.0

    def hav(a, b, c, d):
        la1, lo1, la2, lo2 = map(math.radians, (a, b, c, d))
        h = math.sin((la2 - la1) / 2) ** 2 + math.sin((lo2 - lo1) / 2) ** 2 * math.cos(la1) * \
            math.cos(la2)
        return 2 * 6371.0 * math.asin(math.sqrt(min(h, 1.0)))
    exp = sum(1 for n, la, lo in pts if "hotel" in n.lower() and hav(lat0, lon0, la, lo) <= r)
    got = count_within(df, "lat", "lon", lat0, lon0, r, "name", "hotel").first()[0]
    assert got == exp > 0
    d = df.select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))).first()[0]
    assert d == pytest.approx(math.pi * 6371.0)


def test_scratch_checkpoint_folder_is_for_local_masters_only():
    from types import SimpleNamespace

    from aloft import session

    def fake(master):
        return SimpleNamespace(sparkContext=SimpleNamespace(
            master=master, getCheckpointDir=lambda: None), conf=SimpleNamespace(get=lambda k, d=None: d))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(fake(master))
