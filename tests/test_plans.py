"""Plan-shape guards for the registered queries: the scale properties the
design relies on, checked on the physical plans at sf0.001."""

import re

import pytest

import __spark_entry__ as entry
from aloft.plans.tables import QUERIES

SF = "/root/testdata/sf0.001"
# these return plans over tables they wrote
ITERATIVE = {"pagerank", "pagerank_top", "fit_predict", "evaluate", "triplets", "median", "p95",
             "category_index_distributed", "median_by_group", "exact_split", "route_counts_kept", "conditional_share_kept"}
SF_LARGE = "/root/testdata/sf0.1"


def _executed(spark, name):
    """The plan that ran at sf0.1, shuffles that AQE replaced too late included."""
    df = entry.queries()[name](spark, SF_LARGE)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _plan(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")   # untruncated scan metadata
    try:
        df = entry.queries()[name](spark, SF)
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_and_no_python(spark, name):
    plan = _plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ITERATIVE))
def test_aggregations_are_partial_before_the_shuffle(spark, name):
    # every aggregate that consumes a shuffle is fed by a map-side aggregate
    lines = [ln.strip(" :+-") for ln in _plan(spark, name).splitlines()]
    agg = ("HashAggregate", "ObjectHashAggregate", "SortAggregate")
    for i in range(len(lines) - 2):
        if lines[i].startswith(agg) and lines[i + 1].startswith("Exchange "):
            assert lines[i + 2].startswith(agg), f"{name}: {lines[i + 1]}"


@pytest.mark.parametrize("name,needle", [
    ("filter_project", "EqualTo(o_orderpriority,1-URGENT)"),
    ("filter_measure", "EqualTo(p_brand,Brand#13)"),
    ("anti_lookup", "EqualTo(o_orderstatus,F)"),
    ("route_counts", "EqualTo(o_orderstatus,F)"),
])
def test_filters_reach_the_scan(spark, name, needle):
    plan = _plan(spark, name)
    pushed = " ".join(re.findall(r"PushedFilters: \[([^\]]*)\]", plan))
    assert needle in pushed


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "player_convert")
    assert "text" not in " ".join(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))


def test_semi_filter_does_not_shuffle_the_fact(spark):
    plan = _executed(spark, "semi_filter")
    shuffles = re.findall(r"Exchange hashpartitioning\(([a-z_]+)", plan)
    assert "l_suppkey" not in shuffles and "l_partkey" not in shuffles
    assert plan.count("BroadcastHashJoin") >= 2


@pytest.mark.parametrize("name", ["route_counts", "conditional_share", "count_by_key",
                                  "two_sided_mean", "word_count_documents"])
def test_executed_plans_aggregate_before_they_shuffle(spark, name):
    # no raw row of a fact is shuffled: below every exchange by key stands an aggregate
    lines = [ln.strip(" :+-*()0123456789") for ln in _executed(spark, name).splitlines()]
    found = 0
    for i, line in enumerate(lines):
        if line.startswith("Exchange hashpartitioning"):
            found += 1
            assert lines[i + 1].startswith(("HashAggregate", "Project", "BroadcastHashJoin",
                                            "Filter")), (name, lines[i:i + 2])
    assert found
