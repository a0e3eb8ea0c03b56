"""The exact percentile over value ranges equals Spark's exact percentile."""

import numpy as np
import pytest

from aloft.operators import builtin_percentile, exact_percentile


@pytest.mark.parametrize("p", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_exact_matches_builtin(spark, p):
    rng = np.random.default_rng(3)
    vals = list(rng.normal(size=3000).round(3))
    vals += [7.0] * 1500                                   # one value holds a third of rows
    vals += [None] * 50
    df = spark.createDataFrame([(None if v is None else float(v),) for v in vals], "x double")
    got = exact_percentile(df, "x", p, "q").first()[0]
    exp = builtin_percentile(df, "x", p, "q").first()[0]
    assert got == pytest.approx(exp, rel=1e-12, abs=1e-12)


def test_edge_cases(spark):
    empty = spark.createDataFrame([], "x int")
    assert exact_percentile(empty, "x", 0.5, "q").first()[0] is None
    one = spark.createDataFrame([(4,)], "x int")
    assert exact_percentile(one, "x", 0.95, "q").first()[0] == 4.0
    nulls = spark.createDataFrame([(None,), (None,)], "x int")
    assert exact_percentile(nulls, "x", 0.5, "q").first()[0] is None
    # ranks next to each other in different ranges
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(float(x),) for x in rng.integers(0, 500, 2000)], "x double")
    for p in (0.0, 0.37, 0.5, 1.0):
        got = exact_percentile(df, "x", p, "q").first()[0]
        assert got == builtin_percentile(df, "x", p, "q").first()[0]
    with pytest.raises(ValueError):
        exact_percentile(one, "x", 1.5, "q")
