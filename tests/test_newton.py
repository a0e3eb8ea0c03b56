import math
import random

import numpy as np
import pytest

from aloft.operators import ml


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(5)
    data = []
    for i in range(600):
        a, b = r.gauss(0, 1), r.gauss(50, 10)
        y = float(r.random() < 1 / (1 + math.exp(-(0.4 + 1.5 * a - 0.05 * (b - 50)))))
        data.append((i, a, b, 2 * a + 1, y))
    return spark.createDataFrame(data, "id long, a double, b double, twice double, label double").cache()


def test_gradient_vanishes_at_the_fit(rows):
    fit = ml.fit_newton(rows, ["a", "b"], "label", max_iter=30)
    assert fit.converged and fit.iterations < 12
    scored = ml.predict_newton(fit, rows).toPandas()
    rest = scored.label - scored.p_positive
    assert abs(rest.sum()) < 1e-6 and abs((rest * scored.a).sum()) < 1e-6 and abs((rest * scored.b).sum()) < 1e-5
    assert ((scored.p_positive > 0.5) == (scored.prediction == 1.0)).all()


def test_equals_the_library_solver_at_convergence(rows):
    fit = ml.fit_newton(rows, ["a", "b"], "label", max_iter=30)
    model = ml.fit_logistic(ml.assemble(rows, ["a", "b"]), "features", "label", max_iter=200, tol=1e-12)
    assert [fit.intercept, *fit.coefficients] == pytest.approx([model.intercept, *model.coefficients], abs=1e-4)


def test_steps_do_not_depend_on_scale_or_order(rows):
    one = ml.fit_newton(rows, ["a", "b"], "label", max_iter=2)
    other = ml.fit_newton(rows.withColumn("b", rows.b * 1000).repartition(7), ["a", "b"], "label", max_iter=2)
    assert not one.converged and one.iterations == 2
    assert one.coefficients[1] == pytest.approx(other.coefficients[1] * 1000, rel=1e-9)
    assert one.intercept == pytest.approx(other.intercept, rel=1e-9)


def test_determined_and_constant_features_are_left_out(rows):
    plain = ml.fit_newton(rows, ["a", "b"], "label", max_iter=20)
    more = ml.fit_newton(rows.selectExpr("*", "3.0D AS same"), ["a", "b", "twice", "same"], "label", max_iter=20)
    assert more.coefficients[2:] == (0.0, 0.0)
    assert more.coefficients[:2] == pytest.approx(plain.coefficients, rel=1e-6)


def test_nulls_add_nothing_and_no_rows_raise(spark, rows):
    holes = rows.select("a", "b", "label").union(spark.createDataFrame(
        [(None, 1.0, 1.0), (1.0, None, 0.0), (1.0, 2.0, None)], "a double, b double, label double"))
    assert ml.fit_newton(holes, ["a", "b"], "label") == ml.fit_newton(rows, ["a", "b"], "label") or np.allclose(
        ml.fit_newton(holes, ["a", "b"], "label").coefficients, ml.fit_newton(rows, ["a", "b"], "label").coefficients)
    with pytest.raises(ValueError):
        ml.fit_newton(rows.where("id < 0"), ["a"], "label")


def test_one_aggregate_an_iteration(rows):
    x = rows.selectExpr("a", "b", "label")
    plan = x.agg({"a": "sum"})._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
