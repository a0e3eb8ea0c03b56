"""Property-based checks (hypothesis) of the text and percentile operators
against plain Python on random inputs."""

import math
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aloft.operators import exact_percentile, word_count

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

texts = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from(
    list("ab \tZé\n.ß")), max_size=30)), max_size=12)


@SETTINGS
@given(texts)
def test_word_count_matches_python_split(spark, rows):
    df = spark.createDataFrame([(t,) for t in rows], "t string")
    got = {r["word"]: r["count"] for r in word_count(df, "t").collect()}
    exp = Counter(w for t in rows if t is not None for w in t.split(" ") if w != "")
    assert got == dict(exp)


def _python_percentile(values, p):
    v = sorted(x for x in values if x is not None)
    if not v:
        return None
    pos = p * (len(v) - 1)
    lo, hi = math.floor(pos), math.ceil(pos)
    return v[lo] + (pos - lo) * (v[hi] - v[lo])


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), max_size=60),
       st.sampled_from([0.0, 0.1, 0.5, 0.9, 0.95, 1.0]))
def test_exact_percentile_matches_definition(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    got = exact_percentile(df, "x", p, "q").first()[0]
    exp = _python_percentile(values, p)
    if exp is None:
        assert got is None
    else:
        assert math.isclose(got, exp, rel_tol=1e-12, abs_tol=1e-12)
