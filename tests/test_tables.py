"""Every registered query against its SQL oracle (DuckDB) at sf0.001, plus
the rows-only queries and the smoke entry."""

import duckdb
import pytest

import __spark_entry__ as entry
from aloft.plans.tables import ORACLE_SQL, QUERIES
from tools.compare import norm, rows_key, spark_rows, sql_rows, views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    views(c, SF)
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    cols, got = spark_rows(entry.queries()[name](spark, SF))
    want_cols, want = sql_rows(con, entry.oracle_sql()[name])
    assert cols == want_cols
    assert rows_key(got) == rows_key(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows_only_queries_run(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() >= 1


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["n_name", "Num"] and df.count() >= 0


# The operators return sorted rows, checked with DuckDB's ORDER BY
ORDERED = {
    "count_by_key": '"count" DESC, l_suppkey',
    "route_counts": "Num DESC, n_name",
    "two_sided_mean": 'mean_value, "key"',
    "conditional_share": "percentage DESC, n_name DESC, r_name DESC",
    "word_count": '"count" DESC, word',
    "word_count_documents": '"count" DESC, word',
    "moving_average": '"date"',
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_row_order(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = ", ".join(f'"{c}"' for c in df.columns)
    got = [tuple(norm(x) for x in r) for r in df.collect()]
    want = con.execute(f"SELECT {cols} FROM ({ORACLE_SQL[name]}) ORDER BY {ORDERED[name]}").fetchall()
    want = [tuple(norm(x) for x in r) for r in want]
    assert got == want and len(got) > 1
