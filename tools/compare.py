"""Compare a registered query with its SQL: column names and the multiset of rows."""

from __future__ import annotations

import math

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def views(con, sf_dir: str) -> None:
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")


def norm(v, strict: bool = False):
    """One spelling per value; floats to nine digits unless ``strict``."""
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v if strict else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, int) and not isinstance(v, bool):
        return float(v)
    return v


def rows_key(rows, strict: bool = False) -> list[tuple]:
    return sorted((tuple(norm(x, strict) for x in r) for r in rows), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    return cols, [tuple(r[c] for c in cols) for r in df.collect()]


def sql_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(cols), [tuple(r[i] for i in order) for r in rel.fetchall()]
