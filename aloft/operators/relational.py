"""Relational operators (Q02-Q07, Q10, Q14, Q15, Q17).

Each takes DataFrames plus column names, so the flight/place questions and
the registered table queries share one implementation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aloft.constants import DOMESTIC_COUNTRY
from aloft.operators.joins import semi_filter


def count_by_key(df: DataFrame, key: str, count_col: str = "count") -> DataFrame:
    """A01+O01 (Q02): rows per key, most first; the key breaks ties."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.desc(count_col), F.asc_nulls_first(key)))


def filter_project(df: DataFrame, predicate: Column, columns: list[str]) -> DataFrame:
    """P01/P07 (Q03): plain filter + projection; duplicates kept."""
    return df.where(predicate).select(*columns)


def filtered_max(df: DataFrame, value_col: str, predicate: Column, out_col: str) -> DataFrame:
    """A03/P08 (Q04): one row holding max(value) over the qualifying rows (NULL if none)."""
    return df.where(predicate).agg(F.max(value_col).alias(out_col))


def route_counts(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, label: str,
                 predicate: Column | None = None, out_col: str = "Num",
                 label_out: str | None = None, weight_col: str | None = None) -> DataFrame:
    """J03+A01 (Q06): qualifying fact rows per dimension label, most first.

    The fact side is counted per join key before the join (map-side partial
    aggregation, so the join sees one row per key instead of every fact row).
    ``weight_col`` counts each fact row that many times (for pre-counted facts).
    """
    f = fact.where(predicate) if predicate is not None else fact
    n = F.sum(weight_col) if weight_col else F.count(F.lit(1))
    per_key = f.groupBy(F.col(fact_key).alias("__k")).agg(n.alias("__n"))
    d = dim.select(F.col(dim_key).alias("__dk"), F.col(label).alias("__lbl"))
    label_out = label_out or label
    return (per_key.join(d, per_key["__k"] == d["__dk"])
            .groupBy(F.col("__lbl").alias(label_out))
            .agg(F.sum("__n").alias(out_col))
            .orderBy(F.desc(out_col), F.asc_nulls_first(label_out)))


def two_sided_mean(df: DataFrame, key_a: str, value_a: str, key_b: str, value_b: str,
                   out_key: str = "airport", out_value: str = "taxi",
                   require_both: bool = True) -> DataFrame:
    """U01+A04 (Q07): mean of ``value_a`` keyed by ``key_a`` pooled with
    ``value_b`` keyed by ``key_b`` (one mean over all rows, not a mean of means).

    With ``require_both`` a key must occur on both sides.  One scan (each row
    yields its two (key, value, side) rows), one shuffle, partial aggregation
    map-side: a key holding a third of the rows is reduced to one partial row
    per input partition before the exchange.
    """
    key_type = df.schema[key_a].dataType
    sides = F.array(
        F.struct(F.col(key_a).alias("k"), F.col(value_a).cast("double").alias("v"),
                 F.lit(1).alias("a"), F.lit(0).alias("b")),
        F.struct(F.col(key_b).cast(key_type).alias("k"), F.col(value_b).cast("double").alias("v"),
                 F.lit(0).alias("a"), F.lit(1).alias("b")))
    # one pass over the input (one CSV parse for file inputs), two rows out per row
    rows = df.select(F.explode(sides).alias("__s")).select(
        F.col("__s.k").alias(out_key), F.col("__s.v").alias("__v"),
        F.col("__s.a").alias("__a"), F.col("__s.b").alias("__b"))
    g = (rows.where(F.col(out_key).isNotNull())
         .groupBy(out_key)
         .agg(F.avg("__v").alias(out_value), F.max("__a").alias("__ha"),
              F.max("__b").alias("__hb")))
    if require_both:
        g = g.where((F.col("__ha") == 1) & (F.col("__hb") == 1))
    return g.select(out_key, out_value).orderBy(F.asc_nulls_first(out_value), out_key)


def domestic_only(df: DataFrame, airports: DataFrame, origin: str = "Origin",
                  dest: str = "Dest", country_col: str = "country",
                  country: str = DOMESTIC_COUNTRY) -> DataFrame:
    """Flights whose origin and destination are both airports of ``country``."""
    local = airports.where(F.col(country_col) == country)
    return semi_filter(semi_filter(df, origin, local, "iata"), dest, local, "iata")


def conditional_share(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                      flag: Column, group_cols: list[str], out_col: str = "percentage",
                      positive_only: bool = True) -> DataFrame:
    """A07+J04 (Q10): share of fact rows with ``flag`` per dimension group.

    One pass: the fact is pre-aggregated per join key (flagged and total
    counts), joined once to the dimension and re-aggregated per group, so the
    two scans and the join of two aggregates in the original formulation
    become a single conditional aggregate.  Groups without a flagged row are
    dropped when ``positive_only``.
    """
    per_key = (fact.groupBy(F.col(fact_key).alias("__k"))
               .agg(F.count(F.lit(1)).alias("__n"),
                    F.sum(F.when(flag, 1).otherwise(0)).alias("__f")))
    g = (per_key.join(dim, per_key["__k"] == dim[dim_key])
         .groupBy(*group_cols)
         .agg(F.sum("__f").alias("__f"), F.sum("__n").alias("__n")))
    if positive_only:
        g = g.where(F.col("__f") > 0)
    return (g.select(*group_cols, (F.col("__f") / F.col("__n")).alias(out_col))
            .orderBy(F.desc(out_col), *[F.desc(c) for c in group_cols]))


def field_mean(df: DataFrame, value_col: str, out_col: str) -> DataFrame:
    """A11 (Q15): mean of a column, one row."""
    return df.agg(F.avg(value_col).alias(out_col))


def top1_with_lookup(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str,
                     lookup_value: str, out_col: str = "country") -> DataFrame:
    """O05+J06 (Q17): the most frequent key, translated through ``lookup``;
    '' when the key has no entry.  Ties go to the smallest key.

    The fact is scanned once: a partial count per key, then
    ``orderBy().limit(1)`` (TakeOrderedAndProject, no global sort).  The
    one-row winner is left-joined to the lookup reduced to one name per code
    (a dimension-sized aggregate, broadcast by AQE when small).
    """
    top = (df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
           .orderBy(F.desc("__n"), F.asc_nulls_last(key)).limit(1)
           .select(F.col(key).alias("__top")))
    names = (lookup.groupBy(F.col(lookup_key).alias("__lk"))
             .agg(F.min(lookup_value).alias("__name")))
    return (top.join(names, F.col("__top") == F.col("__lk"), "left")
            .select(F.coalesce(F.col("__name"), F.lit("")).alias(out_col)))
