"""Least-squares line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def least_squares(df: DataFrame, x: str, y: str, x_min: float | None = 0,
                  intercept_col: str = "intercept", slope_col: str = "slope") -> DataFrame:
    """Fit ``y = intercept + slope * x`` through one point per distinct ``x``
    (the mean ``y`` of that x), over rows with ``x >= x_min``.

    One grouped aggregate (partial + final) and one global ``regr_*``
    aggregate; no driver round trips.  With fewer than two complete points
    the line is undefined and (0.0, 0.0) is returned.
    """
    src = df.where(F.col(x) >= x_min) if x_min is not None else df
    pts = src.groupBy(F.col(x).cast("double").alias("__x")).agg(
        F.avg(F.col(y).cast("double")).alias("__y"))
    fit = pts.agg(F.regr_count("__y", "__x").alias("__n"),
                  F.regr_intercept("__y", "__x").alias("__c"),
                  F.regr_slope("__y", "__x").alias("__b"))
    ok = F.col("__n") >= 2
    return fit.select(
        F.coalesce(F.when(ok, F.col("__c")), F.lit(0.0)).alias(intercept_col),
        F.coalesce(F.when(ok, F.col("__b")), F.lit(0.0)).alias(slope_col))
