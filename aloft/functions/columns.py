"""Column expressions shared by the operators.  All are built-in Spark SQL
functions, so they stay inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aloft.constants import EARTH_RADIUS_KM


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km between two (lat, lon) points given in degrees."""
    la1, lo1, la2, lo2 = (F.radians(_c(v)) for v in (lat1, lon1, lat2, lon2))
    h = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.pow(F.sin((lo2 - lo1) / 2), 2) * F.cos(la1) * F.cos(la2))
    # least() guards asin against h drifting above 1.0 through rounding
    return F.lit(2.0 * radius_km) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def text_flag(col, word: str) -> Column:
    """1.0 when the trimmed text equals ``word`` ignoring case, else 0.0."""
    return F.when(F.lower(F.trim(_c(col))) == word.lower(), F.lit(1.0)).otherwise(F.lit(0.0))


def date_from_parts(year, month, day) -> Column:
    return F.make_date(_c(year), _c(month), _c(day))


def literal_pattern(sep: str) -> str:
    """Java regex matching ``sep`` literally (every non-alphanumeric escaped)."""
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in sep)


def split_words(col, sep: str = " ") -> Column:
    """Array of the pieces of ``col`` split on the literal separator (empty pieces kept)."""
    return F.split(_c(col), literal_pattern(sep))
