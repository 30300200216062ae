"""Ratio expressions: NULL on a zero or NULL denominator, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def safe_div(num: Column | str, den: Column | str) -> Column:
    return F.try_divide(_c(num).cast("double"), F.when(_c(den) != 0, _c(den).cast("double")))


def pct(num: Column | str, den: Column | str, digits: int = 1) -> Column:
    """``round(100 * num / den, digits)`` as a double."""
    return F.round(F.lit(100.0) * safe_div(num, den), digits)


def romi(revenue: Column | str, cost: Column | str, digits: int = 1) -> Column:
    """ROMI = (revenue - cost) / cost * 100, NULL when cost is 0."""
    return F.round(F.lit(100.0) * safe_div(_c(revenue) - _c(cost), cost), digits)
