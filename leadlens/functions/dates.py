"""Date and time expressions; all timestamps are TIMESTAMP_NTZ wall clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def business_date(col: Column | str, tz: Column | str | None = None) -> Column:
    """Business date of a UTC wall-clock timestamp in the studio's time zone (N-15).

    ``tz`` is a zone name or a Column holding one (e.g. the studio's zone).

    ``convert_timezone`` works on TIMESTAMP_NTZ, so the result does not depend
    on the session time zone.
    """
    ts = _c(col)
    if tz is None:
        return F.to_date(ts)
    zone = F.lit(tz) if isinstance(tz, str) else tz
    return F.to_date(F.convert_timezone(F.lit("UTC"), zone, ts.cast("timestamp_ntz")))


def week_start(col: Column | str) -> Column:
    """Monday of the week."""
    return F.to_date(F.date_trunc("week", _c(col)))


def ceil_day(col: Column | str) -> Column:
    """First midnight at or after the timestamp, as a date."""
    ts = _c(col)
    d = F.to_date(ts)
    return F.when(ts == d.cast("timestamp_ntz"), d).otherwise(F.date_add(d, 1))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Exact hours from start to end (double)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(3_600_000_000.0)
