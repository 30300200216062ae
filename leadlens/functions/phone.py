"""Phone normalisation (N-01) and validity (N-02)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def phone_digits(col: Column | str) -> Column:
    """All non-digits removed."""
    return F.regexp_replace(F.col(col) if isinstance(col, str) else col, r"[^0-9]", "")


def normalize_phone(col: Column | str) -> Column:
    """Digits only; 11 digits starting with 8 -> leading 7; 10 digits -> '7' prefix.

    Empty input becomes NULL so that it never acts as a join key.
    """
    d = phone_digits(col)
    out = (F.when((F.length(d) == 11) & d.startswith("8"), F.concat(F.lit("7"), F.substring(d, 2, 10)))
           .when(F.length(d) == 10, F.concat(F.lit("7"), d))
           .otherwise(d))
    return F.when(F.length(d) > 0, out)


def phone_valid(col: Column | str) -> Column:
    """Valid = at least 10 digits, not all one digit (so not ten zeros).

    The test runs on the digits *before* the country prefix is added, so that
    ``0000000000`` is not rescued into ``70000000000``.
    """
    d = phone_digits(col)
    return F.coalesce((F.length(d) >= 10) & ~d.rlike(r"^(.)\1*$"), F.lit(False))


def normalize_digits(d: Column) -> Column:
    """``normalize_phone`` for a column that already holds only digits."""
    out = (F.when((F.length(d) == 11) & d.startswith("8"), F.concat(F.lit("7"), F.substring(d, 2, 10)))
           .when(F.length(d) == 10, F.concat(F.lit("7"), d))
           .otherwise(d))
    return F.when(F.length(d) > 0, out)


def digits_valid(d: Column) -> Column:
    """``phone_valid`` for a column that already holds only digits."""
    return F.coalesce((F.length(d) >= 10) & ~d.rlike(r"^(.)\1*$"), F.lit(False))


def with_phone(df, raw: str = "client_phone"):
    """Add ``phone`` and ``phone_valid``; the digits are extracted once per row."""
    d = df.withColumn("_digits", phone_digits(raw))
    return (d.select("*", normalize_digits(F.col("_digits")).alias("phone"),
                     digits_valid(F.col("_digits")).alias("phone_valid"))
            .drop("_digits"))
