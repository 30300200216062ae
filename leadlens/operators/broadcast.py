"""Broadcast behind a checked size bound.

Configuration tables (stages, edges, rules, thresholds) are small by nature,
but a caller can pass any DataFrame.  ``bounded_broadcast`` hints a broadcast
only after checking that the table has at most ``max_rows`` rows (a
``limit(max_rows + 1).count()`` on the small side); beyond that the table is
returned as is and the planner chooses a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
