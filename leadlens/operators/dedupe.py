"""Deterministic deduplication (N-10) as an aggregate, not a window.

``groupBy(keys).agg(max(struct(order..., rest...)))`` keeps the row that is
greatest in a *total* order (the ordering columns first, then every other
column), so the result never depends on row order.  Being an aggregate it
combines map-side: a key with millions of copies leaves each map task as a
single row instead of landing whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order_desc: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order_desc`` then by all remaining columns."""
    rest = [c for c in df.columns if c not in keys and c not in order_desc]
    fields = order_desc + rest
    row = F.max(F.struct(*[F.col(c) for c in fields])).alias("_row")
    agg = df.groupBy(*keys).agg(row)
    return agg.select(*[F.col(c) if c in keys else F.col("_row." + c).alias(c) for c in df.columns])
