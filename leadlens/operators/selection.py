"""Exact quantiles by two-pass selection, without a buffer of a group's values.

``percentile`` holds the distinct values of a group in one task.  Here

1. values are counted (one row per key and distinct value, combined map-side);
2. a sketch of each key's values gives cut points that deal them to ``BLOCKS`` blocks of about
   equal size.  It only deals: the result does not depend on it;
3. the blocks' counts, at most ``BLOCKS`` rows a key, are summed up in order; only blocks that
   hold a wanted rank go on, and the running count inside such a block finds the value.

So the ordered work on a key that holds a third of all rows is a ``2 / BLOCKS`` share of its
distinct values, and blocks are different tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCKS = 64


def same_keys(a: str, b: str, keys: list[str]) -> Column:
    """Null-safe equality of the keys of two aliased tables."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def exact_quantiles(df: DataFrame, keys: list[str], value: Column, quantiles: dict[str, float],
                    unit: float = 1.0) -> DataFrame:
    """``keys`` and a double column per quantile: the interpolated quantile (as ``percentile``)
    of ``value / unit``.  ``value``: whole numbers; nulls do not count, and a key without any
    value has no row.  Null keys are a group."""
    counts = df.select(*keys, value.cast("bigint").alias("_v")).filter("_v IS NOT NULL").groupBy(*keys, "_v").agg(
        F.count(F.lit(1)).alias("_n"))
    cuts = counts.groupBy(*keys).agg(
        F.percentile_approx("_v", [i / BLOCKS for i in range(1, BLOCKS)], 1000).alias("_cuts"), F.sum("_n").alias("_total"))
    pos = [(F.col("_total") - 1) * F.lit(float(q)) for q in quantiles.values()]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in pos])))
    c = counts.alias("c").join(cuts.alias("k"), same_keys("c", "k", keys)).select(
        "c.*", F.size(F.filter("k._cuts", lambda x: x < F.col("c._v"))).alias("_b"), "k._total", ranks.alias("_ranks"))
    order = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = c.groupBy(*keys, "_b").agg(F.sum("_n").alias("_s"), F.first("_ranks").alias("_ranks"))
    wanted = sums.select(*keys, "_b", "_ranks", (F.sum("_s").over(order) - F.col("_s")).alias("_base"), "_s").filter(
        F.exists("_ranks", lambda r: (r >= F.col("_base")) & (r < F.col("_base") + F.col("_s"))))
    inside = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = c.alias("c").join(wanted.alias("w"), same_keys("c", "w", [*keys, "_b"])).select("c.*", "w._base")
    found = found.withColumn("_end", F.col("_base") + F.sum("_n").over(inside))
    at = lambda r: F.max(F.when((r >= F.col("_end") - F.col("_n")) & (r < F.col("_end")), F.col("_v")))
    cols = []
    for name, p in zip(quantiles, pos):
        lo, hi = at(F.floor(p)) / F.lit(unit), at(F.ceil(p)) / F.lit(unit)
        part = F.first(p) - F.floor(F.first(p))
        cols.append(F.when(part == 0, lo).otherwise((F.lit(1.0) - part) * lo + part * hi).alias(name))
    return found.groupBy(*keys).agg(*cols)
