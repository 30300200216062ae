"""Per-studio plus consolidated ('all') aggregates in one pass (M-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_consolidated(df: DataFrame, studio: str, keys: list[str], aggs: list[Column],
                      all_label: str = "all") -> DataFrame:
    """GROUPING SETS ((studio, keys...), (keys...)).

    The consolidated row is told apart with ``grouping(studio)``, never by a
    NULL test, so a genuine NULL in ``keys`` survives next to its total.
    """
    sets = [[F.col(studio)] + [F.col(k) for k in keys], [F.col(k) for k in keys]]
    g = df.groupingSets(sets, studio, *keys).agg(*aggs, F.grouping(studio).alias("_g_studio"))
    return (g.withColumn(studio, F.when(F.col("_g_studio") == 1, F.lit(all_label))
                         .otherwise(F.col(studio)))
            .drop("_g_studio"))
