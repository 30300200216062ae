"""Report datasets (P-01 .. P-06), named queries (Q-01 .. Q-09) and feeds (F-01 .. F-05).

Only the tables are built; formatting and sending are out of scope.  Named
queries are typed functions over metric tables: a studio argument filters,
``'all'`` selects the consolidated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlens.functions import pct, romi, safe_div


def report_daily(leads_booked: DataFrame, admin_booked: DataFrame | None = None,
                 recon: DataFrame | None = None) -> DataFrame:
    """P-01: per studio and day: leads, bookings, conversion and its change from the
    studio's previous lead day; bookings made without a lead (admin-booked, by
    visit day) and the studio's CRM<->booking mismatch %."""
    d = leads_booked.groupBy("studio_id", F.col("lead_date").alias("report_date")).agg(
        F.count(F.lit(1)).alias("leads"), F.count_if(F.col("yc_booking_id").isNotNull()).alias("bookings"))
    d = d.withColumn("conversion", pct("bookings", "leads"))
    w = Window.partitionBy("studio_id").orderBy("report_date")
    d = d.withColumn("conversion_change", F.round(F.col("conversion") - F.lag("conversion").over(w), 1))
    if admin_booked is not None:
        a = admin_booked.groupBy("studio_id", F.col("visit_date").alias("report_date")).agg(
            F.count(F.lit(1)).alias("admin_booked"))
        d = (d.join(a, ["studio_id", "report_date"], "full_outer")
             .withColumn("leads", F.coalesce("leads", F.lit(0).cast("bigint")))
             .withColumn("bookings", F.coalesce("bookings", F.lit(0).cast("bigint")))
             .withColumn("admin_booked", F.coalesce("admin_booked", F.lit(0).cast("bigint"))))
    if recon is not None:
        d = d.join(recon.select("studio_id", F.col("mismatch_pct").alias("crm_booking_mismatch_pct")),
                   "studio_id", "left")
    return d


def report_weekly_top_channels(leads_booked: DataFrame, k: int = 5) -> DataFrame:
    """P-02: the top-``k`` channels per studio and week by leads (ties by name)."""
    g = leads_booked.groupBy("studio_id", F.to_date(F.date_trunc("week", "created_at")).alias("week_start"),
                             F.coalesce("utm_source", F.lit("unknown")).alias("channel")).agg(
        F.count(F.lit(1)).alias("leads"), F.count_if(F.col("yc_booking_id").isNotNull()).alias("bookings"))
    w = Window.partitionBy("studio_id", "week_start").orderBy(F.desc("leads"), F.asc("channel"))
    return g.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def report_clients(segments: DataFrame) -> DataFrame:
    """P-03: client base per studio: clients in each activity segment."""
    seg = F.col("segment")
    return segments.groupBy("studio_id").agg(
        F.count(F.lit(1)).alias("clients"),
        *[F.count_if(seg == s).alias(s) for s in ("new", "returned", "active", "passive", "lost")])


def report_abonements(ranking: DataFrame) -> DataFrame:
    """P-04: top-3 subscription types per studio."""
    return ranking.filter("is_top3")


def report_channels(econ: DataFrame) -> DataFrame:
    """P-05: channel economics per studio and channel with studio totals and a grand
    total, and the network row per channel, from ``cube``; ratios are recomputed from the summed parts."""
    g = econ.cube("studio_id", "channel").agg(
        F.sum("leads").cast("bigint").alias("leads"), F.sum("buyers").cast("bigint").alias("buyers"),
        F.round(F.sum("revenue"), 2).alias("revenue"), F.round(F.sum("spend"), 2).alias("spend"),
        F.grouping("studio_id").alias("_gs"), F.grouping("channel").alias("_gc"))
    g = (g.withColumn("studio_id", F.when(F.col("_gs") == 1, "all").otherwise(F.col("studio_id")))
         .withColumn("channel", F.when(F.col("_gc") == 1, "all").otherwise(F.col("channel"))).drop("_gs", "_gc"))
    return (g.withColumn("cac", F.round(safe_div("spend", "buyers"), 2))
            .withColumn("romi", romi("revenue", "spend")))


def recent_days(daily: DataFrame, n: int = 5) -> DataFrame:
    """P-06: the ``n`` most recent daily rows of every studio (top-k per group)."""
    w = Window.partitionBy("studio_id").orderBy(F.desc("summary_date"))
    return daily.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


# --- named queries ----------------------------------------------------------

def _studio(df: DataFrame, studio: str) -> DataFrame:
    return df.filter(F.col("studio_id") == studio)


def q_leads(daily: DataFrame, frm: str, to: str, studio: str = "all") -> DataFrame:
    """Q-01: leads by channel in a period (channel 'all' = total)."""
    d = _studio(daily, studio).filter(F.col("summary_date").between(F.lit(frm).cast("date"), F.lit(to).cast("date")))
    return d.groupBy("studio_id", "channel").agg(F.sum("leads").cast("bigint").alias("leads"))


def q_leads_weekly(daily: DataFrame, as_of: str, studio: str = "all") -> DataFrame:
    """Q-02: leads per channel over the 7 days ending at as_of."""
    a = F.lit(as_of).cast("date")
    d = _studio(daily, studio).filter((F.col("summary_date") > F.date_sub(a, 7)) & (F.col("summary_date") <= a))
    return d.groupBy("studio_id", "channel").agg(F.sum("leads").cast("bigint").alias("leads"))


def q_conversion(conv: DataFrame, studio: str = "all") -> DataFrame:
    """Q-03: conversion by source over all days (from lead_to_booking rows)."""
    c = _studio(conv, studio).groupBy("studio_id", "utm_source").agg(
        F.sum("leads").cast("bigint").alias("leads"), F.sum("bookings").cast("bigint").alias("bookings"))
    return c.withColumn("conversion", pct("bookings", "leads"))


def q_no_shows(nsr: DataFrame, frm: str, to: str) -> DataFrame:
    """Q-06: daily no-show rows in a period."""
    return nsr.filter((F.col("grain") == "day")
                      & F.col("period_start").between(F.lit(frm).cast("date"), F.lit(to).cast("date")))


def q_historical_funnel(hist: DataFrame, date: str) -> DataFrame:
    """Q-08: the funnel on one past date."""
    return hist.filter(F.col("snapshot_date") == F.lit(date).cast("date"))


# --- feeds --------------------------------------------------------------------

def write_feed(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """F-01 .. F-05: write a feed as JSON lines, one folder per partition value."""
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.json(path)
