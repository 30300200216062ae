"""Event metrics (T-01 .. T-10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlens.functions import ceil_day, week_start
from leadlens.operators.broadcast import bounded_broadcast
from leadlens.operators.grouping import with_consolidated
from leadlens.operators.selection import exact_quantiles, same_keys

MICROS_PER_HOUR = 3_600_000_000.0


def _hours_avg(start: str, end: str):
    """Exact mean: sum of integer microseconds, one division, rounded to 4."""
    return F.round(F.avg(F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))) / F.lit(MICROS_PER_HOUR), 4)


def transitions(events: DataFrame) -> DataFrame:
    """T-01: per studio, day, from, to: lead count and mean hours spent on the previous stage."""
    sc = events.filter(F.col("event_type") == "status_changed")
    return (sc.groupBy("studio_id", F.to_date("event_ts").alias("transition_date"), "stage_from", "stage_to")
            .agg(F.count(F.lit(1)).alias("lead_count"),
                 _hours_avg("prev_event_ts", "event_ts").alias("avg_duration_hours")))


def stage_durations(snaps: DataFrame, approx: bool = False, accuracy: int = 10_000) -> DataFrame:
    """T-02: closed intervals per studio, week (Monday of valid_from), stage:
    mean, median and p95 hours and the number of intervals (open ones excluded).

    Quantiles are exact, by ``exact_quantiles``.  ``approx=True`` uses
    ``percentile_approx`` (a mergeable sketch of bounded size per group) in one pass.
    """
    keys = ["studio_id", "week_start", "stage_name"]
    closed = snaps.filter(F.col("valid_to").isNotNull()).select(
        "studio_id", week_start("valid_from").alias("week_start"), F.col("stage").alias("stage_name"),
        F.timestamp_diff("MICROSECOND", F.col("valid_from"), F.col("valid_to")).alias("us"))
    mean = F.round(F.avg("us") / F.lit(MICROS_PER_HOUR), 4).alias("avg_duration_hours")
    n = F.count(F.lit(1)).alias("lead_count")
    if approx:
        q = F.percentile_approx(F.col("us") / F.lit(MICROS_PER_HOUR), [0.5, 0.95], accuracy)
        return closed.groupBy(*keys).agg(mean, F.round(q[0], 4).alias("median_duration_hours"),
                                         F.round(q[1], 4).alias("p95_duration_hours"), n)
    q = exact_quantiles(closed, keys, F.col("us"), {"median_duration_hours": 0.5, "p95_duration_hours": 0.95},
                        MICROS_PER_HOUR)
    return closed.groupBy(*keys).agg(mean, n).alias("g").join(q.alias("q"), same_keys("g", "q", keys)).select(
        *[f"g.{k}" for k in keys], "avg_duration_hours", F.round("median_duration_hours", 4).alias("median_duration_hours"),
        F.round("p95_duration_hours", 4).alias("p95_duration_hours"), "lead_count")


def historical_funnel(snaps: DataFrame, as_of: str) -> DataFrame:
    """T-03: leads per studio, stage and date, for every date up to ``as_of``.

    A lead is in a stage on date d (at midnight) iff
    ``ceil_day(valid_from) <= d < ceil_day(valid_to)``.  Instead of joining
    snapshots to a calendar (rows x days), each interval emits +1 at
    ``ceil_day(valid_from)`` and -1 at ``ceil_day(valid_to)``; flows are
    pre-aggregated per studio, stage and day, spread onto a dense grid that
    starts at the studio's first flow, and summed with a running window per
    (studio, stage), whose length is bounded by the number of days.
    """
    end = F.lit(as_of).cast("date")
    # one pass over the snapshots: each interval yields (entry day, +1) and (exit day, -1)
    moves = F.array(F.struct(ceil_day("valid_from").alias("d"), F.lit(1).alias("delta")),
                    F.struct(ceil_day("valid_to").alias("d"), F.lit(-1).alias("delta")))
    flows = (snaps.select("studio_id", "stage", F.inline(moves))
             .filter(F.col("d").isNotNull() & (F.col("d") <= end))
             .groupBy("studio_id", "stage", "d").agg(F.sum("delta").alias("delta")))
    start = flows.groupBy("studio_id").agg(F.min("d").alias("d0"))
    pairs = flows.select("studio_id", "stage").distinct()
    grid = (pairs.join(start, "studio_id")
            .select("studio_id", "stage", F.explode(F.sequence("d0", end)).alias("d")))
    w = Window.partitionBy("studio_id", "stage").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    filled = (grid.join(flows, ["studio_id", "stage", "d"], "left")
              .withColumn("lead_count", F.sum(F.coalesce(F.col("delta"), F.lit(0))).over(w)))
    return filled.filter(F.col("lead_count") > 0).select(
        "studio_id", F.col("d").alias("snapshot_date"), F.col("stage").alias("stage_name"),
        F.col("lead_count").cast("bigint").alias("lead_count"))


def entered_exited(snaps: DataFrame) -> DataFrame:
    """T-04: per studio, week and stage: intervals entered and exited in that week."""
    ent = snaps.select("studio_id", "stage", week_start("valid_from").alias("week_start"),
                       F.lit(1).alias("e"), F.lit(0).alias("x"))
    ext = snaps.filter(F.col("valid_to").isNotNull()).select(
        "studio_id", "stage", week_start("valid_to").alias("week_start"), F.lit(0).alias("e"), F.lit(1).alias("x"))
    return (ent.unionByName(ext).groupBy("studio_id", "week_start", F.col("stage").alias("stage_name"))
            .agg(F.sum("e").cast("bigint").alias("entered"), F.sum("x").cast("bigint").alias("exited")))


def group_transitions(events: DataFrame, stages: DataFrame) -> DataFrame:
    """T-05: status changes between stage groups (two joins to the fixed stage table)."""
    st = bounded_broadcast(stages)
    sc = events.filter(F.col("event_type") == "status_changed")
    j = (sc.join(st.select(F.col("stage_code").alias("stage_from"), F.col("stage_group").alias("from_group")),
                 "stage_from")
         .join(st.select(F.col("stage_code").alias("stage_to"), F.col("stage_group").alias("to_group")),
               "stage_to"))
    return with_consolidated(j, "studio_id", ["from_group", "to_group"],
                             [F.count(F.lit(1)).alias("transitions")])


def current_funnel(snaps: DataFrame, stages: DataFrame) -> DataFrame:
    """T-06: leads per stage in their current state, with stage order (per studio and 'all')."""
    cur = snaps.filter(F.col("valid_to").isNull())
    st = bounded_broadcast(stages)
    j = cur.join(st, cur.stage == st.stage_code)
    return with_consolidated(j, "studio_id", ["stage_order", "stage_name"],
                             [F.count(F.lit(1)).alias("lead_count")])


def stage_conversion(trans: DataFrame, since: str) -> DataFrame:
    """T-07: one pass of conditional sums over transitions since a date."""
    t = trans.filter(F.col("transition_date") >= F.lit(since).cast("date"))
    return with_consolidated(t.withColumn("_one", F.lit(1)), "studio_id", [], [
        F.sum(F.when(F.col("stage_from") == "new", F.col("lead_count"))).alias("new_leads"),
        F.sum(F.when(F.col("stage_to") == "negotiation", F.col("lead_count"))).alias("to_negotiation"),
        F.sum(F.when(F.col("stage_to") == "abonement_sold", F.col("lead_count"))).alias("to_sold")])


def in_week(snaps: DataFrame, week: str) -> DataFrame:
    """The intervals that begin in the week of the Monday ``week`` (a range of valid_from, so it
    reaches the scan)."""
    at = lambda days: F.date_add(F.lit(week).cast("date"), days).cast("timestamp_ntz")
    return snaps.filter((F.col("valid_from") >= at(0)) & (F.col("valid_from") < at(7)))


def bottlenecks(durations: DataFrame, week: str) -> DataFrame:
    """T-08: stages of one week by median duration, longest first.  For one week of a long
    history pass ``stage_durations(in_week(snaps, week))``, which reads that week only."""
    return (durations.filter(F.col("week_start") == F.lit(week).cast("date"))
            .select("studio_id", "stage_name", "avg_duration_hours", "median_duration_hours")
            .orderBy(F.desc("median_duration_hours"), "studio_id", "stage_name"))


def read_transitions(trans: DataFrame, frm: str, to: str, stage_from: str, stage_to: str) -> DataFrame:
    """T-09: transitions of one edge in a date range."""
    return trans.filter(F.col("transition_date").between(F.lit(frm).cast("date"), F.lit(to).cast("date"))
                        & (F.col("stage_from") == stage_from) & (F.col("stage_to") == stage_to))


def bottleneck_alert(durations: DataFrame, threshold_hours: float, as_of: str) -> DataFrame:
    """T-10: one WARNING per studio, week and stage whose median exceeds the threshold."""
    d = durations.filter(F.col("median_duration_hours") > threshold_hours)
    return d.select("studio_id", F.lit("T10").alias("alert_type"), F.lit("WARNING").alias("severity"),
                    F.concat(F.lit("median_hours:"), F.col("stage_name")).alias("metric_name"),
                    F.col("median_duration_hours").alias("metric_value"),
                    F.lit(threshold_hours).alias("threshold"), "week_start")
