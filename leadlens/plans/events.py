"""Event core and SCD2 snapshots (E-01 .. E-11)."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens import config as C
from leadlens.operators.broadcast import bounded_broadcast
from leadlens.operators.sequence import next_row, prev_row, seq_number

LEAD_KEY = ["studio_id", "source", "lead_id"]


def lead_events(states: DataFrame) -> DataFrame:
    """E-01 / E-02: a ``created`` event for the first observation of a lead and a
    ``status_changed`` event whenever the stage differs from the previous
    observation; repeats of one stage in a row collapse.

    ``states``: studio_id, source, lead_id, stage, event_ts, obs_id.
    """
    return with_previous(stage_changes(states))


def stage_changes(states: DataFrame) -> DataFrame:
    """The events of ``lead_events`` without the time of the event before."""
    p = prev_row(states, LEAD_KEY, "event_ts", "obs_id", ["stage"], prefix="prev_")
    kept = p.filter(F.col("prev_event_ts").isNull() | ~F.col("stage").eqNullSafe(F.col("prev_stage")))
    return kept.select(
        *LEAD_KEY, F.col("obs_id").alias("event_id"),
        F.when(F.col("prev_event_ts").isNull(), "created").otherwise("status_changed").alias("event_type"),
        F.col("prev_stage").alias("stage_from"), F.col("stage").alias("stage_to"), "event_ts")


def with_previous(events: DataFrame) -> DataFrame:
    """Add the time the lead entered its previous stage = that of the previous *event*."""
    return prev_row(events, LEAD_KEY, "event_ts", "event_id", [], prefix="prev_")


def deletions(prev_load: DataFrame, load: DataFrame, as_of: str) -> DataFrame:
    """E-03: ``deleted`` events for leads in the previous full load but not in this one."""
    gone = prev_load.select(*LEAD_KEY).distinct().join(load.select(*LEAD_KEY).distinct(), LEAD_KEY, "left_anti")
    return gone.select(*LEAD_KEY, F.lit("deleted").alias("event_type"),
                       F.lit(as_of).cast("timestamp_ntz").alias("event_ts"))


def snapshots(events: DataFrame) -> DataFrame:
    """E-04: SCD2 rows ``[valid_from, valid_to)``; ``valid_to`` NULL = current."""
    n = next_row(events.select(*LEAD_KEY, "event_id", "stage_to", "event_ts"),
                 LEAD_KEY, "event_ts", "event_id", [], prefix="next_")
    return n.select(*LEAD_KEY, F.col("event_id").alias("snapshot_id"), F.col("stage_to").alias("stage"),
                    F.col("event_ts").alias("valid_from"), F.col("next_event_ts").alias("valid_to"))


def state_at(snaps: DataFrame, ts: str) -> DataFrame:
    """E-05: ``valid_from <= t AND (valid_to IS NULL OR valid_to > t)``."""
    t = F.lit(ts).cast("timestamp_ntz")
    return snaps.filter((F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t)))


SALTS = 16
HOURS = {"hour": 1, "day": 24, "week": 168}


def states_at(snaps: DataFrame, times: DataFrame, unit: str = "day") -> DataFrame:
    """E-05 at many instants: a row per distinct ``t`` (timestamp_ntz) of ``times`` and lead that had a state then.

    A point-in-interval join.  An interval is cut at the bounds of its time buckets (``unit``, any of
    ``date_trunc`` up to a week, about as wide as the instants are apart) between the first and the
    last instant; the pieces meet the instants of the bucket in an equi join, and the exact test
    follows.  Buckets are few and each may hold a third of all intervals: leads are dealt to
    ``SALTS`` salts, and each instant stands once for every salt.
    """
    bucket = lambda c: F.timestamp_diff("HOUR", F.lit("1970-01-05 00:00:00").cast("timestamp_ntz"),
                                        F.date_trunc(unit, c).cast("timestamp_ntz")) / F.lit(HOURS[unit])
    number = lambda c: bucket(c).cast("bigint")
    points = times.select("t").filter("t IS NOT NULL").distinct().withColumn("_bucket", number(F.col("t")))
    first, last = points.agg(F.min("t"), F.max("t")).first()
    if first is None:
        return snaps.select(F.col("valid_from").alias("t"), "*").limit(0)
    live = snaps.filter((F.col("valid_from") <= F.lit(last)) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.lit(first))))
    cut = live.withColumn("_bucket", F.explode(F.sequence(
        number(F.greatest(F.col("valid_from"), F.lit(first))),
        number(F.least(F.coalesce(F.col("valid_to"), F.lit(last)), F.lit(last)))))).withColumn(
        "_salt", F.pmod(F.xxhash64(*LEAD_KEY), F.lit(SALTS)))
    points = points.withColumn("_salt", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(SALTS)])))
    return cut.join(points, ["_bucket", "_salt"]).filter(
        (F.col("valid_from") <= F.col("t")) & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("t")))).select(
        "t", *snaps.columns)


def current_state(snaps: DataFrame) -> DataFrame:
    """E-06."""
    return snaps.filter(F.col("valid_to").isNull())


def leads_from_current(snaps: DataFrame, stages: DataFrame) -> DataFrame:
    """E-07: the current snapshot as a lead row with its stage order and group."""
    cur = current_state(snaps)
    st = bounded_broadcast(stages)
    return (cur.join(st, cur.stage == st.stage_code, "left")
            .select(*LEAD_KEY, "stage", "stage_group", "stage_order",
                    F.col("valid_from").alias("stage_since")))


def history(events: DataFrame) -> DataFrame:
    """E-08: every lead's events with their 1-based position in the lead's history."""
    return seq_number(events, LEAD_KEY, "event_ts", "event_id", out="event_seq")


def event_edges(spark) -> DataFrame:
    """Allowed event-stage moves (fixed size): forward in stage order, or into closed_lost."""
    rows = [(a[0], b[0]) for a, b in itertools.product(C.EVENT_STAGES, C.EVENT_STAGES)
            if a[0] != b[0] and (b[3] > a[3] or b[2] == "closed_lost")]
    return spark.createDataFrame(rows, "stage_from string, stage_to string")


def funnel_edges(spark) -> DataFrame:
    return spark.createDataFrame(C.ALLOWED_EDGES, "stage_from string, stage_to string")


def illegal_transitions(events: DataFrame, edges: DataFrame) -> DataFrame:
    """E-11: status changes whose (from, to) is not an allowed edge (null-safe anti join)."""
    sc = events.filter(F.col("event_type") == "status_changed")
    return sc.join(bounded_broadcast(edges), ["stage_from", "stage_to"], "left_anti")


def validate_events(events: DataFrame, violations: DataFrame) -> DataFrame:
    """E-10: validation status and sorted error list per event.

    ``violations``: event_id, rule_id, error, severity (bounded by the rule count).
    """
    errs = (violations.groupBy("event_id")
            .agg(F.array_sort(F.collect_list(F.struct("rule_id", "error", "severity"))).alias("validation_errors")))
    j = events.join(errs, "event_id", "left")
    return j.withColumn("validation_status",
                        F.when(F.col("validation_errors").isNull(), "passed").otherwise("failed"))


def replay(states: DataFrame, previous_events: DataFrame, since: str) -> DataFrame:
    """E-09: rebuild the events of every lead touched since ``since`` from the raw
    states and keep the other leads' events as they are."""
    touched = (states.filter(F.col("event_ts") >= F.lit(since).cast("timestamp_ntz"))
               .select(*LEAD_KEY).distinct())
    fresh = lead_events(states.join(touched, LEAD_KEY, "left_semi"))
    kept = previous_events.join(touched, LEAD_KEY, "left_anti")
    return kept.unionByName(fresh)
