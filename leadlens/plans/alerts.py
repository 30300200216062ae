"""Alerts, thresholds and gates (A-01 .. A-21)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlens import config as C
from leadlens.functions import pct
from leadlens.operators.broadcast import bounded_broadcast
from leadlens.operators.selection import exact_quantiles, same_keys
from leadlens.operators.sequence import next_row, prev_row, seq_number

ALERT_COLS = ["studio_id", "alert_date", "alert_type", "severity", "metric_name", "metric_value", "threshold"]


def config_table(spark, overrides: list[tuple[str, str, float]] | None = None) -> DataFrame:
    """Threshold config: (key, studio_id or 'all', value); defaults plus overrides."""
    rows = [(k, "all", float(v)) for k, v in C.DEFAULT_THRESHOLDS.items()] + list(overrides or [])
    return spark.createDataFrame(rows, "key string, studio_id string, value double")


def with_threshold(df: DataFrame, cfg: DataFrame, key: str, out: str = "threshold") -> DataFrame:
    """A-15: per-studio threshold, else the studio 'all' value.

    The 'all' default is one scalar of the (small) config table, read once and
    used as a literal; per-studio values come from a left join on studio_id.
    """
    c = cfg.filter(F.col("key") == key)
    own = c.filter(F.col("studio_id") != "all").select("studio_id", F.col("value").alias("_own"))
    row = c.filter(F.col("studio_id") == "all").select("value").first()
    dflt = F.lit(row[0] if row else None).cast("double")
    j = df.join(bounded_broadcast(own), "studio_id", "left")
    return j.withColumn(out, F.coalesce(F.col("_own"), dflt)).drop("_own")


def _dense_days(daily: DataFrame, date_col: str) -> DataFrame:
    rng = daily.groupBy("studio_id").agg(F.min(date_col).alias("d0"), F.max(date_col).alias("d1"))
    grid = rng.select("studio_id", F.explode(F.sequence("d0", "d1")).alias(date_col))
    return grid.join(daily, ["studio_id", date_col], "left")


def alert_a01(leads_booked: DataFrame, threshold: float, days: int = 3) -> DataFrame:
    """A-01: lead->booking conversion below the threshold on ``days`` consecutive days.

    Days are laid on a dense per-studio calendar; a day without leads has no
    conversion and breaks the run.
    """
    d = leads_booked.groupBy("studio_id", "lead_date").agg(
        F.count(F.lit(1)).alias("leads"), F.count_if(F.col("yc_booking_id").isNotNull()).alias("bookings"))
    g = _dense_days(d, "lead_date").withColumn("conversion", pct("bookings", "leads"))
    breach = F.coalesce((F.col("conversion") < threshold).cast("int"), F.lit(0))
    w = Window.partitionBy("studio_id").orderBy("lead_date").rowsBetween(-(days - 1), 0)
    g = g.withColumn("_b", breach).withColumn("_run", F.sum("_b").over(w))
    hit = g.filter((F.col("_b") == 1) & (F.col("_run") == days))
    return hit.select("studio_id", F.col("lead_date").alias("alert_date"), F.lit("A01").alias("alert_type"),
                      F.lit("IMPORTANT").alias("severity"), F.lit("lead_to_booking").alias("metric_name"),
                      F.col("conversion").alias("metric_value"), F.lit(threshold).alias("threshold"))


def alert_a02(bookings: DataFrame, threshold: float, days: int = 7) -> DataFrame:
    """A-02: no-show share over the last ``days`` days above the threshold, as
    sum(no-shows) / sum(bookings) over the window (not a mean of daily rates);
    scope 'all' bookings and 'first_visit' (clients' first bookings, of any status)."""
    b = bookings
    first = (b.filter("phone_valid").groupBy("studio_id", "phone")
             .agg(F.min(F.struct("visit_ts", "booking_id", "status", "visit_date")).alias("_f"))
             .select("studio_id", F.col("_f.visit_date").alias("visit_date"), F.col("_f.status").alias("status")))
    out = None
    for scope, src in (("all", b), ("first_visit", first)):
        d = src.groupBy("studio_id", "visit_date").agg(
            F.count(F.lit(1)).alias("booked"), F.count_if(F.col("status") == "no_show").alias("no_shows"))
        g = _dense_days(d, "visit_date")
        w = Window.partitionBy("studio_id").orderBy("visit_date").rowsBetween(-(days - 1), 0)
        g = g.withColumn("rate", pct(F.sum("no_shows").over(w), F.sum("booked").over(w)))
        hit = g.filter(F.col("rate") > threshold).select(
            "studio_id", F.col("visit_date").alias("alert_date"), F.lit("A02").alias("alert_type"),
            F.lit("IMPORTANT").alias("severity"), F.lit("no_show_rate_7d:" + scope).alias("metric_name"),
            F.col("rate").alias("metric_value"), F.lit(threshold).alias("threshold"))
        out = hit if out is None else out.unionByName(hit)
    return out


def alert_a03(econ: DataFrame, over_pct: float, min_conversion: float,
              low_conversion_required: bool = True) -> DataFrame:
    """A-03: a channel's CAC above the studio-month mean CAC by more than ``over_pct``
    percent, optionally only when its lead->booking conversion is also low."""
    e = econ.filter(F.col("cac").isNotNull())
    w = Window.partitionBy("studio_id", "month")
    e = e.withColumn("mean_cac", F.avg("cac").over(w)).withColumn("conversion", pct("bookings", "leads"))
    cond = F.col("cac") > F.col("mean_cac") * (1.0 + over_pct / 100.0)
    if low_conversion_required:
        cond = cond & (F.col("conversion") < min_conversion)
    return e.filter(cond).select(
        "studio_id", F.col("month").alias("alert_date"), F.lit("A03").alias("alert_type"),
        F.lit("IMPORTANT").alias("severity"), F.concat(F.lit("cac:"), F.col("channel")).alias("metric_name"),
        F.col("cac").alias("metric_value"), F.round(F.col("mean_cac") * (1.0 + over_pct / 100.0), 2).alias("threshold"))


def alert_a04(recon: DataFrame, cfg: DataFrame, as_of: str) -> DataFrame:
    """A-04: CRM<->booking mismatch above the (per-studio) threshold -> CRITICAL + gate."""
    r = with_threshold(recon.filter(F.col("studio_id") != "all"), cfg, "a04_mismatch_max")
    hit = r.filter(F.col("mismatch_pct") > F.col("threshold"))
    return hit.select("studio_id", F.lit(as_of).cast("date").alias("alert_date"), F.lit("A04").alias("alert_type"),
                      F.lit("CRITICAL").alias("severity"), F.lit("crm_vs_booking_pct").alias("metric_name"),
                      F.col("mismatch_pct").alias("metric_value"), "threshold", "escalate")


RULE_ALERT_TYPES = {"A05": "A05", "A06": "A06", "A07": "A07", "A08": "A08", "A09": "A09", "A10": "A10",
                    "A11": "A11", "A12": "A12", "A13": "A13", "A14": "A14"}


def rule_based_alerts(violations: DataFrame) -> DataFrame:
    """A-05 .. A-14: violations of the stage rules that carry an alert code."""
    return violations.filter(F.col("rule_id").isin(*RULE_ALERT_TYPES)).select(
        "studio_id", F.col("rule_id").alias("alert_type"), "severity", "entity_id", "detail")


def new_alerts(alerts: DataFrame, open_alerts: DataFrame) -> DataFrame:
    """A-16: drop alerts already open (same studio, type, metric, not resolved); see ``gate_history``
    for the whole life cycle."""
    o = open_alerts.filter(F.col("resolved_at").isNull()).select("studio_id", "alert_type", "metric_name")
    return alerts.join(o, ["studio_id", "alert_type", "metric_name"], "left_anti")


def open_gates(a04: DataFrame) -> DataFrame:
    """A-17: one open reconciliation gate per studio with an A-04 alert."""
    return a04.select("studio_id", F.lit("A04").alias("alert_id"), F.lit("reconciliation").alias("alert_type"),
                      F.lit("open").alias("status"), F.col("alert_date").alias("opened_on")).distinct()


def runnable_studios(studios: DataFrame, gates: DataFrame) -> DataFrame:
    """A-18: active studios without an open gate (left anti join)."""
    g = gates.filter(F.col("status") == "open").select("studio_id").distinct()
    return studios.filter("is_active").join(g, "studio_id", "left_anti")


HISTORY_KEY = ["studio_id", "alert_id"]


def gate_history(raised: DataFrame, acks: DataFrame) -> DataFrame:
    """A-16 / A-19: the life of each alert or gate as intervals, one row an episode.

    ``raised``: studio_id, alert_id, raised_at, a row whenever a run finds the condition;
    ``acks``: studio_id, alert_id, ack_at, ack_by.  An episode opens with the first finding
    after the last resolution and ends with the first acknowledgement after it; findings in
    between raise nothing new, acknowledgements of what is not open change nothing, and a
    finding after the resolution reopens it as the next episode.  At one instant findings come
    before acknowledgements; of several acknowledgements the first (then the smaller name) counts.

    Equal kinds in a row collapse, and each opening takes the next row's time and name, both by
    the skew-safe sequence operators: an alert that is raised all the time is split by day.
    """
    ev = raised.select(*HISTORY_KEY, F.col("raised_at").alias("ts"), F.lit("0").alias("tb"), F.lit(None).cast("string").alias("who")).distinct().unionByName(
        acks.select(*HISTORY_KEY, F.col("ack_at").alias("ts"), F.concat(F.lit("1"), F.coalesce("ack_by", F.lit(""))).alias("tb"),
                    F.col("ack_by").alias("who")).distinct())
    ev = ev.withColumn("kind", F.substring("tb", 1, 1))
    turns = prev_row(ev, HISTORY_KEY, "ts", "tb", ["kind"]).filter(
        (F.col("kind") != F.coalesce("prev_kind", F.lit("1")))).drop("prev_ts", "prev_kind")
    opened = next_row(turns, HISTORY_KEY, "ts", "tb", ["who"]).filter("kind = '0'")
    numbered = seq_number(opened, HISTORY_KEY, "ts", "tb", out="episode")
    return numbered.select(
        *HISTORY_KEY, "episode", F.when(F.col("next_ts").isNull(), "open").otherwise("resolved").alias("status"),
        F.col("ts").alias("opened_at"), F.col("next_ts").alias("resolved_at"), F.col("next_who").alias("ack_by"))


def resolve_gates(gates: DataFrame, acks: DataFrame) -> DataFrame:
    """A-19: apply acknowledgements (studio_id, alert_id, ack_by, ack_at) to open gates; when and
    by whom a gate was resolved before stays."""
    a = acks.groupBy("studio_id", "alert_id").agg(F.max(F.struct("ack_at", "ack_by")).alias("_a"))
    j = gates.join(a, ["studio_id", "alert_id"], "left")
    hit = F.col("_a").isNotNull() & (F.col("status") == "open")
    old = lambda c, kind: F.col(c) if c in gates.columns else F.lit(None).cast(kind)
    return j.withColumns({"status": F.when(hit, "resolved").otherwise(F.col("status")),
                          "resolved_at": F.when(hit, F.col("_a.ack_at")).otherwise(old("resolved_at", "timestamp_ntz")),
                          "ack_by": F.when(hit, F.col("_a.ack_by")).otherwise(old("ack_by", "string"))}).drop("_a")


def escalations(recon: DataFrame) -> DataFrame:
    """A-20: reconciliation rows above the escalation level (> 20%)."""
    return recon.filter("escalate")


def calibrate(daily_values: DataFrame, value_col: str, q: float, step: float = 0.1) -> DataFrame:
    """A-21 (ours): suggested threshold = the exact q-quantile of a studio's past daily values,
    which are multiples of ``step`` (percentages are rounded to one digit)."""
    n = daily_values.groupBy("studio_id").agg(F.count(value_col).alias("days"))
    found = exact_quantiles(daily_values, ["studio_id"], F.round(F.col(value_col) / F.lit(step)),
                            {"suggested_threshold": q}, round(1 / step))
    return n.alias("n").join(found.alias("f"), same_keys("n", "f", ["studio_id"]), "left").select(
        "n.studio_id", "days", "suggested_threshold")
