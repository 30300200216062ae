"""Event-core (E-*) and event-metric (T-*) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlens import config as C
from leadlens.plans import event_metrics as T
from leadlens.plans import events as E
from leadlens.plans.normalize import event_stage_dim
from leadlens.registry import query
from leadlens.sources import fixtures as fx
from leadlens.sources.fixtures import AS_OF_EVENTS

STATE_TS = "2024-01-15 00:00:00"
SINCE = "2024-01-01"
WEEK = "2024-01-08"

TRANS_SQL = """SELECT studio_id, CAST(event_ts AS DATE) AS transition_date, stage_from, stage_to,
    count(*) AS lead_count,
    round(avg(date_diff('microsecond', prev_event_ts, event_ts)) / 3600000000.0, 4) AS avg_duration_hours
  FROM ev WHERE event_type = 'status_changed' GROUP BY ALL"""

DUR_SQL = """SELECT studio_id, CAST(date_trunc('week', valid_from) AS DATE) AS week_start, stage AS stage_name,
    round(avg(us) / 3600000000.0, 4) AS avg_duration_hours,
    round(quantile_cont(us / 3600000000.0, 0.5), 4) AS median_duration_hours,
    round(quantile_cont(us / 3600000000.0, 0.95), 4) AS p95_duration_hours,
    count(*) AS lead_count
  FROM (SELECT *, date_diff('microsecond', valid_from, valid_to) AS us FROM lead_snapshots
        WHERE valid_to IS NOT NULL) GROUP BY ALL"""

EV_COLS = "studio_id, source, lead_id, event_id, event_type, stage_from, stage_to, event_ts"


def _events(ctx):
    return ctx.lead_events.select(*[c.strip() for c in EV_COLS.split(",")])


@query("e01_lead_events", f"SELECT {EV_COLS} FROM lead_events")
def e01(ctx):
    """created / status_changed events; repeated stages collapse."""
    return _events(ctx)


@query("e04_snapshots", """SELECT studio_id, source, lead_id, snapshot_id, stage, valid_from, valid_to
FROM lead_snapshots""")
def e04(ctx):
    """SCD2 snapshots [valid_from, valid_to)."""
    return ctx.snapshots


@query("e05_state_at", f"""SELECT studio_id, source, lead_id, stage, valid_from, valid_to FROM lead_snapshots
WHERE valid_from <= TIMESTAMP '{STATE_TS}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{STATE_TS}')""")
def e05(ctx):
    """State of every lead at a point in time."""
    return E.state_at(ctx.snapshots, STATE_TS).select("studio_id", "source", "lead_id", "stage",
                                                      "valid_from", "valid_to")


@query("e05_states_on_days", """SELECT t.t, s.studio_id, s.source, s.lead_id, s.stage FROM lead_snapshots s
JOIN (SELECT DISTINCT CAST(event_ts AS DATE)::TIMESTAMP AS t FROM lead_events) t
  ON s.valid_from <= t.t AND (s.valid_to IS NULL OR s.valid_to > t.t)""")
def e05_days(ctx):
    """State of every lead at the midnight of every day that has an event, in one join."""
    days = ctx.lead_events.select(F.to_date("event_ts").cast("timestamp_ntz").alias("t")).distinct()
    return E.states_at(ctx.snapshots, days).select("t", "studio_id", "source", "lead_id", "stage")


@query("e06_current_state", """SELECT studio_id, source, lead_id, stage, valid_from FROM lead_snapshots
WHERE valid_to IS NULL""")
def e06(ctx):
    return E.current_state(ctx.snapshots).select("studio_id", "source", "lead_id", "stage", "valid_from")


@query("e07_current_leads", """SELECT s.studio_id, s.source, s.lead_id, s.stage, fs.stage_group, fs.stage_order,
  s.valid_from AS stage_since
FROM lead_snapshots s LEFT JOIN event_stages fs ON fs.stage_code = s.stage WHERE s.valid_to IS NULL""")
def e07(ctx):
    return E.leads_from_current(ctx.snapshots, event_stage_dim(ctx.spark))


@query("e08_history", f"""SELECT {EV_COLS},
  row_number() OVER (PARTITION BY studio_id, source, lead_id ORDER BY event_ts, event_id) AS event_seq
FROM lead_events""")
def e08(ctx):
    """Every lead's ordered history with its position."""
    return E.history(_events(ctx))


ILLEGAL_SQL = """SELECT e.studio_id, e.source, e.lead_id, e.event_id, e.stage_from, e.stage_to, e.event_ts
  FROM lead_events e JOIN event_stages f ON f.stage_code = e.stage_from
  JOIN event_stages t ON t.stage_code = e.stage_to
  WHERE e.event_type = 'status_changed'
    AND NOT (t.stage_order > f.stage_order OR t.stage_group = 'closed_lost')"""


@query("e11_illegal_transitions", ILLEGAL_SQL)
def e11(ctx):
    """Status changes that move backwards in the funnel (not an allowed edge)."""
    ill = E.illegal_transitions(_events(ctx), E.event_edges(ctx.spark))
    return ill.select("studio_id", "source", "lead_id", "event_id", "stage_from", "stage_to", "event_ts")


@query("e09_replay", f"SELECT {EV_COLS} FROM lead_events")
def e09(ctx):
    """Events kept from a run before a date, with the leads touched since rebuilt: all events."""
    states = fx.lead_states(ctx.t)
    before = E.lead_events(states.filter(F.col("event_ts") < F.lit(STATE_TS).cast("timestamp_ntz")))
    return E.replay(states, before, STATE_TS).select(*[c.strip() for c in EV_COLS.split(",")])


@query("e10_validate_events", """SELECT e.studio_id, e.source, e.lead_id, e.event_id,
  CASE WHEN i.event_id IS NULL THEN 'passed' ELSE 'failed' END AS validation_status,
  CASE WHEN i.event_id IS NULL THEN 0 ELSE 1 END AS error_count
FROM lead_events e LEFT JOIN illegal i ON i.event_id = e.event_id""", views=[("illegal", ILLEGAL_SQL)])
def e10(ctx):
    """Validation status and error list per event (rule E11)."""
    ev = _events(ctx)
    viol = E.illegal_transitions(ev, E.event_edges(ctx.spark)).select(
        "event_id", F.lit("E11").alias("rule_id"), F.lit("illegal_transition").alias("error"),
        F.lit("WARNING").alias("severity"))
    v = E.validate_events(ev, viol)
    return v.select("studio_id", "source", "lead_id", "event_id", "validation_status",
                    F.coalesce(F.size("validation_errors"), F.lit(0)).alias("error_count")).where(
        F.col("error_count") >= 0)


@query("t01_transitions", TRANS_SQL)
def t01(ctx):
    return T.transitions(ctx.lead_events)


@query("t02_stage_durations", DUR_SQL)
def t02(ctx):
    return T.stage_durations(ctx.snapshots)


@query("t03_historical_funnel", f"""SELECT c.studio_id, c.d AS snapshot_date, s.stage AS stage_name,
  count(*) AS lead_count
FROM cal c JOIN lead_snapshots s ON s.studio_id = c.studio_id
  AND s.valid_from <= CAST(c.d AS TIMESTAMP)
  AND (s.valid_to IS NULL OR s.valid_to > CAST(c.d AS TIMESTAMP))
GROUP BY ALL""", views=[("cal", f"""SELECT studio_id,
    CAST(unnest(generate_series(CAST(min_d AS TIMESTAMP), TIMESTAMP '{AS_OF_EVENTS}', INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT studio_id, min(CASE WHEN valid_from = CAST(CAST(valid_from AS DATE) AS TIMESTAMP)
        THEN CAST(valid_from AS DATE) ELSE CAST(valid_from AS DATE) + 1 END) AS min_d
        FROM lead_snapshots GROUP BY studio_id)""")])
def t03(ctx):
    """Leads per stage on every date (net flow + running sum)."""
    return T.historical_funnel(ctx.snapshots, AS_OF_EVENTS)


@query("t04_entered_exited", """SELECT studio_id, week_start, stage_name,
  CAST(sum(e) AS BIGINT) AS entered, CAST(sum(x) AS BIGINT) AS exited
FROM (SELECT studio_id, stage AS stage_name, CAST(date_trunc('week', valid_from) AS DATE) AS week_start,
        1 AS e, 0 AS x FROM lead_snapshots
      UNION ALL
      SELECT studio_id, stage, CAST(date_trunc('week', valid_to) AS DATE), 0, 1 FROM lead_snapshots
      WHERE valid_to IS NOT NULL) GROUP BY ALL""")
def t04(ctx):
    return T.entered_exited(ctx.snapshots)


@query("t05_group_transitions", """SELECT CASE WHEN grouping(e.studio_id) = 1 THEN 'all' ELSE e.studio_id END AS studio_id,
  f.stage_group AS from_group, t.stage_group AS to_group, count(*) AS transitions
FROM lead_events e JOIN event_stages f ON f.stage_code = e.stage_from
  JOIN event_stages t ON t.stage_code = e.stage_to
WHERE e.event_type = 'status_changed'
GROUP BY GROUPING SETS ((e.studio_id, f.stage_group, t.stage_group), (f.stage_group, t.stage_group))""")
def t05(ctx):
    return T.group_transitions(ctx.lead_events, event_stage_dim(ctx.spark))


@query("t06_current_funnel", """SELECT CASE WHEN grouping(s.studio_id) = 1 THEN 'all' ELSE s.studio_id END AS studio_id,
  fs.stage_order, fs.stage_name, count(*) AS lead_count
FROM lead_snapshots s JOIN event_stages fs ON fs.stage_code = s.stage
WHERE s.valid_to IS NULL
GROUP BY GROUPING SETS ((s.studio_id, fs.stage_order, fs.stage_name), (fs.stage_order, fs.stage_name))""")
def t06(ctx):
    return T.current_funnel(ctx.snapshots, event_stage_dim(ctx.spark))


@query("t07_stage_conversion", f"""SELECT CASE WHEN grouping(studio_id) = 1 THEN 'all' ELSE studio_id END AS studio_id,
  CAST(sum(lead_count) FILTER (WHERE stage_from = 'new') AS BIGINT) AS new_leads,
  CAST(sum(lead_count) FILTER (WHERE stage_to = 'negotiation') AS BIGINT) AS to_negotiation,
  CAST(sum(lead_count) FILTER (WHERE stage_to = 'abonement_sold') AS BIGINT) AS to_sold
FROM trans WHERE transition_date >= DATE '{SINCE}'
GROUP BY GROUPING SETS ((studio_id), ())""", views=[("trans", TRANS_SQL)])
def t07(ctx):
    return T.stage_conversion(T.transitions(ctx.lead_events), SINCE)


@query("t08_bottlenecks", f"""SELECT studio_id, stage_name, avg_duration_hours, median_duration_hours
FROM dur WHERE week_start = DATE '{WEEK}'""", views=[("dur", DUR_SQL)])
def t08(ctx):
    return T.bottlenecks(T.stage_durations(T.in_week(ctx.snapshots, WEEK)), WEEK)


@query("t09_read_transitions", f"""SELECT studio_id, transition_date, lead_count, avg_duration_hours
FROM trans WHERE transition_date BETWEEN DATE '{SINCE}' AND DATE '{AS_OF_EVENTS}'
  AND stage_from = 'new' AND stage_to = 'contacted'""", views=[("trans", TRANS_SQL)])
def t09(ctx):
    t = T.read_transitions(T.transitions(ctx.lead_events), SINCE, AS_OF_EVENTS, "new", "contacted")
    return t.select("studio_id", "transition_date", "lead_count", "avg_duration_hours")


@query("t10_bottleneck_alert", f"""SELECT studio_id, 'T10' AS alert_type, 'WARNING' AS severity,
  'median_hours:' || stage_name AS metric_name, median_duration_hours AS metric_value,
  {C.DEFAULT_THRESHOLDS['bottleneck_median_hours']} AS threshold, week_start
FROM dur WHERE median_duration_hours > {C.DEFAULT_THRESHOLDS['bottleneck_median_hours']}""",
       views=[("dur", DUR_SQL)])
def t10(ctx):
    return T.bottleneck_alert(T.stage_durations(ctx.snapshots),
                              C.DEFAULT_THRESHOLDS["bottleneck_median_hours"], AS_OF_EVENTS)
