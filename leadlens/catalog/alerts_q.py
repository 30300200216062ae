"""Alert, threshold and gate queries (A-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlens import config as C
from leadlens.catalog import rules_q  # noqa: F401  (registers the rule bodies used below)
from leadlens.catalog.metrics_q import ECON_SQL, PCT
from leadlens.operators.broadcast import bounded_broadcast
from leadlens.plans import alerts as AL
from leadlens.plans import metrics as M
from leadlens.plans import normalize as N
from leadlens.plans import reconcile as R
from leadlens.plans import rules as V
from leadlens.registry import query
from leadlens.sources import fixtures as fx
from leadlens.sources.fixtures import AS_OF_STAR

TH = C.DEFAULT_THRESHOLDS
# Fixture overrides of the config table (per-studio thresholds).
OVERRIDES = [("a04_mismatch_max", "studio_1", 5.0), ("a04_mismatch_max", "studio_3", 3.0)]

DAILY_CONV = """SELECT studio_id, lead_date, count(*) AS leads,
  count(*) FILTER (WHERE yc_booking_id IS NOT NULL) AS bookings FROM leads_booked GROUP BY ALL"""


def _grid(src: str, col: str) -> str:
    return f"""SELECT studio_id, CAST(unnest(generate_series(CAST(min({col}) AS TIMESTAMP), CAST(max({col}) AS TIMESTAMP),
    INTERVAL 1 DAY)) AS DATE) AS {col} FROM {src} GROUP BY studio_id"""


@query("a01_low_conversion", f"""SELECT studio_id, lead_date AS alert_date, 'A01' AS alert_type, 'IMPORTANT' AS severity,
  'lead_to_booking' AS metric_name, conversion AS metric_value, {TH['a01_conversion_min']} AS threshold
FROM (SELECT *, sum(b) OVER (PARTITION BY studio_id ORDER BY lead_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS run
      FROM (SELECT g.studio_id, g.lead_date, {PCT('d.bookings', 'd.leads')} AS conversion,
              coalesce(CAST({PCT('d.bookings', 'd.leads')} < {TH['a01_conversion_min']} AS INTEGER), 0) AS b
            FROM g LEFT JOIN d ON d.studio_id = g.studio_id AND d.lead_date = g.lead_date))
WHERE b = 1 AND run = 3""", views=[("d", DAILY_CONV), ("g", _grid("d", "lead_date"))])
def a01(ctx):
    """Conversion below 30% on three consecutive days."""
    return AL.alert_a01(ctx.leads_booked, TH["a01_conversion_min"], int(TH["a01_days"]))


def _a02_sql(scope: str, src: str) -> str:
    return f"""SELECT studio_id, visit_date AS alert_date, 'A02' AS alert_type, 'IMPORTANT' AS severity,
    'no_show_rate_7d:{scope}' AS metric_name, rate AS metric_value, {TH['a02_no_show_max']} AS threshold
  FROM (SELECT g.studio_id, g.visit_date,
          {PCT("sum(d.no_shows) OVER w", "sum(d.booked) OVER w")} AS rate
        FROM g_{src} g LEFT JOIN {src} d ON d.studio_id = g.studio_id AND d.visit_date = g.visit_date
        WINDOW w AS (PARTITION BY g.studio_id ORDER BY g.visit_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
  WHERE rate > {TH['a02_no_show_max']}"""


_B = "FROM bookings"


@query("a02_high_no_show", _a02_sql("all", "da") + " UNION ALL " + _a02_sql("first_visit", "df"), views=[
    ("da", f"SELECT studio_id, visit_date, count(*) AS booked, count(*) FILTER (WHERE status = 'no_show') AS no_shows {_B} GROUP BY ALL"),
    ("df", f"""SELECT studio_id, visit_date, count(*) AS booked, count(*) FILTER (WHERE status = 'no_show') AS no_shows
      FROM (SELECT *, row_number() OVER (PARTITION BY studio_id, phone ORDER BY visit_ts, booking_id) AS rn
            {_B} WHERE phone_valid) WHERE rn = 1 GROUP BY ALL"""),
    ("g_da", _grid("da", "visit_date")), ("g_df", _grid("df", "visit_date"))])
def a02(ctx):
    """No-show share over 7 days above 25% (all bookings and first visits)."""
    return AL.alert_a02(ctx.bookings, TH["a02_no_show_max"], int(TH["a02_days"]))


@query("a03_high_cac", f"""SELECT studio_id, month AS alert_date, 'A03' AS alert_type, 'IMPORTANT' AS severity,
  'cac:' || channel AS metric_name, cac AS metric_value, round(mean_cac * 1.2, 2) AS threshold
FROM (SELECT *, avg(cac) OVER (PARTITION BY studio_id, month) AS mean_cac,
        {PCT('bookings', 'leads')} AS conversion
      FROM (SELECT *, round(spend / NULLIF(buyers, 0), 2) AS cac FROM econ) WHERE cac IS NOT NULL)
WHERE cac > mean_cac * 1.2 AND conversion < {TH['weak_channel_conversion']}""", views=[("econ", ECON_SQL)])
def a03(ctx):
    """Channel CAC above the studio-month mean by 20% with low conversion."""
    econ = M.channel_economics(ctx.leads_booked, fx.ad_spend(ctx.t))
    return AL.alert_a03(econ, TH["a03_cac_over_mean"], TH["weak_channel_conversion"], True)


@query("a03_high_cac_any_conversion", f"""SELECT studio_id, month AS alert_date, 'A03' AS alert_type,
  'IMPORTANT' AS severity, 'cac:' || channel AS metric_name, cac AS metric_value, round(mean_cac * 1.2, 2) AS threshold
FROM (SELECT *, avg(cac) OVER (PARTITION BY studio_id, month) AS mean_cac
      FROM (SELECT *, round(spend / NULLIF(buyers, 0), 2) AS cac FROM econ) WHERE cac IS NOT NULL)
WHERE cac > mean_cac * 1.2""", views=[("econ", ECON_SQL)])
def a03b(ctx):
    """A-03 in the variant without the low-conversion condition."""
    econ = M.channel_economics(ctx.leads_booked, fx.ad_spend(ctx.t))
    return AL.alert_a03(econ, TH["a03_cac_over_mean"], TH["weak_channel_conversion"], False)


R01_SQL = """SELECT studio_id, count(*) FILTER (WHERE status_id = 74087590) AS appointments,
    round(100.0 * (CAST(count(*) FILTER (WHERE status_id = 74087590 AND yc_booking_id IS NULL) AS DOUBLE)
      / NULLIF(count(*) FILTER (WHERE status_id = 74087590), 0)), 2) AS mismatch_pct
  FROM leads_booked GROUP BY studio_id"""
CFG_SQL = ("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{s}', {v})" for k, s, v in OVERRIDES)
           + f", ('a04_mismatch_max', 'all', {TH['a04_mismatch_max']})) t(key, studio_id, value)")
A04_SQL = f"""SELECT r.studio_id, DATE '{AS_OF_STAR}' AS alert_date, 'A04' AS alert_type, 'CRITICAL' AS severity,
    'crm_vs_booking_pct' AS metric_name, r.mismatch_pct AS metric_value,
    coalesce(o.value, d.value) AS threshold, coalesce(r.mismatch_pct > 20, false) AS escalate
  FROM r01 r LEFT JOIN cfg o ON o.key = 'a04_mismatch_max' AND o.studio_id = r.studio_id
  LEFT JOIN cfg d ON d.key = 'a04_mismatch_max' AND d.studio_id = 'all'
  WHERE r.mismatch_pct > coalesce(o.value, d.value)"""


def _a04(ctx):
    return AL.alert_a04(R.reconcile_bookings(ctx.leads_booked), AL.config_table(ctx.spark, OVERRIDES), AS_OF_STAR)


@query("a04_crm_booking_gate", A04_SQL, views=[("r01", R01_SQL), ("cfg", CFG_SQL)])
def a04(ctx):
    """CRM vs booking mismatch above the per-studio threshold (A-15 lookup) -> CRITICAL."""
    return _a04(ctx)


@query("a15_thresholds", """SELECT r.studio_id, coalesce(o.value, d.value) AS threshold,
  o.value IS NOT NULL AS studio_specific
FROM r01 r LEFT JOIN cfg o ON o.key = 'a04_mismatch_max' AND o.studio_id = r.studio_id
LEFT JOIN cfg d ON d.key = 'a04_mismatch_max' AND d.studio_id = 'all'""", views=[("r01", R01_SQL), ("cfg", CFG_SQL)])
def a15(ctx):
    """Threshold per studio, else the 'all' default."""
    r = R.reconcile_bookings(ctx.leads_booked).filter(F.col("studio_id") != "all").select("studio_id")
    cfg = AL.config_table(ctx.spark, OVERRIDES)
    own = cfg.filter((F.col("key") == "a04_mismatch_max") & (F.col("studio_id") != "all")).select(
        "studio_id", F.lit(True).alias("studio_specific"))
    out = AL.with_threshold(r, cfg, "a04_mismatch_max").join(bounded_broadcast(own), "studio_id", "left")
    return out.select("studio_id", "threshold", F.coalesce("studio_specific", F.lit(False)).alias("studio_specific"))


RULE_ALERT_SQL = """SELECT studio_id, rule_id AS alert_type, severity, entity_id, detail FROM viol
WHERE rule_id IN ('A05', 'A06', 'A07', 'A08', 'A09', 'A10', 'A11', 'A12', 'A13', 'A14')"""


def _rule_alert_sql() -> tuple[str, list[tuple[str, str]]]:
    from leadlens.registry import ORACLE_BODY
    parts, views = [], {}
    for n in ["v01_new_lead", "v03_negotiation", "v04_no_answer", "v05_appointment", "v06_no_show_visited",
              "v08_not_purchased", "v10_success_revenue", "v09_deposit", "v13_closure_rate"]:
        body, extra = ORACLE_BODY[n]
        parts.append(f"SELECT * FROM ({body})")
        views.update(dict(extra))
    body = ("SELECT studio_id, rule_id AS alert_type, severity, entity_id, detail FROM ("
            + "\nUNION ALL\n".join(parts) + ") WHERE rule_id IN ('A05', 'A06', 'A07', 'A08', 'A09', 'A10', "
            "'A11', 'A12', 'A13', 'A14')")
    return body, list(views.items())


@query("a05_a14_rule_alerts", *_rule_alert_sql())
def a05_14(ctx):
    """Alerts A05-A14 from the stage rules (each rule has its own oracle as v01-v13)."""
    asof = AS_OF_STAR
    parts = [V.check_new_lead(N.enrich_utm(ctx.leads, ctx.ad_leads)),
             V.check_negotiation(ctx.leads, asof, TH["negotiation_days"]),
             V.check_no_answer(ctx.leads, asof, TH["no_answer_days"]),
             V.check_appointment(ctx.leads, ctx.bookings, asof),
             V.check_no_show(ctx.leads, ctx.bookings),
             V.check_not_purchased(ctx.leads, ctx.bookings),
             V.check_success(ctx.leads, ctx.bookings),
             V.check_deposit(ctx.leads, ctx.bookings),
             V.check_closure_rate(ctx.leads_booked, TH["closure_rate_max"])]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return AL.rule_based_alerts(u)


@query("a17_open_gates", f"""SELECT DISTINCT studio_id, 'A04' AS alert_id, 'reconciliation' AS alert_type,
  'open' AS status, alert_date AS opened_on FROM a04""", views=[("r01", R01_SQL), ("cfg", CFG_SQL), ("a04", A04_SQL)])
def a17(ctx):
    """Open gates created by A-04."""
    return AL.open_gates(_a04(ctx))


@query("a18_runnable_studios", """SELECT studio_id, studio_name, timezone, is_active FROM studios s
WHERE is_active AND NOT EXISTS (SELECT 1 FROM a04 WHERE a04.studio_id = s.studio_id)""",
       views=[("r01", R01_SQL), ("cfg", CFG_SQL), ("a04", A04_SQL)])
def a18(ctx):
    """Active studios without an open gate: the studios the next run processes."""
    return AL.runnable_studios(fx.studios(ctx.t), AL.open_gates(_a04(ctx)))


@query("a20_escalations", """SELECT * FROM r01all WHERE escalate""", views=[("r01all", """SELECT *,
    CASE WHEN mismatch_pct IS NULL THEN NULL WHEN mismatch_pct < 5 THEN 'INFO' WHEN mismatch_pct <= 10 THEN 'WARNING'
      ELSE 'CRITICAL' END AS severity, coalesce(mismatch_pct > 20, false) AS escalate FROM (
  SELECT CASE WHEN grouping(studio_id) = 1 THEN 'all' ELSE studio_id END AS studio_id,
    count(*) FILTER (WHERE status_id = 74087590) AS appointments,
    count(*) FILTER (WHERE status_id = 74087590 AND yc_booking_id IS NULL) AS unmatched,
    round(100.0 * (CAST(count(*) FILTER (WHERE status_id = 74087590 AND yc_booking_id IS NULL) AS DOUBLE)
      / NULLIF(count(*) FILTER (WHERE status_id = 74087590), 0)), 2) AS mismatch_pct
  FROM leads_booked GROUP BY GROUPING SETS ((studio_id), ()))""")])
def a20(ctx):
    """Reconciliation differences above 20%: immediate escalation."""
    return AL.escalations(R.reconcile_bookings(ctx.leads_booked))


@query("a21_calibrate", f"""SELECT studio_id, count(conversion) AS days,
  quantile_cont(conversion, 0.1) AS suggested_threshold
FROM (SELECT studio_id, {PCT('bookings', 'leads')} AS conversion FROM d) GROUP BY studio_id""",
       views=[("d", DAILY_CONV)])
def a21(ctx):
    """Suggested A-01 threshold per studio: 10th percentile of past daily conversion."""
    d = ctx.leads_booked.groupBy("studio_id", "lead_date").agg(
        F.count(F.lit(1)).alias("leads"), F.count_if(F.col("yc_booking_id").isNotNull()).alias("bookings"))
    return AL.calibrate(d.withColumn("conversion", M.pct("bookings", "leads")), "conversion", 0.1)


@query("a19_gate_history", f"""SELECT studio_id, alert_id, row_number() OVER (PARTITION BY studio_id, alert_id ORDER BY opened_at) AS episode,
  CASE WHEN resolved_at IS NULL THEN 'open' ELSE 'resolved' END AS status, opened_at, resolved_at, ack_by
FROM (SELECT studio_id, alert_id, min(raised_at) AS opened_at, resolved_at, max(ack_by) AS ack_by FROM (
    SELECT r.studio_id, r.alert_id, r.raised_at, min(k.ack_at) AS resolved_at, first(k.ack_by ORDER BY k.ack_at) AS ack_by
    FROM raised r LEFT JOIN acks k ON k.studio_id = r.studio_id AND k.alert_id = r.alert_id AND k.ack_at >= r.raised_at
    GROUP BY ALL) GROUP BY studio_id, alert_id, resolved_at)""", views=[
    ("raised", """SELECT studio_id, 'A02' AS alert_id, CAST(visit_date AS TIMESTAMP) AS raised_at
      FROM bookings GROUP BY studio_id, visit_date
      HAVING 4 * count(*) FILTER (WHERE status = 'no_show') > count(*)"""),
    ("acks", """SELECT studio_id, 'A02' AS alert_id, min(created_at) + INTERVAL 12 HOUR AS ack_at,
        'user ' || min(responsible_id) AS ack_by
      FROM leads GROUP BY studio_id, date_trunc('week', created_at)""")])
def a19(ctx):
    """Life of the no-show alert: raised on each day with over 25% no-shows, acknowledged by the
    studio's first lead of each week at noon."""
    raised = ctx.bookings.groupBy("studio_id", F.col("visit_date").cast("timestamp_ntz").alias("raised_at")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "no_show").alias("missed")).filter("4 * missed > n")
    acks = ctx.leads.groupBy("studio_id", F.date_trunc("week", "created_at").alias("w")).agg(
        F.timestamp_add("HOUR", F.lit(12), F.min("created_at")).alias("ack_at"),
        F.concat(F.lit("user "), F.min("responsible_id").cast("string")).alias("ack_by"))
    named = lambda d: d.withColumn("alert_id", F.lit("A02"))
    return AL.gate_history(named(raised), named(acks))
