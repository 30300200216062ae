"""Snapshot-metric queries (M-*)."""

from __future__ import annotations

from leadlens import config as C
from leadlens.plans import metrics as M
from leadlens.plans import normalize as N
from leadlens.registry import query
from leadlens.sources import fixtures as fx
from leadlens.sources.fixtures import AS_OF_STAR


def PCT(n: str, d: str, digits: int = 1) -> str:
    return f"round(100.0 * (CAST({n} AS DOUBLE) / CAST(NULLIF({d}, 0) AS DOUBLE)), {digits})"


def ALL(col: str = "studio_id") -> str:
    return f"CASE WHEN grouping({col}) = 1 THEN 'all' ELSE {col} END AS studio_id"


WON = "(84237074, 142, 84237070)"
MONTH = "CAST(date_trunc('month', {}) AS DATE)"
WEEK = "CAST(date_trunc('week', {}) AS DATE)"


@query("m02_lead_to_booking", f"""
SELECT {ALL()}, utm_source, lead_date, count(*) AS leads,
       count(*) FILTER (WHERE yc_booking_id IS NOT NULL) AS bookings,
       {PCT("count(*) FILTER (WHERE yc_booking_id IS NOT NULL)", "count(*)")} AS conversion
FROM leads_booked
GROUP BY GROUPING SETS ((studio_id, utm_source, lead_date), (utm_source, lead_date))""")
def m02(ctx):
    """Lead -> booking conversion per studio, source and day, plus studio 'all'."""
    return M.lead_to_booking(ctx.leads_booked)


@query("m01_daily_summary", f"""
SELECT coalesce(l.studio_id, b.studio_id) AS studio_id, coalesce(l.summary_date, b.summary_date) AS summary_date,
  coalesce(l.channel, b.channel) AS channel,
  coalesce(leads, 0) AS leads, coalesce(bookings, 0) AS bookings, coalesce(booked_visited, 0) AS booked_visited,
  coalesce(invalid_phones, 0) AS invalid_phones, coalesce(visits_booked, 0) AS visits_booked,
  coalesce(visits, 0) AS visits, coalesce(no_shows, 0) AS no_shows, coalesce(cancellations, 0) AS cancellations,
  CAST(coalesce(rev, 0) AS DOUBLE) AS revenue, CAST(coalesce(vrev, 0) AS DOUBLE) AS visit_revenue,
  {PCT("coalesce(bookings, 0)", "coalesce(leads, 0)")} AS lead_to_booking,
  {PCT("coalesce(visits, 0)", "coalesce(visits_booked, 0)")} AS booking_to_visit,
  {PCT("coalesce(no_shows, 0)", "coalesce(visits_booked, 0)")} AS no_show_rate,
  {PCT("coalesce(cancellations, 0)", "coalesce(visits_booked, 0)")} AS cancellation_rate
FROM (
  SELECT {ALL()}, lead_date AS summary_date,
    CASE WHEN grouping(channel) = 1 THEN 'all' ELSE channel END AS channel,
    count(*) AS leads, count(*) FILTER (WHERE yc_booking_id IS NOT NULL) AS bookings,
    count(*) FILTER (WHERE booking_status = 'visited') AS booked_visited,
    count(*) FILTER (WHERE NOT phone_valid) AS invalid_phones
  FROM (SELECT *, coalesce(utm_source, 'unknown') AS channel FROM leads_booked)
  GROUP BY GROUPING SETS ((studio_id, lead_date, channel), (studio_id, lead_date), (lead_date, channel), (lead_date))
) l FULL OUTER JOIN (
  SELECT {ALL()}, visit_date AS summary_date, CASE WHEN grouping(channel) = 1 THEN 'all' ELSE channel END AS channel,
    count(*) AS visits_booked, count(*) FILTER (WHERE status = 'visited') AS visits,
    count(*) FILTER (WHERE status = 'no_show') AS no_shows,
    count(*) FILTER (WHERE status = 'canceled') AS cancellations,
    sum(amount) AS rev, sum(amount) FILTER (WHERE status = 'visited') AS vrev
  FROM (SELECT b.*, coalesce(o.channel, 'unknown') AS channel FROM bookings b LEFT JOIN (
      SELECT yc_booking_id, first(utm_source ORDER BY created_at, lead_id) AS channel FROM leads_booked
      WHERE yc_booking_id IS NOT NULL GROUP BY yc_booking_id) o ON o.yc_booking_id = b.booking_id)
  GROUP BY GROUPING SETS ((studio_id, visit_date, channel), (studio_id, visit_date), (visit_date, channel), (visit_date))
) b ON l.studio_id = b.studio_id AND l.summary_date = b.summary_date AND l.channel = b.channel""")
def m01(ctx):
    """Daily summary per studio x date x channel with 'all' rows (14 measures)."""
    return M.daily_summary(ctx.leads_booked, ctx.bookings)


@query("m03_booking_to_visit", f"""SELECT {ALL()}, {MONTH.format('visit_ts')} AS month, count(*) AS booked,
  count(*) FILTER (WHERE status = 'visited') AS visits,
  {PCT("count(*) FILTER (WHERE status = 'visited')", "count(*)")} AS booking_to_visit
FROM bookings GROUP BY GROUPING SETS ((studio_id, {MONTH.format('visit_ts')}), ({MONTH.format('visit_ts')}))""")
def m03(ctx):
    return M.booking_to_visit(ctx.bookings)


@query("m04_lead_to_abonement", f"""SELECT {ALL()}, {MONTH.format('created_at')} AS month, count(*) AS leads,
  count(*) FILTER (WHERE booking_status = 'visited') AS visited,
  count(*) FILTER (WHERE status_id IN {WON}) AS abonements,
  count(*) FILTER (WHERE status_id IN {WON} AND booking_status = 'visited') AS abon_visited,
  {PCT(f"count(*) FILTER (WHERE status_id IN {WON})", "count(*)")} AS lead_to_abonement,
  {PCT(f"count(*) FILTER (WHERE status_id IN {WON} AND booking_status = 'visited')",
       "count(*) FILTER (WHERE booking_status = 'visited')")} AS visit_to_abon
FROM leads_booked GROUP BY GROUPING SETS ((studio_id, {MONTH.format('created_at')}), ({MONTH.format('created_at')}))""")
def m04(ctx):
    return M.lead_to_abonement(ctx.leads_booked)


CV_SQL = """SELECT studio_id, phone, count(*) AS visits, sum(amount) AS revenue FROM bookings
  WHERE status = 'visited' AND phone_valid GROUP BY ALL"""


@query("m06_repeat_rate", f"""SELECT {ALL()}, count(*) AS clients, count(*) FILTER (WHERE visits >= 2) AS repeat_clients,
  {PCT("count(*) FILTER (WHERE visits >= 2)", "count(*)")} AS repeat_purchase_rate
FROM cv GROUP BY GROUPING SETS ((studio_id), ())""", views=[("cv", CV_SQL)])
def m06(ctx):
    return M.repeat_rate(ctx.bookings)


@query("m07_no_show_rate", f"""SELECT studio_id,
  CASE WHEN grouping(visit_date) = 0 THEN 'day' WHEN grouping(week) = 0 THEN 'week'
       WHEN grouping(master_id) = 0 THEN 'master' ELSE 'studio' END AS grain,
  coalesce(visit_date, week) AS period_start, master_id, count(*) AS booked,
  count(*) FILTER (WHERE status = 'no_show') AS no_shows,
  {PCT("count(*) FILTER (WHERE status = 'no_show')", "count(*)")} AS no_show_rate
FROM (SELECT *, {WEEK.format('visit_ts')} AS week FROM bookings)
GROUP BY GROUPING SETS ((studio_id, visit_date), (studio_id, week), (studio_id), (studio_id, master_id))""")
def m07(ctx):
    """No-show rate by day, week, studio and master."""
    return M.no_show_rate(ctx.bookings)


@query("m08_cancellation_rate", f"""SELECT {ALL()}, {MONTH.format('visit_ts')} AS month, count(*) AS booked,
  count(*) FILTER (WHERE status = 'canceled') AS cancellations,
  {PCT("count(*) FILTER (WHERE status = 'canceled')", "count(*)")} AS cancellation_rate
FROM bookings GROUP BY GROUPING SETS ((studio_id, {MONTH.format('visit_ts')}), ({MONTH.format('visit_ts')}))""")
def m08(ctx):
    return M.cancel_rate(ctx.bookings)


@query("m09_first_visit_no_show", f"""SELECT {ALL()}, count(*) AS first_bookings,
  count(*) FILTER (WHERE status = 'no_show') AS first_no_shows,
  {PCT("count(*) FILTER (WHERE status = 'no_show')", "count(*)")} AS first_visit_no_show_rate
FROM (SELECT studio_id, status, row_number() OVER (PARTITION BY studio_id, phone ORDER BY visit_ts, booking_id) AS rn
      FROM bookings WHERE phone_valid) WHERE rn = 1
GROUP BY GROUPING SETS ((studio_id), ())""")
def m09(ctx):
    return M.first_visit_no_show(ctx.bookings)


ECON_SQL = f"""SELECT coalesce(l.studio_id, s.studio_id) AS studio_id, coalesce(l.month, s.month) AS month,
    coalesce(l.channel, s.channel) AS channel, coalesce(leads, 0) AS leads, coalesce(bookings, 0) AS bookings,
    coalesce(buyers, 0) AS buyers, CAST(coalesce(rev, 0) AS DOUBLE) AS revenue,
    CAST(coalesce(spend, 0) AS DOUBLE) AS spend
  FROM (SELECT studio_id, {MONTH.format('created_at')} AS month, coalesce(utm_source, 'unknown') AS channel,
          count(*) AS leads, count(*) FILTER (WHERE yc_booking_id IS NOT NULL) AS bookings,
          count(*) FILTER (WHERE status_id IN {WON}) AS buyers,
          sum(booking_amount) FILTER (WHERE booking_status = 'visited') AS rev
        FROM leads_booked GROUP BY ALL) l
  FULL OUTER JOIN (SELECT studio_id, {MONTH.format('expense_date')} AS month, coalesce(channel, 'unknown') AS channel,
          sum(amount) AS spend FROM ad_spend GROUP BY ALL) s
  ON l.studio_id = s.studio_id AND l.month = s.month AND l.channel = s.channel"""
CPL = "round(spend / NULLIF(leads, 0), 2) AS cpl, round(spend / NULLIF(buyers, 0), 2) AS cac"
ROMI = "round(100.0 * ((revenue - spend) / NULLIF(spend, 0)), 1) AS romi"


@query("m11_cpl_cac", f"SELECT studio_id, month, channel, spend, leads, buyers, {CPL} FROM econ",
       views=[("econ", ECON_SQL)])
def m11(ctx):
    """Cost per lead and per acquisition by studio, month and channel."""
    return M.channel_economics(ctx.leads_booked, fx.ad_spend(ctx.t)).select(
        "studio_id", "month", "channel", "spend", "leads", "buyers", "cpl", "cac")


@query("m12_ltv", """SELECT c.studio_id, c.channel, count(*) AS clients, CAST(coalesce(sum(r.rev), 0) AS DOUBLE) AS revenue,
  round(CAST(coalesce(sum(r.rev), 0) AS DOUBLE) / count(*), 2) AS ltv
FROM fl c LEFT JOIN (
  SELECT v.studio_id, v.phone, sum(v.amount) AS rev FROM bookings v JOIN fl f ON f.studio_id = v.studio_id AND f.phone = v.phone
  WHERE v.status = 'visited' AND v.phone_valid AND v.visit_ts >= f.first_seen_at
    AND v.visit_ts < f.first_seen_at + INTERVAL 6 MONTH GROUP BY ALL) r
  ON r.studio_id = c.studio_id AND r.phone = c.phone
GROUP BY ALL""", views=[("fl", """SELECT studio_id, phone, created_at AS first_seen_at, coalesce(utm_source, 'unknown') AS channel
  FROM (SELECT *, row_number() OVER (PARTITION BY studio_id, phone ORDER BY created_at, lead_id) AS rn
        FROM leads WHERE phone_valid) WHERE rn = 1""")])
def m12(ctx):
    """Six-month LTV per studio and channel."""
    return M.ltv(ctx.leads, ctx.bookings, C.LTV_MONTHS)


@query("m13_romi", f"SELECT studio_id, month, channel, revenue, spend, {ROMI} FROM econ", views=[("econ", ECON_SQL)])
def m13(ctx):
    return M.channel_economics(ctx.leads_booked, fx.ad_spend(ctx.t)).select(
        "studio_id", "month", "channel", "revenue", "spend", "romi")


@query("m14_channel_roi", f"SELECT *, {CPL}, {ROMI} FROM econ", views=[("econ", ECON_SQL)])
def m14(ctx):
    """Channel ROI per month: leads, bookings, buyers, revenue, spend, CPL, CAC, ROMI."""
    return M.channel_economics(ctx.leads_booked, fx.ad_spend(ctx.t))


@query("m22_channel_totals", "SELECT studio_id, month, channel, leads, bookings, spend FROM econ",
       views=[("econ", ECON_SQL)])
def m22(ctx):
    return M.channel_economics(ctx.leads_booked, fx.ad_spend(ctx.t)).select(
        "studio_id", "month", "channel", "leads", "bookings", "spend")


@query("m15_weekly_funnel", f"""SELECT g.*, {PCT("g.lead_count", "p.lead_count")} AS conversion
FROM g LEFT JOIN g p ON p.studio_id = g.studio_id AND p.week_start = g.week_start AND p.stage_order = g.stage_order - 1""",
       views=[("g", f"""SELECT l.studio_id, {WEEK.format('l.created_at')} AS week_start, coalesce(s.stage_code, 'unknown') AS stage_code,
        s.stage_order, count(*) AS lead_count,
        round(avg(date_diff('microsecond', l.created_at, l.updated_at)) / 3600000000.0, 4) AS avg_hours
      FROM leads l LEFT JOIN funnel_stages s ON s.status_id = l.status_id GROUP BY ALL""")])
def m15(ctx):
    """Weekly funnel: count per stage, conversion from the previous stage, mean hours."""
    return M.weekly_funnel(N.map_stage(ctx.leads, N.stage_dim(ctx.spark)))


def _trend_sql(unit: str) -> tuple[str, list]:
    p = WEEK.format("created_at") if unit == "week" else MONTH.format("created_at")
    step = "INTERVAL 7 DAY" if unit == "week" else "INTERVAL 1 MONTH"
    grid = f"""SELECT studio_id, CAST(unnest(generate_series(CAST(min(period) AS TIMESTAMP),
        CAST(max(period) AS TIMESTAMP), {step})) AS DATE) AS period FROM cnt GROUP BY studio_id"""
    body = f"""SELECT studio_id, period, leads, prev_leads, leads - prev_leads AS delta,
  {PCT("leads - prev_leads", "prev_leads")} AS pct_change
FROM (SELECT g.studio_id, g.period, coalesce(c.leads, 0) AS leads,
        lag(coalesce(c.leads, 0)) OVER (PARTITION BY g.studio_id ORDER BY g.period) AS prev_leads
      FROM grid g LEFT JOIN cnt c ON c.studio_id = g.studio_id AND c.period = g.period)"""
    return body, [("cnt", f"SELECT studio_id, {p} AS period, count(*) AS leads FROM leads GROUP BY ALL"),
                  ("grid", grid)]


@query("m16_trend_week", *_trend_sql("week"))
def m16w(ctx):
    """Week-over-week lead trend on a dense week grid."""
    return M.trend(ctx.leads, "week")


@query("m16_trend_month", *_trend_sql("month"))
def m16m(ctx):
    """Month-over-month lead trend on a dense month grid."""
    return M.trend(ctx.leads, "month")


VIS = "SELECT * FROM bookings WHERE status = 'visited' AND phone_valid"


CM_SQL = f"SELECT studio_id, phone, {MONTH.format('visit_ts')} AS month, sum(amount) AS rev FROM vis GROUP BY ALL"
# a client-month, an 'all' copy of it, and the months that follow in the studio
LIFE_SQL = """SELECT s.scope AS studio_id, c.studio_id AS own, c.phone, c.month, c.rev,
    (SELECT min(f.month) FROM cm f WHERE f.studio_id = c.studio_id AND f.phone = c.phone) AS cohort_month,
    EXISTS (SELECT 1 FROM cm p WHERE p.studio_id = c.studio_id AND p.phone = c.phone
            AND p.month = CAST(c.month - INTERVAL 1 MONTH AS DATE)) AS stayed
  FROM cm c, (SELECT DISTINCT studio_id AS scope FROM cm UNION ALL SELECT 'all') s
  WHERE s.scope IN ('all', c.studio_id)"""
MONTHS_SQL = """SELECT studio_id, CAST(unnest(generate_series(CAST(min(month) AS TIMESTAMP), CAST(max(month) AS TIMESTAMP),
    INTERVAL 1 MONTH)) AS DATE) AS month FROM life GROUP BY studio_id"""


@query("m17_monthly_cohorts", f"""SELECT studio_id, cohort_month, month, CAST(date_diff('month', cohort_month, month) AS INTEGER) AS months_since,
  clients, active, returned, lost, CAST(rev AS DOUBLE) AS revenue, CAST(so_far AS DOUBLE) / clients AS ltv,
  CAST(spend AS DOUBLE) / clients AS cac,
  100.0 * ((CAST(so_far AS DOUBLE) - CAST(spend AS DOUBLE)) / NULLIF(CAST(spend AS DOUBLE), 0)) AS romi
FROM (SELECT x.*, coalesce(p.active, 0) - x.stayed AS lost, s.spend,
    (SELECT sum(y.rev) FROM x y WHERE y.studio_id = x.studio_id AND y.cohort_month = x.cohort_month AND y.month <= x.month) AS so_far
  FROM x LEFT JOIN x p ON p.studio_id = x.studio_id AND p.cohort_month = x.cohort_month
      AND p.month = CAST(x.month - INTERVAL 1 MONTH AS DATE)
    LEFT JOIN (SELECT {ALL()}, {MONTH.format('expense_date')} AS cohort_month, sum(amount) AS spend FROM ad_spend
        GROUP BY GROUPING SETS ((studio_id, {MONTH.format('expense_date')}), ({MONTH.format('expense_date')}))) s
      ON s.studio_id = x.studio_id AND s.cohort_month = x.cohort_month)""", views=[
    ("vis", VIS), ("cm", CM_SQL), ("life", LIFE_SQL), ("months", MONTHS_SQL),
    ("x", """SELECT z.studio_id, z.cohort_month, m.month, z.clients, count(l.phone) AS active,
        count(l.phone) FILTER (WHERE l.stayed) AS stayed,
        count(l.phone) FILTER (WHERE NOT l.stayed AND l.month > l.cohort_month) AS returned, coalesce(sum(l.rev), 0) AS rev
      FROM (SELECT studio_id, cohort_month, count(*) AS clients FROM life WHERE month = cohort_month GROUP BY ALL) z
      JOIN months m ON m.studio_id = z.studio_id AND m.month >= z.cohort_month
      LEFT JOIN life l ON l.studio_id = z.studio_id AND l.cohort_month = z.cohort_month AND l.month = m.month
      GROUP BY ALL""")])
def m17(ctx):
    """Monthly cohorts by first-visit month on a dense grid: active, returned, lost, LTV, CAC, ROMI."""
    return M.monthly_cohorts(ctx.bookings, fx.ad_spend(ctx.t))


@query("m18_activity_segments", f"""SELECT studio_id, phone, first_visit, last_visit, prev_visit,
  CASE WHEN first_visit >= DATE '{AS_OF_STAR}' - 30 THEN 'new'
       WHEN date_diff('day', last_visit, DATE '{AS_OF_STAR}') < 30 AND date_diff('day', prev_visit, last_visit) > 90 THEN 'returned'
       WHEN date_diff('day', last_visit, DATE '{AS_OF_STAR}') < 30 THEN 'active'
       WHEN date_diff('day', last_visit, DATE '{AS_OF_STAR}') <= 90 THEN 'passive' ELSE 'lost' END AS segment,
  date_diff('day', last_visit, DATE '{AS_OF_STAR}') AS days_since_visit
FROM (SELECT studio_id, phone, min(visit_date) AS first_visit, max(visit_date) AS last_visit,
        max(visit_date) FILTER (WHERE visit_date < lv) AS prev_visit
      FROM (SELECT *, max(visit_date) OVER (PARTITION BY studio_id, phone) AS lv FROM vis
            WHERE visit_date <= DATE '{AS_OF_STAR}') GROUP BY ALL)""", views=[("vis", VIS)])
def m18(ctx):
    """Client activity segments as of a date."""
    return M.activity_segments(ctx.bookings, AS_OF_STAR).select(
        "studio_id", "phone", "first_visit", "last_visit", "prev_visit", "segment", "days_since_visit")


@query("m19_retention", f"""SELECT g.studio_id, g.month, g.active, g.retained, p.active AS prev_active,
  {PCT("g.retained", "p.active")} AS retention, round(100.0 - {PCT("g.retained", "p.active")}, 1) AS churn,
  round(CAST((SELECT sum(rev) FROM life x WHERE x.studio_id = g.studio_id AND x.month <= g.month) AS DOUBLE)
    / (SELECT count(*) FROM life x WHERE x.studio_id = g.studio_id AND x.month <= g.month AND x.month = x.cohort_month), 2) AS mean_ltv
FROM g LEFT JOIN g p ON p.studio_id = g.studio_id AND p.month = CAST(g.month - INTERVAL 1 MONTH AS DATE)""",
       views=[("vis", VIS), ("cm", CM_SQL), ("life", LIFE_SQL), ("months", MONTHS_SQL),
              ("g", """SELECT m.studio_id, m.month, count(l.phone) AS active, count(l.phone) FILTER (WHERE l.stayed) AS retained
       FROM months m LEFT JOIN life l ON l.studio_id = m.studio_id AND l.month = m.month GROUP BY ALL""")])
def m19(ctx):
    """Month-over-month retention, churn and mean LTV on a dense month grid."""
    return M.retention(ctx.bookings)


@query("m20_funnel_kpis", f"""SELECT {ALL()}, count(*) AS leads,
  count(*) FILTER (WHERE booking_status = 'visited') AS visited,
  count(*) FILTER (WHERE booking_status = 'visited' AND status_id IN {WON}) AS purchases,
  {PCT("count(*) FILTER (WHERE booking_status = 'visited')", "count(*)")} AS lead_to_visit,
  {PCT(f"count(*) FILTER (WHERE booking_status = 'visited' AND status_id IN {WON})",
       "count(*) FILTER (WHERE booking_status = 'visited')")} AS visit_to_purchase,
  {PCT("count(*) FILTER (WHERE status_id = 74087594)", "count(*) FILTER (WHERE status_id = 74087590)")} AS funnel_no_show_rate,
  round(avg(date_diff('microsecond', created_at, closed_at)) FILTER (WHERE status_id = 142) / 86400000000.0, 2) AS sales_cycle_days,
  round(CAST(sum(price) FILTER (WHERE status_id = 142) AS DOUBLE) / count(*), 2) AS revenue_per_lead
FROM leads_booked GROUP BY GROUPING SETS ((studio_id), ())""")
def m20(ctx):
    """Funnel KPIs per studio and 'all'."""
    return M.funnel_kpis(ctx.leads_booked)


def _status_sql(col: str, lo: float, hi: float) -> str:
    return (f"CASE WHEN {col} IS NULL THEN NULL WHEN {col} < {lo} THEN 'below' WHEN {col} > {hi} THEN 'above' "
            f"ELSE 'within' END AS {col}_status")


@query("m21_kpi_status", "SELECT *, " + ", ".join(_status_sql(k, lo, hi) for k, (lo, hi) in C.KPI_NORMS.items())
       + f""" FROM (SELECT coalesce(l.studio_id, b.studio_id) AS studio_id,
    {PCT("l.booked", "l.leads")} AS lead_to_booking, {PCT("b.visits", "b.bookings")} AS booking_to_visit,
    {PCT("l.won", "l.leads")} AS lead_to_abonement
  FROM (SELECT {ALL()}, count(*) AS leads, count(*) FILTER (WHERE yc_booking_id IS NOT NULL) AS booked,
          count(*) FILTER (WHERE status_id IN {WON}) AS won FROM leads_booked GROUP BY GROUPING SETS ((studio_id), ())) l
  FULL OUTER JOIN (SELECT {ALL()}, count(*) AS bookings, count(*) FILTER (WHERE status = 'visited') AS visits
          FROM bookings GROUP BY GROUPING SETS ((studio_id), ())) b ON l.studio_id = b.studio_id)""")
def m21(ctx):
    """KPI values with below / within / above their norm range."""
    return M.kpi_report(ctx.leads_booked, ctx.bookings)


@query("m23_abonement_ranking", f"""SELECT studio_id, service_type, sold, CAST(r AS DOUBLE) AS revenue,
  {PCT("r", "sum(r) OVER (PARTITION BY studio_id)")} AS share_pct,
  round(CAST(r AS DOUBLE) / NULLIF(sold, 0), 2) AS mean_check,
  rank() OVER (PARTITION BY studio_id ORDER BY r DESC) AS rank,
  rank() OVER (PARTITION BY studio_id ORDER BY r DESC) <= 3 AS is_top3
FROM (SELECT b.studio_id, p.p_type AS service_type, count(*) AS sold, sum(b.amount) AS r
      FROM bookings b JOIN part p ON p.p_partkey = b.service_id
      WHERE b.quantity >= 40 AND b.status = 'visited' GROUP BY ALL)""")
def m23(ctx):
    """Subscription ranking: sold, revenue, share, mean check, rank, top 3."""
    return M.abonement_ranking(ctx.bookings, fx.part_types(ctx.t))


@query("m24_new_clients_by_master", f"""SELECT studio_id, {WEEK.format('visit_ts')} AS week_start, master_id,
  count(*) AS new_clients
FROM (SELECT *, row_number() OVER (PARTITION BY studio_id, phone ORDER BY visit_ts, booking_id) AS rn FROM vis)
WHERE rn = 1 GROUP BY ALL""", views=[("vis", VIS)])
def m24(ctx):
    return M.new_clients_by_master(ctx.bookings)


@query("m25_traffic_quality", f"""SELECT studio_id, month, channel, count(*) AS leads,
  {PCT("count(*) FILTER (WHERE yc_booking_id IS NOT NULL)", "count(*)")} AS conversion,
  CAST(sum(booking_amount) FILTER (WHERE booking_status = 'visited') AS DOUBLE)
        / NULLIF(count(*) FILTER (WHERE booking_status = 'visited'), 0) AS avg_check,
  {PCT("count(*) FILTER (WHERE visits >= 2)", "count(*)")} AS retention
FROM (SELECT l.*, {MONTH.format('l.created_at')} AS month, coalesce(l.utm_source, 'unknown') AS channel, cv.visits
      FROM leads_booked l LEFT JOIN cv ON cv.studio_id = l.studio_id AND cv.phone = l.phone)
GROUP BY studio_id, month, channel""", views=[("cv", CV_SQL)])
def m25(ctx):
    """Traffic quality by channel: conversion, mean check, returning share."""
    return M.traffic_quality(ctx.leads_booked, ctx.bookings)


@query("m26_source_ranking", """SELECT studio_id, utm_source, count(*) AS leads,
  row_number() OVER (PARTITION BY studio_id ORDER BY count(*) DESC, utm_source ASC NULLS LAST) AS rank
FROM leads GROUP BY studio_id, utm_source""")
def m26(ctx):
    return M.source_ranking(ctx.leads)


@query("m27_weak_channels", f"""SELECT * FROM (SELECT studio_id, utm_source, count(*) AS leads,
  count(*) FILTER (WHERE yc_booking_id IS NOT NULL) AS bookings,
  count(*) FILTER (WHERE status_id IN {WON}) AS abonements,
  {PCT("count(*) FILTER (WHERE yc_booking_id IS NOT NULL)", "count(*)")} AS lead_to_booking,
  {PCT(f"count(*) FILTER (WHERE status_id IN {WON})", "count(*)")} AS conversion
FROM leads_booked GROUP BY ALL) WHERE conversion < {C.DEFAULT_THRESHOLDS['weak_channel_conversion']}""")
def m27(ctx):
    """Channels that convert too few leads to subscriptions, with their bookings."""
    return M.weak_channels(ctx.leads_booked, C.DEFAULT_THRESHOLDS["weak_channel_conversion"])


@query("m28_loss_analysis", """SELECT studio_id, utm_source,
  CASE WHEN price < 100000 THEN '<100k' WHEN price < 200000 THEN '100k-200k' WHEN price < 300000 THEN '200k-300k'
       ELSE '>=300k' END AS price_band, count(*) AS leads,
  quantile_cont(CAST(price AS DOUBLE), 0.5) AS median_price,
  round(avg(date_diff('microsecond', created_at, closed_at)) / 86400000000.0, 2) AS avg_days_open
FROM leads WHERE status_id = 143 GROUP BY ALL""")
def m28(ctx):
    """Closed-lost leads by source and price band."""
    return M.loss_analysis(ctx.leads)


@query("m29_deposit_clients", """SELECT l.studio_id, l.lead_id, l.client_name, l.phone, CAST(l.price AS DOUBLE) AS deposit,
  CAST(coalesce(cv.revenue, 0) AS DOUBLE) AS paid, CAST(l.price - coalesce(cv.revenue, 0) AS DOUBLE) AS debt
FROM leads l LEFT JOIN cv ON cv.studio_id = l.studio_id AND cv.phone = l.phone
WHERE l.status_id = 84237074""", views=[("cv", CV_SQL)])
def m29(ctx):
    return M.deposit_clients(ctx.leads, ctx.bookings)


@query("m30_lapsed_history", f"""SELECT l.studio_id, l.lead_id, l.phone, h.visit_count, h.last_visit,
  date_diff('day', h.last_visit, DATE '{AS_OF_STAR}') AS days_since, h.services, h.masters
FROM leads l JOIN (
  SELECT studio_id, phone, count(*) AS visit_count, max(visit_date) AS last_visit,
    array_to_string(list_sort(list_distinct(list(service_id))), ',') AS services,
    count(DISTINCT master_id) AS masters
  FROM vis WHERE visit_date <= DATE '{AS_OF_STAR}' GROUP BY ALL) h
  ON h.studio_id = l.studio_id AND h.phone = l.phone
WHERE l.status_id = 83303646 AND l.phone_valid
  AND date_diff('day', h.last_visit, DATE '{AS_OF_STAR}') > {int(C.DEFAULT_THRESHOLDS['lapsed_days'])}""",
       views=[("vis", VIS)])
def m30(ctx):
    """Not-renewed clients with their visit history (all services)."""
    return M.lapsed_history(ctx.leads, ctx.bookings, AS_OF_STAR, int(C.DEFAULT_THRESHOLDS["lapsed_days"]))


@query("m31_channel_quality", f"""SELECT e.*, {CPL}, {ROMI}, q.quality_score FROM econ e LEFT JOIN (
  SELECT studio_id, month, channel,
    round({PCT("count(*) FILTER (WHERE visits >= 2)", "count(*)")} / 100.0, 4) AS quality_score
  FROM (SELECT l.*, {MONTH.format('l.created_at')} AS month, coalesce(l.utm_source, 'unknown') AS channel, cv.visits
        FROM leads_booked l LEFT JOIN cv ON cv.studio_id = l.studio_id AND cv.phone = l.phone)
  GROUP BY studio_id, month, channel) q
ON q.studio_id = e.studio_id AND q.month = e.month AND q.channel = e.channel""",
       views=[("econ", ECON_SQL), ("cv", CV_SQL)])
def m31(ctx):
    """Channel ROI with a data-derived channel quality score carried as a column."""
    econ = M.channel_economics(ctx.leads_booked, fx.ad_spend(ctx.t))
    scores = M.quality_scores(M.traffic_quality(ctx.leads_booked, ctx.bookings))
    return M.with_quality(econ, scores)
