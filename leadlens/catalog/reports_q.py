"""Report (P-*), named-query (Q-*) and feed (F-*) datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlens import config as C
from leadlens.catalog.metrics_q import ALL, ECON_SQL, PCT, VIS, WEEK, WON
from leadlens.plans import event_metrics as T
from leadlens.plans import metrics as M
from leadlens.plans import reports as P
from leadlens.registry import query
from leadlens.sources import fixtures as fx
from leadlens.sources.fixtures import AS_OF_EVENTS, AS_OF_STAR

Q_FROM, Q_TO = "2001-01-01", "2001-06-30"


@query("p01_daily_report", f"""SELECT coalesce(d.studio_id, a.studio_id) AS studio_id,
  coalesce(d.report_date, a.report_date) AS report_date, coalesce(d.leads, 0) AS leads,
  coalesce(d.bookings, 0) AS bookings, d.conversion, d.conversion_change, coalesce(a.n, 0) AS admin_booked,
  r.mismatch_pct AS crm_booking_mismatch_pct
FROM (SELECT *, round(conversion - lag(conversion) OVER (PARTITION BY studio_id ORDER BY report_date), 1)
        AS conversion_change
      FROM (SELECT studio_id, lead_date AS report_date, count(*) AS leads,
              count(*) FILTER (WHERE yc_booking_id IS NOT NULL) AS bookings,
              {PCT("count(*) FILTER (WHERE yc_booking_id IS NOT NULL)", "count(*)")} AS conversion
            FROM leads_booked GROUP BY ALL)) d
FULL OUTER JOIN (SELECT b.studio_id, b.visit_date AS report_date, count(*) AS n FROM bookings b
      WHERE b.phone_valid AND NOT EXISTS (SELECT 1 FROM leads l WHERE l.phone_valid AND l.studio_id = b.studio_id
        AND l.phone = b.phone) GROUP BY ALL) a
  ON a.studio_id = d.studio_id AND a.report_date = d.report_date
LEFT JOIN (SELECT studio_id, round(100.0 * (CAST(count(*) FILTER (WHERE status_id = 74087590 AND yc_booking_id IS NULL)
      AS DOUBLE) / NULLIF(count(*) FILTER (WHERE status_id = 74087590), 0)), 2) AS mismatch_pct
    FROM leads_booked GROUP BY studio_id) r
  ON r.studio_id = coalesce(d.studio_id, a.studio_id)""")
def p01(ctx):
    """Daily report rows: leads, bookings, conversion and its change, admin-booked, mismatch %."""
    from leadlens.plans import normalize as N
    from leadlens.plans import reconcile as R
    recon = R.reconcile_bookings(ctx.leads_booked).filter(F.col("studio_id") != "all")
    return P.report_daily(ctx.leads_booked, N.created_by_admin(ctx.bookings, ctx.leads), recon)


@query("p02_weekly_top_channels", f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY studio_id, week_start ORDER BY leads DESC, channel) AS rank
  FROM (SELECT studio_id, {WEEK.format('created_at')} AS week_start, coalesce(utm_source, 'unknown') AS channel,
          count(*) AS leads, count(*) FILTER (WHERE yc_booking_id IS NOT NULL) AS bookings
        FROM leads_booked GROUP BY ALL)) WHERE rank <= 5""")
def p02(ctx):
    """Top-5 channels per studio and week."""
    return P.report_weekly_top_channels(ctx.leads_booked, 5)


@query("p03_client_base", f"""SELECT studio_id, count(*) AS clients,
  count(*) FILTER (WHERE segment = 'new') AS new, count(*) FILTER (WHERE segment = 'returned') AS returned,
  count(*) FILTER (WHERE segment = 'active') AS active, count(*) FILTER (WHERE segment = 'passive') AS passive,
  count(*) FILTER (WHERE segment = 'lost') AS lost
FROM (SELECT studio_id,
  CASE WHEN first_visit >= DATE '{AS_OF_STAR}' - 30 THEN 'new'
       WHEN date_diff('day', last_visit, DATE '{AS_OF_STAR}') < 30 AND date_diff('day', prev_visit, last_visit) > 90 THEN 'returned'
       WHEN date_diff('day', last_visit, DATE '{AS_OF_STAR}') < 30 THEN 'active'
       WHEN date_diff('day', last_visit, DATE '{AS_OF_STAR}') <= 90 THEN 'passive' ELSE 'lost' END AS segment
  FROM (SELECT studio_id, phone, min(visit_date) AS first_visit, max(visit_date) AS last_visit,
          max(visit_date) FILTER (WHERE visit_date < lv) AS prev_visit
        FROM (SELECT *, max(visit_date) OVER (PARTITION BY studio_id, phone) AS lv FROM vis
              WHERE visit_date <= DATE '{AS_OF_STAR}') GROUP BY ALL))
GROUP BY studio_id""", views=[("vis", VIS)])
def p03(ctx):
    """Client base report: clients per activity segment."""
    return P.report_clients(M.activity_segments(ctx.bookings, AS_OF_STAR))


@query("p04_top_abonements", f"""SELECT * FROM (SELECT studio_id, service_type, sold, CAST(r AS DOUBLE) AS revenue,
  {PCT("r", "sum(r) OVER (PARTITION BY studio_id)")} AS share_pct,
  round(CAST(r AS DOUBLE) / NULLIF(sold, 0), 2) AS mean_check,
  rank() OVER (PARTITION BY studio_id ORDER BY r DESC) AS rank,
  rank() OVER (PARTITION BY studio_id ORDER BY r DESC) <= 3 AS is_top3
FROM (SELECT b.studio_id, p.p_type AS service_type, count(*) AS sold, sum(b.amount) AS r
      FROM bookings b JOIN part p ON p.p_partkey = b.service_id
      WHERE b.quantity >= 40 AND b.status = 'visited' GROUP BY ALL)) WHERE is_top3""")
def p04(ctx):
    """Top-3 subscription types per studio."""
    return P.report_abonements(M.abonement_ranking(ctx.bookings, fx.part_types(ctx.t)))


@query("p05_channel_report", """SELECT
  CASE WHEN grouping(studio_id) = 1 THEN 'all' ELSE studio_id END AS studio_id,
  CASE WHEN grouping(channel) = 1 THEN 'all' ELSE channel END AS channel,
  CAST(sum(leads) AS BIGINT) AS leads, CAST(sum(buyers) AS BIGINT) AS buyers,
  round(sum(revenue), 2) AS revenue, round(sum(spend), 2) AS spend,
  round(round(sum(spend), 2) / NULLIF(CAST(sum(buyers) AS BIGINT), 0), 2) AS cac,
  round(100.0 * ((round(sum(revenue), 2) - round(sum(spend), 2)) / NULLIF(round(sum(spend), 2), 0)), 1) AS romi
FROM econ GROUP BY CUBE (studio_id, channel)""", views=[("econ", ECON_SQL)])
def p05(ctx):
    """Channel report with studio totals, network rows per channel and the grand total (CUBE)."""
    return P.report_channels(M.channel_economics(ctx.leads_booked, fx.ad_spend(ctx.t)))


@query("p06_recent_days", """SELECT studio_id, summary_date, leads, bookings, lead_to_booking FROM (
  SELECT *, row_number() OVER (PARTITION BY studio_id ORDER BY summary_date DESC) AS rn FROM (
    SELECT CASE WHEN grouping(studio_id) = 1 THEN 'all' ELSE studio_id END AS studio_id, summary_date,
      CAST(sum(l) AS BIGINT) AS leads, CAST(sum(b) AS BIGINT) AS bookings,
      round(100.0 * (CAST(sum(b) AS DOUBLE) / NULLIF(sum(l), 0)), 1) AS lead_to_booking
    FROM (SELECT studio_id, lead_date AS summary_date, 1 AS l, (yc_booking_id IS NOT NULL)::INT AS b FROM leads_booked
          UNION ALL SELECT studio_id, visit_date, 0, 0 FROM bookings)
    GROUP BY GROUPING SETS ((studio_id, summary_date), (summary_date))))
WHERE rn <= 5""")
def p06(ctx):
    """The five most recent days of every studio (and 'all')."""
    daily = M.daily_summary(ctx.leads_booked, ctx.bookings).filter(F.col("channel") == "all")
    return P.recent_days(daily, 5).select("studio_id", "summary_date", "leads", "bookings", "lead_to_booking")


LEAD_DAILY = """SELECT CASE WHEN grouping(studio_id) = 1 THEN 'all' ELSE studio_id END AS studio_id,
    lead_date AS summary_date, CASE WHEN grouping(channel) = 1 THEN 'all' ELSE channel END AS channel,
    count(*) AS leads, count(*) FILTER (WHERE yc_booking_id IS NOT NULL) AS bookings
  FROM (SELECT *, coalesce(utm_source, 'unknown') AS channel FROM leads_booked)
  GROUP BY GROUPING SETS ((studio_id, lead_date, channel), (studio_id, lead_date), (lead_date, channel), (lead_date))"""


def _daily(ctx):
    return M.daily_summary(ctx.leads_booked, ctx.bookings).filter(F.col("leads") > 0)


@query("q01_leads_period", f"""SELECT studio_id, channel, CAST(sum(leads) AS BIGINT) AS leads FROM ld
WHERE studio_id = 'all' AND summary_date BETWEEN DATE '{Q_FROM}' AND DATE '{Q_TO}' GROUP BY ALL""",
       views=[("ld", LEAD_DAILY)])
def q01(ctx):
    """leads(period), default studio 'all'."""
    return P.q_leads(_daily(ctx), Q_FROM, Q_TO, "all")


@query("q02_leads_weekly", f"""SELECT studio_id, channel, CAST(sum(leads) AS BIGINT) AS leads FROM ld
WHERE studio_id = 'all' AND summary_date > DATE '{AS_OF_STAR}' - 7 AND summary_date <= DATE '{AS_OF_STAR}'
GROUP BY ALL""", views=[("ld", LEAD_DAILY)])
def q02(ctx):
    """leads_weekly(): the last 7 days."""
    return P.q_leads_weekly(_daily(ctx), AS_OF_STAR, "all")


@query("q03_conversion", f"""SELECT studio_id, utm_source, CAST(sum(leads) AS BIGINT) AS leads,
  CAST(sum(bookings) AS BIGINT) AS bookings, {PCT("sum(bookings)", "sum(leads)")} AS conversion
FROM (SELECT {ALL()}, utm_source, count(*) AS leads, count(*) FILTER (WHERE yc_booking_id IS NOT NULL) AS bookings
      FROM leads_booked GROUP BY GROUPING SETS ((studio_id, utm_source, lead_date), (utm_source, lead_date)))
WHERE studio_id = 'all' GROUP BY ALL""")
def q03(ctx):
    """conversion('lead_to_booking') by source, studio 'all'."""
    return P.q_conversion(M.lead_to_booking(ctx.leads_booked), "all")


@query("q06_no_shows", f"""SELECT studio_id, 'day' AS grain, visit_date AS period_start, CAST(NULL AS BIGINT) AS master_id,
  count(*) AS booked, count(*) FILTER (WHERE status = 'no_show') AS no_shows,
  {PCT("count(*) FILTER (WHERE status = 'no_show')", "count(*)")} AS no_show_rate
FROM bookings WHERE visit_date BETWEEN DATE '{Q_FROM}' AND DATE '{Q_TO}' GROUP BY studio_id, visit_date""")
def q06(ctx):
    """no_shows(period): daily no-show rows."""
    return P.q_no_shows(M.no_show_rate(ctx.bookings), Q_FROM, Q_TO)


@query("q08_historical_funnel_on", """SELECT studio_id, snapshot_date, stage_name, lead_count FROM hist
WHERE snapshot_date = DATE '2024-01-20'""", views=[("cal", f"""SELECT studio_id,
    CAST(unnest(generate_series(CAST(min_d AS TIMESTAMP), TIMESTAMP '{AS_OF_EVENTS}', INTERVAL 1 DAY)) AS DATE) AS d
  FROM (SELECT studio_id, min(CASE WHEN valid_from = CAST(CAST(valid_from AS DATE) AS TIMESTAMP)
        THEN CAST(valid_from AS DATE) ELSE CAST(valid_from AS DATE) + 1 END) AS min_d
        FROM lead_snapshots GROUP BY studio_id)"""),
    ("hist", f"""SELECT c.studio_id, c.d AS snapshot_date,
    s.stage AS stage_name, count(*) AS lead_count
  FROM cal c JOIN lead_snapshots s ON s.studio_id = c.studio_id AND s.valid_from <= CAST(c.d AS TIMESTAMP)
    AND (s.valid_to IS NULL OR s.valid_to > CAST(c.d AS TIMESTAMP)) GROUP BY ALL""")])
def q08(ctx):
    """historical_funnel(date)."""
    return P.q_historical_funnel(T.historical_funnel(ctx.snapshots, AS_OF_EVENTS), "2024-01-20")


@query("f01_feed_bookings", "SELECT studio_id, summary_date, channel, leads, bookings FROM ld",
       views=[("ld", LEAD_DAILY)])
def f01(ctx):
    """Daily feed {studio, date, channel, leads, bookings}."""
    return _daily(ctx).select("studio_id", "summary_date", "channel", "leads", "bookings")


@query("f03_feed_masters", f"""SELECT studio_id, {WEEK.format('visit_ts')} AS week_start, master_id,
  count(*) AS new_clients
FROM (SELECT *, row_number() OVER (PARTITION BY studio_id, phone ORDER BY visit_ts, booking_id) AS rn FROM vis)
WHERE rn = 1 GROUP BY ALL""", views=[("vis", VIS)])
def f03(ctx):
    """Weekly feed {studio, week, master_id, new_clients}."""
    return M.new_clients_by_master(ctx.bookings)


LTV_VIEWS = [("fl", """SELECT studio_id, phone, created_at AS first_seen_at, coalesce(utm_source, 'unknown') AS channel
  FROM (SELECT *, row_number() OVER (PARTITION BY studio_id, phone ORDER BY created_at, lead_id) AS rn
        FROM leads WHERE phone_valid) WHERE rn = 1"""),
             ("ltv", """SELECT c.studio_id, c.channel, round(CAST(coalesce(sum(r.rev), 0) AS DOUBLE) / count(*), 2) AS ltv
  FROM fl c LEFT JOIN (
    SELECT v.studio_id, v.phone, sum(v.amount) AS rev FROM bookings v JOIN fl f ON f.studio_id = v.studio_id AND f.phone = v.phone
    WHERE v.status = 'visited' AND v.phone_valid AND v.visit_ts >= f.first_seen_at
      AND v.visit_ts < f.first_seen_at + INTERVAL 6 MONTH GROUP BY ALL) r
    ON r.studio_id = c.studio_id AND r.phone = c.phone GROUP BY ALL""")]


@query("f02_feed_finance", """SELECT e.studio_id, e.month, e.channel, round(e.spend / NULLIF(e.buyers, 0), 2) AS cac,
  l.ltv, round(100.0 * ((e.revenue - e.spend) / NULLIF(e.spend, 0)), 1) AS romi, e.revenue
FROM econ e LEFT JOIN ltv l ON l.studio_id = e.studio_id AND l.channel = e.channel""",
       views=[("econ", ECON_SQL)] + LTV_VIEWS)
def f02(ctx):
    """Monthly finance feed {studio, month, channel, cac, ltv, romi, revenue}."""
    econ = M.channel_economics(ctx.leads_booked, fx.ad_spend(ctx.t))
    ltv = M.ltv(ctx.leads, ctx.bookings).select("studio_id", "channel", "ltv")
    return econ.join(ltv, ["studio_id", "channel"], "left").select(
        "studio_id", "month", "channel", "cac", "ltv", "romi", "revenue")


@query("f04_feed_quality", f"""SELECT studio_id, month, channel,
  {PCT("count(*) FILTER (WHERE yc_booking_id IS NOT NULL)", "count(*)")} AS conversion,
  CAST(sum(booking_amount) FILTER (WHERE booking_status = 'visited') AS DOUBLE)
        / NULLIF(count(*) FILTER (WHERE booking_status = 'visited'), 0) AS avg_check,
  {PCT("count(*) FILTER (WHERE visits >= 2)", "count(*)")} AS retention
FROM (SELECT l.*, CAST(date_trunc('month', l.created_at) AS DATE) AS month, coalesce(l.utm_source, 'unknown') AS channel,
        cv.visits
      FROM leads_booked l LEFT JOIN (SELECT studio_id, phone, count(*) AS visits FROM bookings
        WHERE status = 'visited' AND phone_valid GROUP BY ALL) cv ON cv.studio_id = l.studio_id AND cv.phone = l.phone)
GROUP BY studio_id, month, channel""")
def f04(ctx):
    """Monthly quality feed {studio, month, channel, conversion, avg_check, retention}."""
    return M.traffic_quality(ctx.leads_booked, ctx.bookings).select(
        "studio_id", "month", "channel", "conversion", "avg_check", "retention")


@query("f05_feed_summary", f"""SELECT {ALL()}, {WEEK.format('created_at')} AS week_start, count(*) AS leads,
  count(*) FILTER (WHERE yc_booking_id IS NOT NULL) AS bookings,
  {PCT("count(*) FILTER (WHERE yc_booking_id IS NOT NULL)", "count(*)")} AS conversion
FROM leads_booked GROUP BY GROUPING SETS ((studio_id, {WEEK.format('created_at')}), ({WEEK.format('created_at')}))""")
def f05(ctx):
    """Weekly summary feed per studio and 'all': leads, bookings, conversion."""
    from leadlens.operators.grouping import with_consolidated
    l = ctx.leads_booked.withColumn("week_start", F.to_date(F.date_trunc("week", "created_at")))
    g = with_consolidated(l, "studio_id", ["week_start"], [
        F.count(F.lit(1)).alias("leads"), F.count_if(F.col("yc_booking_id").isNotNull()).alias("bookings")])
    return g.withColumn("conversion", M.pct("bookings", "leads"))


@query("q04_source_ranking_all", """SELECT 'all' AS studio_id, utm_source, count(*) AS leads,
  row_number() OVER (ORDER BY count(*) DESC, utm_source ASC NULLS LAST) AS rank
FROM leads GROUP BY utm_source""")
def q04(ctx):
    """source_ranking() across all studios (ranking window over the aggregated sources only)."""
    l = ctx.leads.withColumn("studio_id", F.lit("all"))
    return M.source_ranking(l)


@query("q07_weak_channels_all", f"""SELECT * FROM (SELECT 'all' AS studio_id, utm_source, count(*) AS leads,
  count(*) FILTER (WHERE yc_booking_id IS NOT NULL) AS bookings,
  count(*) FILTER (WHERE status_id IN {WON}) AS abonements,
  {PCT("count(*) FILTER (WHERE yc_booking_id IS NOT NULL)", "count(*)")} AS lead_to_booking,
  {PCT(f"count(*) FILTER (WHERE status_id IN {WON})", "count(*)")} AS conversion
FROM leads_booked GROUP BY utm_source) WHERE conversion < {C.DEFAULT_THRESHOLDS['weak_channel_conversion']}""")
def q07(ctx):
    """weak_channels() across all studios, at the configured threshold."""
    l = ctx.leads_booked.withColumn("studio_id", F.lit("all"))
    return M.weak_channels(l, C.DEFAULT_THRESHOLDS["weak_channel_conversion"])


@query("q09_channels_all", """SELECT * FROM (SELECT
  CASE WHEN grouping(studio_id) = 1 THEN 'all' ELSE studio_id END AS studio_id,
  CASE WHEN grouping(channel) = 1 THEN 'all' ELSE channel END AS channel,
  CAST(sum(leads) AS BIGINT) AS leads, CAST(sum(buyers) AS BIGINT) AS buyers,
  round(sum(revenue), 2) AS revenue, round(sum(spend), 2) AS spend,
  round(round(sum(spend), 2) / NULLIF(CAST(sum(buyers) AS BIGINT), 0), 2) AS cac,
  round(100.0 * ((round(sum(revenue), 2) - round(sum(spend), 2)) / NULLIF(round(sum(spend), 2), 0)), 1) AS romi
FROM econ GROUP BY CUBE (studio_id, channel)) WHERE studio_id = 'all'""", views=[("econ", ECON_SQL)])
def q09(ctx):
    """channels(): the network-wide channel rows of the channel report."""
    rep = P.report_channels(M.channel_economics(ctx.leads_booked, fx.ad_spend(ctx.t)))
    return rep.filter(F.col("studio_id") == "all")
