"""Reconciliation queries (R-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlens.plans import normalize as N
from leadlens.plans import reconcile as R
from leadlens.registry import query

SEV = """CASE WHEN {p} IS NULL THEN NULL WHEN {p} < 5 THEN 'INFO' WHEN {p} <= 10 THEN 'WARNING'
  ELSE 'CRITICAL' END AS severity, coalesce({p} > 20, false) AS escalate"""


def _mpct(a, b):
    return f"round(100.0 * (CAST(abs({a} - {b}) AS DOUBLE) / NULLIF(greatest({a}, {b}), 0)), 2)"


@query("r01_crm_vs_booking", f"""SELECT *, {SEV.format(p='mismatch_pct')} FROM (
  SELECT CASE WHEN grouping(studio_id) = 1 THEN 'all' ELSE studio_id END AS studio_id,
    count(*) FILTER (WHERE status_id = 74087590) AS appointments,
    count(*) FILTER (WHERE status_id = 74087590 AND yc_booking_id IS NULL) AS unmatched,
    round(100.0 * (CAST(count(*) FILTER (WHERE status_id = 74087590 AND yc_booking_id IS NULL) AS DOUBLE)
      / NULLIF(count(*) FILTER (WHERE status_id = 74087590), 0)), 2) AS mismatch_pct
  FROM leads_booked GROUP BY GROUPING SETS ((studio_id), ()))""")
def r01(ctx):
    """Appointment leads without a booking; severity band and escalation."""
    return R.reconcile_bookings(ctx.leads_booked)


@query("r02_crm_vs_sheet", f"""SELECT *, {SEV.format(p='leads_pct')} FROM (
  SELECT coalesce(a.studio_id, b.studio_id) AS studio_id, coalesce(a.month, b.month) AS month,
    coalesce(a.n, 0) AS leads_a, coalesce(b.n, 0) AS leads_b,
    {_mpct('coalesce(a.n, 0)', 'coalesce(b.n, 0)')} AS leads_pct
  FROM (SELECT studio_id, CAST(date_trunc('month', created_at) AS DATE) AS month, count(*) AS n FROM leads GROUP BY ALL) a
  FULL OUTER JOIN (SELECT studio_id, CAST(date_trunc('month', created_at) AS DATE) AS month, count(*) AS n
                   FROM ad_leads GROUP BY ALL) b
  ON a.studio_id = b.studio_id AND a.month = b.month)""")
def r02(ctx):
    """CRM vs ad-sheet lead counts per studio and month."""
    return R.reconcile_ad_leads(ctx.leads, ctx.ad_leads)


@query("r03_sales", f"""SELECT coalesce(a.studio_id, b.studio_id) AS studio_id, coalesce(a.month, b.month) AS month,
  coalesce(a.visits, 0) AS visits_a, coalesce(b.visits, 0) AS visits_b,
  {_mpct('coalesce(a.visits, 0)', 'coalesce(b.visits, 0)')} AS visits_pct,
  coalesce(a.sales, 0) AS sales_a, coalesce(b.sales, 0) AS sales_b,
  {_mpct('coalesce(a.sales, 0)', 'coalesce(b.sales, 0)')} AS sales_pct
FROM (SELECT studio_id, CAST(date_trunc('month', visit_ts) AS DATE) AS month, count(*) AS visits,
        CAST(sum(amount) AS DOUBLE) AS sales FROM bookings WHERE status = 'visited' GROUP BY ALL) a
FULL OUTER JOIN (SELECT studio_id, CAST(date_trunc('month', closed_at) AS DATE) AS month, count(*) AS visits,
        CAST(sum(price) AS DOUBLE) AS sales FROM leads
        WHERE status_id IN (142, 84237074) AND closed_at IS NOT NULL GROUP BY ALL) b
ON a.studio_id = b.studio_id AND a.month = b.month""")
def r03(ctx):
    """Visits and sales: bookings vs closed-won deals per studio and month."""
    return R.reconcile_sales(ctx.bookings, ctx.leads)


@query("r05_advanced_without_booking", """SELECT studio_id, lead_id, status_id, phone FROM leads l
WHERE status_id IN (74087590, 74087594, 142)
  AND NOT (phone_valid AND EXISTS (SELECT 1 FROM bookings b WHERE b.phone_valid
           AND b.studio_id = l.studio_id AND b.phone = l.phone))""")
def r05(ctx):
    return R.advanced_without_booking(ctx.leads, ctx.bookings).select("studio_id", "lead_id", "status_id", "phone")


@query("r06_booking_without_lead", """SELECT studio_id, booking_id, phone FROM bookings b
WHERE NOT (b.phone_valid AND EXISTS (SELECT 1 FROM leads l WHERE l.phone_valid AND l.phone = b.phone))""")
def r06(ctx):
    b = ctx.bookings
    valid = R.booking_without_lead(b.filter("phone_valid"), ctx.leads)
    return valid.unionByName(b.filter(~F.col("phone_valid"))).select("studio_id", "booking_id", "phone")


@query("r07_studio_mismatch", """SELECT l.studio_id, l.lead_id, l.derived_studio, b.booking_studio FROM (
  SELECT studio_id, lead_id, phone,
    coalesce(CASE WHEN status_id IN (74087582, 74087586) THEN 'studio_a'
                  WHEN status_id IN (84866066, 84866070) THEN 'studio_b' END,
             CASE responsible_id WHEN 12112418 THEN 'studio_a' WHEN 12112458 THEN 'studio_b' END,
             CASE WHEN lower(client_name) LIKE '%люблино%' THEN 'studio_b'
                  WHEN lower(client_name) LIKE '%рязанский%' THEN 'studio_a' END) AS derived_studio
  FROM leads WHERE phone_valid) l
JOIN (SELECT DISTINCT phone, studio_id AS booking_studio FROM bookings WHERE phone_valid) b ON b.phone = l.phone
WHERE l.derived_studio IS NOT NULL AND b.booking_studio <> l.derived_studio""")
def r07(ctx):
    """Booking studio differs from the studio derived for the lead."""
    return R.studio_mismatch(N.detect_studio(ctx.leads), ctx.bookings)


@query("r08_attendance_mismatch", """SELECT studio_id, lead_id, status_id, booking_status FROM leads_booked
WHERE coalesce((booking_status = 'no_show' AND status_id <> 74087594)
            OR (booking_status = 'visited' AND status_id NOT IN (142, 84237074)), false)""")
def r08(ctx):
    return R.attendance_mismatch(ctx.leads_booked).select("studio_id", "lead_id", "status_id", "booking_status")


GRID_SQL = """SELECT studio_id, lead_date, channel,
    count(*) FILTER (WHERE a AND b) AS in_both, count(*) FILTER (WHERE a AND NOT b) AS crm_only,
    count(*) FILTER (WHERE NOT a AND b) AS sheet_only
  FROM (SELECT coalesce(x.studio_id, y.studio_id) AS studio_id,
          coalesce(CAST(x.created_at AS DATE), CAST(y.created_at AS DATE)) AS lead_date,
          coalesce(x.utm_source, y.channel) AS channel, x.lead_id IS NOT NULL AS a, y.ad_lead_id IS NOT NULL AS b
        FROM leads x FULL OUTER JOIN ad_leads y ON x.studio_id = y.studio_id AND x.lead_id = y.ad_lead_id)
  GROUP BY ALL"""


@query("r09_reconcile_grid", GRID_SQL)
def r09(ctx):
    return R.reconcile_grid(ctx.leads, ctx.ad_leads)


@query("r09_presence_grid", """SELECT studio_id, lead_date, channel,
  CASE WHEN a AND b AND c THEN 'all three' WHEN a AND b THEN 'crm+booking' WHEN a AND c THEN 'crm+sheet'
    WHEN b AND c THEN 'booking+sheet' WHEN a THEN 'crm' WHEN b THEN 'booking' ELSE 'sheet' END AS presence,
  count(*) AS leads, count(*) FILTER (WHERE a AND c AND d1 IS DISTINCT FROM d4) AS date_differs,
  count(*) FILTER (WHERE a AND c AND c1 IS DISTINCT FROM c4) AS channel_differs
FROM (SELECT coalesce(x.studio_id, y.studio_id) AS studio_id,
    coalesce(CAST(x.created_at AS DATE), CAST(y.created_at AS DATE)) AS lead_date,
    coalesce(x.utm_source, y.channel) AS channel, x.lead_id IS NOT NULL AS a, x.yc_booking_id IS NOT NULL AS b,
    y.ad_lead_id IS NOT NULL AS c, CAST(x.created_at AS DATE) AS d1, CAST(y.created_at AS DATE) AS d4,
    x.utm_source AS c1, y.channel AS c4
  FROM leads_booked x FULL OUTER JOIN ad_leads y ON x.studio_id = y.studio_id AND x.lead_id = y.ad_lead_id
  UNION ALL
  SELECT studio_id, CAST(visit_ts AS DATE), NULL, false, true, false, NULL, NULL, NULL, NULL FROM bookings k
  WHERE NOT EXISTS (SELECT 1 FROM leads_booked l WHERE l.yc_booking_id = k.booking_id))
GROUP BY ALL""")
def r09_presence(ctx):
    """Leads by studio, date, channel and which of CRM, bookings and sheet have them."""
    return R.presence_grid(ctx.leads_booked, ctx.bookings, ctx.ad_leads)


@query("r10_reconcile_totals", f"""SELECT *, {SEV.format(p='mismatch_pct')} FROM (
  SELECT CASE WHEN grouping(studio_id) = 1 THEN 'all' ELSE studio_id END AS studio_id,
    CAST(sum(in_both) AS BIGINT) AS in_both, CAST(sum(crm_only) AS BIGINT) AS crm_only,
    CAST(sum(sheet_only) AS BIGINT) AS sheet_only,
    round(100.0 * (CAST(sum(crm_only) + sum(sheet_only) AS DOUBLE)
      / NULLIF(sum(in_both) + sum(crm_only) + sum(sheet_only), 0)), 2) AS mismatch_pct
  FROM grid GROUP BY GROUPING SETS ((studio_id), ()))""", views=[("grid", GRID_SQL)])
def r10(ctx):
    """Grid totals per studio and across studios."""
    return R.reconcile_totals(R.reconcile_grid(ctx.leads, ctx.ad_leads))
