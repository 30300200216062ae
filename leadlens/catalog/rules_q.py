"""Stage validation rule queries (V-*)."""

from __future__ import annotations

from leadlens import config as C
from leadlens.plans import normalize as N
from leadlens.plans import rules as V
from leadlens.registry import query
from leadlens.sources.fixtures import AS_OF_STAR

TH = C.DEFAULT_THRESHOLDS
A = f"TIMESTAMP '{AS_OF_STAR}'"
CV_SQL = """SELECT studio_id, phone, count(*) AS visits, sum(amount) AS revenue FROM bookings
  WHERE status = 'visited' AND phone_valid GROUP BY ALL"""


def V_(entity: str, rule: str, sev: str, detail: str) -> str:
    return (f"studio_id, CAST({entity} AS VARCHAR) AS entity_id, '{rule}' AS rule_id, '{sev}' AS severity, "
            f"CAST({detail} AS VARCHAR) AS detail")


@query("v01_new_lead", f"""SELECT {V_('lead_id', 'V01', 'INFO', "'not_from_ads'")} FROM leads_enriched
  WHERE status_id IN (74087434, 74087430) AND NOT from_ads
UNION ALL SELECT {V_('lead_id', 'A13', 'INFO', 'client_phone')} FROM leads_enriched
  WHERE status_id IN (74087434, 74087430) AND NOT phone_valid
UNION ALL SELECT {V_('lead_id', 'A14', 'INFO', "'unknown_channel'")} FROM leads_enriched
  WHERE status_id IN (74087434, 74087430) AND ad_channel_unknown""")
def v01(ctx):
    """New leads: not from ads, invalid phone (A13), unknown channel (A14)."""
    return V.check_new_lead(N.enrich_utm(ctx.leads, ctx.ad_leads))


@query("v02_new_lead_sla", f"""SELECT {V_('lead_id', 'V02', 'WARNING', f"date_sub('hour', updated_at, {A})")} FROM leads
  WHERE status_id IN (74087434, 74087430) AND date_sub('microsecond', updated_at, {A}) > {TH['new_lead_sla_hours']} * 3600000000
UNION ALL SELECT {V_('lead_id', 'V02_unassigned', 'WARNING', "'no_manager'")} FROM leads
  WHERE status_id IN (74087434, 74087430) AND responsible_id IS NULL""")
def v02(ctx):
    return V.check_new_lead_sla(ctx.leads, AS_OF_STAR, TH["new_lead_sla_hours"])


@query("v03_negotiation", f"""SELECT {V_('lead_id', 'A05', 'WARNING', f"date_diff('day', created_at, {A})")} FROM leads
  WHERE status_id IN (74087586, 84866070) AND closed_at IS NULL
    AND date_diff('day', created_at, {A}) > {TH['negotiation_days']}""")
def v03(ctx):
    return V.check_negotiation(ctx.leads, AS_OF_STAR, TH["negotiation_days"])


@query("v04_no_answer", f"""SELECT {V_('lead_id', 'A06', 'WARNING', f"date_diff('day', updated_at, {A})")} FROM leads
  WHERE status_id IN (74087582, 84866066) AND closed_at IS NULL
    AND date_diff('day', updated_at, {A}) > {TH['no_answer_days']}""")
def v04(ctx):
    return V.check_no_answer(ctx.leads, AS_OF_STAR, TH["no_answer_days"])


@query("v05_appointment", f"""SELECT {V_('lead_id', 'A07', 'WARNING', "'no_future_booking'")} FROM leads l
  WHERE status_id = 74087590 AND NOT EXISTS (SELECT 1 FROM bookings b WHERE b.phone_valid
    AND b.status IN ('confirmed', 'waiting') AND b.visit_ts > {A} AND b.studio_id = l.studio_id AND b.phone = l.phone)""")
def v05(ctx):
    return V.check_appointment(ctx.leads, ctx.bookings, AS_OF_STAR)


@query("v06_no_show_visited", f"""SELECT {V_('lead_id', 'A08', 'WARNING', "'visited_in_bookings'")} FROM leads l
  WHERE status_id = 74087594 AND phone_valid AND EXISTS (SELECT 1 FROM bookings b WHERE b.phone_valid
    AND b.status = 'visited' AND b.studio_id = l.studio_id AND b.phone = l.phone)""")
def v06(ctx):
    return V.check_no_show(ctx.leads, ctx.bookings)


@query("v07_first_visit_upsell", f"""SELECT {V_('booking_id', 'V07', 'INFO', 'phone')} FROM (
  SELECT *, row_number() OVER (PARTITION BY studio_id, phone ORDER BY visit_ts, booking_id) AS rn
  FROM bookings WHERE status = 'visited' AND phone_valid) WHERE rn = 1""")
def v07(ctx):
    return V.check_first_visit(N.visit_flags(ctx.bookings))


@query("v08_not_purchased", f"""SELECT {V_('l.lead_id', 'A09', 'INFO', 'cv.visits')} FROM leads l
  JOIN cv ON cv.studio_id = l.studio_id AND cv.phone = l.phone
  WHERE l.status_id = 74087598 AND cv.visits > 0""".replace("studio_id, CAST", "l.studio_id, CAST"),
       views=[("cv", CV_SQL)])
def v08(ctx):
    return V.check_not_purchased(ctx.leads, ctx.bookings)


@query("v09_deposit", f"""SELECT {V_('l.lead_id', 'A11', 'WARNING', 'coalesce(cv.revenue, 0) - l.price')} FROM leads l
  LEFT JOIN cv ON cv.studio_id = l.studio_id AND cv.phone = l.phone
  WHERE l.status_id = 84237074 AND (cv.revenue IS NULL OR cv.revenue < l.price)""".replace(
    "studio_id, CAST", "l.studio_id, CAST"), views=[("cv", CV_SQL)])
def v09(ctx):
    return V.check_deposit(ctx.leads, ctx.bookings)


@query("v10_success_revenue", f"""SELECT {V_('l.lead_id', 'A10', 'WARNING', 'coalesce(cv.revenue, 0) - l.price')} FROM leads l
  LEFT JOIN cv ON cv.studio_id = l.studio_id AND cv.phone = l.phone
  WHERE l.status_id = 142 AND coalesce(cv.revenue, 0) < l.price""".replace(
    "studio_id, CAST", "l.studio_id, CAST"), views=[("cv", CV_SQL)])
def v10(ctx):
    return V.check_success(ctx.leads, ctx.bookings)


@query("v11_not_renewed", f"""SELECT {V_('l.lead_id', 'V11', 'INFO', f"date_diff('day', lv.last_visit, DATE '{AS_OF_STAR}')")}
FROM leads l JOIN (SELECT studio_id, phone, max(visit_date) AS last_visit FROM bookings
    WHERE phone_valid AND status = 'visited' AND visit_date <= DATE '{AS_OF_STAR}' GROUP BY ALL) lv
  ON lv.studio_id = l.studio_id AND lv.phone = l.phone
WHERE l.status_id = 83303646 AND date_diff('day', lv.last_visit, DATE '{AS_OF_STAR}') > {TH['lapsed_days']}""".replace(
    "studio_id, CAST", "l.studio_id, CAST", 1))
def v11(ctx):
    return V.check_not_renewed(ctx.leads, ctx.bookings, AS_OF_STAR, TH["lapsed_days"])


@query("v12_regular_visits", f"""SELECT {V_('l.lead_id', 'V12', 'INFO', 'cv.visits')} FROM leads l
  JOIN cv ON cv.studio_id = l.studio_id AND cv.phone = l.phone
  WHERE l.status_id IN (74087434, 74087430, 74087586, 84866070, 74087582, 84866066, 74087590)
    AND cv.visits >= 2""".replace("studio_id, CAST", "l.studio_id, CAST"), views=[("cv", CV_SQL)])
def v12(ctx):
    return V.check_regular_visits(ctx.leads, ctx.bookings)


@query("v13_closure_rate", f"""SELECT studio_id, studio_id AS entity_id, 'A12' AS rule_id, 'WARNING' AS severity,
  CAST(rate AS VARCHAR) || ':' || CAST(lost_no_booking AS VARCHAR) AS detail
FROM (SELECT studio_id, round(100.0 * (CAST(count(*) FILTER (WHERE status_id = 143) AS DOUBLE) / count(*)), 2) AS rate,
        count(*) FILTER (WHERE status_id = 143 AND yc_booking_id IS NULL) AS lost_no_booking
      FROM leads_booked GROUP BY studio_id)
WHERE rate > {TH['closure_rate_max']}""")
def v13(ctx):
    return V.check_closure_rate(ctx.leads_booked, TH["closure_rate_max"])


ENGINE_SQL = f"""
SELECT l.studio_id, CAST(l.lead_id AS VARCHAR) AS entity_id, 'R1' AS rule_id, 'WARNING' AS severity, 'missing' AS detail
FROM leads_booked l WHERE l.status_id = 74087590 AND NOT EXISTS (SELECT 1 FROM bookings b WHERE b.phone_valid
  AND b.studio_id = l.studio_id AND b.phone = l.phone AND b.status IN ('confirmed', 'waiting'))
UNION ALL
SELECT studio_id, CAST(lead_id AS VARCHAR), 'R2', 'WARNING', booking_status FROM leads_booked
WHERE status_id = 74087594 AND booking_status IS NOT NULL AND booking_status NOT IN ('no_show', 'canceled')
UNION ALL
SELECT l.studio_id, CAST(l.lead_id AS VARCHAR), 'R3', 'WARNING', CAST(coalesce(cv.revenue, 0) - l.price AS VARCHAR)
FROM leads_booked l LEFT JOIN cv ON cv.studio_id = l.studio_id AND cv.phone = l.phone
WHERE l.status_id = 142 AND coalesce(cv.revenue, 0) < l.price
UNION ALL
SELECT l.studio_id, CAST(l.lead_id AS VARCHAR), 'R4', 'INFO', CAST(coalesce(cv.visits, 0) AS VARCHAR)
FROM leads_booked l LEFT JOIN cv ON cv.studio_id = l.studio_id AND cv.phone = l.phone
WHERE l.status_id = 74087598 AND coalesce(cv.visits, 0) >= 1
UNION ALL
SELECT studio_id, CAST(lead_id AS VARCHAR), 'R5', 'WARNING', CAST(date_diff('day', created_at, {A}) AS VARCHAR)
FROM leads_booked WHERE status_id IN (74087586, 84866070) AND closed_at IS NULL
  AND date_diff('day', created_at, {A}) > 7"""


@query("v14_rule_engine", ENGINE_SQL, views=[("cv", CV_SQL)])
def v14(ctx):
    """Rule-table engine: five check types with JSON criteria."""
    return V.run_rules(ctx.leads_booked, ctx.bookings, V.rules_table(ctx.spark), AS_OF_STAR)


TEMPLATES = {r[0]: r[5] for r in V.DEFAULT_RULES}


@query("v15_rule_alerts", "SELECT studio_id, entity_id, rule_id, severity, "
       "replace(replace(CASE rule_id " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TEMPLATES.items())
       + " END, '{entity}', entity_id), '{detail}', coalesce(detail, '')) AS message FROM eng",
       views=[("cv", CV_SQL), ("eng", ENGINE_SQL)])
def v15(ctx):
    """Failed rules as alert rows with their template text."""
    rules = V.rules_table(ctx.spark)
    return V.rule_alerts(V.run_rules(ctx.leads_booked, ctx.bookings, rules, AS_OF_STAR), rules)


@query("v04_attempts", """SELECT studio_id, CAST(lead_id AS VARCHAR) AS entity_id, 'A06' AS rule_id, 'WARNING' AS severity,
  CASE WHEN attempts >= 3 THEN 'close:' || CAST(attempts AS VARCHAR) ELSE CAST(attempts AS VARCHAR) END AS detail
FROM (SELECT studio_id, source, lead_id, count(*) AS attempts FROM lead_events WHERE stage_to = 'negotiation'
      GROUP BY ALL) WHERE attempts >= 2""")
def v04b(ctx):
    """Entries into a stage counted per lead from the events: 2 -> warn, 3 -> close."""
    return V.check_attempts(ctx.lead_events, "negotiation", 2, 3)
