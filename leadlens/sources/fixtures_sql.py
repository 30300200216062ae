"""The fixture views as ANSI SQL common table expressions (DuckDB dialect).

They are the oracle twin of ``fixtures.py``: each registered query's oracle
text is ``with_views(body)``, which prepends only the views the body names.
"""

from __future__ import annotations

import re

PHONE = """CASE
      WHEN {k} % 25 = 4 THEN '0000000000'
      WHEN {k} % 5 = 0 THEN '+7 (' || substr(CAST(9000000000 + {k} AS VARCHAR), 1, 3) || ') '
           || substr(CAST(9000000000 + {k} AS VARCHAR), 4, 3) || '-'
           || substr(CAST(9000000000 + {k} AS VARCHAR), 7, 2) || '-'
           || substr(CAST(9000000000 + {k} AS VARCHAR), 9, 2)
      WHEN {k} % 5 = 1 THEN '8' || CAST(9000000000 + {k} AS VARCHAR)
      WHEN {k} % 5 = 2 THEN CAST(9000000000 + {k} AS VARCHAR)
      WHEN {k} % 5 = 3 THEN '7' || CAST(9000000000 + {k} AS VARCHAR)
      ELSE '+7' || CAST(9000000000 + {k} AS VARCHAR) END"""

NORM_PHONE = """CASE WHEN length(regexp_replace({p}, '[^0-9]', '', 'g')) = 0 THEN NULL
      WHEN length(regexp_replace({p}, '[^0-9]', '', 'g')) = 11 AND regexp_replace({p}, '[^0-9]', '', 'g') LIKE '8%'
        THEN '7' || substr(regexp_replace({p}, '[^0-9]', '', 'g'), 2, 10)
      WHEN length(regexp_replace({p}, '[^0-9]', '', 'g')) = 10 THEN '7' || regexp_replace({p}, '[^0-9]', '', 'g')
      ELSE regexp_replace({p}, '[^0-9]', '', 'g') END"""

PHONE_VALID = """coalesce(length(regexp_replace({p}, '[^0-9]', '', 'g')) >= 10
      AND replace(regexp_replace({p}, '[^0-9]', '', 'g'), substr(regexp_replace({p}, '[^0-9]', '', 'g'), 1, 1), '') <> '', false)"""

VIEWS: dict[str, tuple[list[str], str]] = {}


def _view(name: str, deps: list[str], sql: str) -> None:
    VIEWS[name] = (deps, sql)


_view("cust_studio", [], """
  SELECT c_custkey, c_name, c_mktsegment, 'studio_' || CAST(n_regionkey AS VARCHAR) AS studio_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")

_view("lead_base", ["cust_studio"], f"""
  SELECT o_orderkey AS lead_id, studio_id,
    CAST(CASE o_orderkey % 14 WHEN 0 THEN 74087434 WHEN 1 THEN 74087430 WHEN 2 THEN 74087586
      WHEN 3 THEN 84866070 WHEN 4 THEN 74087582 WHEN 5 THEN 84866066 WHEN 6 THEN 74087590
      WHEN 7 THEN 74087594 WHEN 8 THEN 74087598 WHEN 9 THEN 84237074 WHEN 10 THEN 142
      WHEN 11 THEN 83303646 WHEN 12 THEN 84237070 ELSE 143 END AS BIGINT) AS status_id,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'yandex' WHEN 'BUILDING' THEN 'vk'
      WHEN 'FURNITURE' THEN 'site' WHEN 'HOUSEHOLD' THEN 'google' END AS utm_source,
    CAST(o_orderdate AS TIMESTAMP) AS created_at,
    CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_custkey % 10 AS INTEGER)) AS updated_at,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS TIMESTAMP) + to_days(CAST(o_custkey % 10 AS INTEGER)) END AS closed_at,
    CAST(o_totalprice AS DECIMAL(18,2)) AS price,
    c_name AS client_name,
    {PHONE.format(k='o_custkey')} AS client_phone,
    CASE WHEN o_custkey % 3 = 0 THEN 12112418 WHEN o_custkey % 3 = 1 THEN 12112458 END AS responsible_id,
    o_orderpriority AS priority
  FROM orders JOIN cust_studio ON o_custkey = c_custkey""")

_view("crm_leads", ["lead_base"], """
  SELECT lead_id, studio_id, status_id, utm_source, created_at, updated_at, closed_at, price,
         client_name, client_phone, responsible_id, 'amo' AS source
  FROM lead_base""")

_view("raw_bookings", ["cust_studio"], f"""
  SELECT l_orderkey * 10 + l_linenumber AS booking_id, studio_id, o_custkey AS client_ref,
    c_name AS client_name, {PHONE.format(k='o_custkey')} AS client_phone,
    l_partkey AS service_id, l_suppkey AS master_id, CAST(l_shipdate AS TIMESTAMP) AS visit_ts,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_quantity AS quantity,
    CASE WHEN l_returnflag = 'A' THEN 'visited'
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'not_visited'
         WHEN l_returnflag = 'R' THEN 'canceled'
         WHEN l_linestatus = 'F' THEN 'confirmed' ELSE 'waiting' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN cust_studio ON o_custkey = c_custkey""")

# bookings deduplicated: latest visit_ts, then amount, then every other column
_view("bookings_d", ["raw_bookings"], """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY booking_id ORDER BY visit_ts DESC NULLS LAST,
      amount DESC NULLS LAST, studio_id DESC NULLS LAST, client_ref DESC NULLS LAST,
      client_name DESC NULLS LAST, client_phone DESC NULLS LAST, service_id DESC NULLS LAST,
      master_id DESC NULLS LAST, quantity DESC NULLS LAST, status DESC NULLS LAST) AS rn
    FROM raw_bookings) WHERE rn = 1""")

_view("bookings", ["bookings_d"], f"""
  SELECT *, {NORM_PHONE.format(p='client_phone')} AS phone,
    {PHONE_VALID.format(p='client_phone')} AS phone_valid,
    CASE status WHEN 'visited' THEN 'completed' WHEN 'no_show' THEN 'no_show'
      WHEN 'canceled' THEN 'canceled' END AS booking_stage,
    CAST(visit_ts AS DATE) AS visit_date
  FROM (SELECT * REPLACE (CASE status WHEN 'not_visited' THEN 'no_show' ELSE status END AS status)
        FROM bookings_d)""")

_view("leads", ["crm_leads"], f"""
  SELECT *, {NORM_PHONE.format(p='client_phone')} AS phone,
    {PHONE_VALID.format(p='client_phone')} AS phone_valid,
    CASE WHEN {PHONE_VALID.format(p='client_phone')}
      THEN md5(studio_id || ':' || {NORM_PHONE.format(p='client_phone')}) END AS client_id,
    CAST(created_at AS DATE) AS lead_date
  FROM crm_leads""")

# N-12 brute force: earliest booking at or after created_at, tie by booking id
_view("leads_booked", ["leads", "bookings"], """
  SELECT l.*, m.booking_id AS yc_booking_id, m.visit_ts AS booking_ts, m.status AS booking_status,
         m.amount AS booking_amount
  FROM leads l LEFT JOIN (
    SELECT lead_id, studio_id, booking_id, visit_ts, status, amount FROM (
      SELECT l2.lead_id, l2.studio_id, b.booking_id, b.visit_ts, b.status, b.amount,
        row_number() OVER (PARTITION BY l2.studio_id, l2.lead_id ORDER BY b.visit_ts, b.booking_id) AS rn
      FROM leads l2 JOIN bookings b
        ON b.studio_id = l2.studio_id AND b.phone = l2.phone AND b.visit_ts >= l2.created_at
      WHERE l2.phone_valid AND b.phone_valid) WHERE rn = 1) m
  ON m.studio_id = l.studio_id AND m.lead_id = l.lead_id""")

_view("ad_leads", ["lead_base"], f"""
  SELECT lead_id AS ad_lead_id, studio_id, utm_source, priority AS utm_campaign, client_name,
    client_phone, created_at, {NORM_PHONE.format(p='client_phone')} AS phone,
    {PHONE_VALID.format(p='client_phone')} AS phone_valid,
    CASE WHEN length(lower(trim(utm_source))) > 0 THEN lower(trim(utm_source)) END AS channel
  FROM lead_base WHERE lead_id % 10 <> 3""")

_view("leads_enriched", ["leads", "ad_leads"], """
  SELECT l.*, a.channel AS ad_source, a.utm_campaign AS ad_campaign,
    coalesce(CASE WHEN length(lower(trim(l.utm_source))) > 0 THEN lower(trim(l.utm_source)) END, a.channel) AS utm_enriched,
    coalesce(CASE WHEN length(lower(trim(l.utm_source))) > 0 THEN lower(trim(l.utm_source)) END, a.channel) IS NULL
      AS ad_channel_unknown,
    a.phone IS NOT NULL AS from_ads
  FROM leads l LEFT JOIN (
    SELECT * FROM (SELECT studio_id, phone, channel, utm_campaign,
      row_number() OVER (PARTITION BY studio_id, phone ORDER BY created_at DESC, ad_lead_id DESC) AS rn
      FROM ad_leads WHERE phone_valid) WHERE rn = 1) a
  ON a.studio_id = l.studio_id AND a.phone = l.phone""")

_view("ad_spend", ["lead_base"], """
  SELECT lead_id AS spend_id, studio_id, CAST(created_at AS DATE) AS expense_date,
    utm_source AS channel, CAST(500 + lead_id % 1000 AS DECIMAL(18,2)) AS amount
  FROM lead_base""")

_view("lead_states", [], """
  SELECT user_id AS lead_id, 'studio_' || CAST(user_id % 5 AS VARCHAR) AS studio_id, 'amo' AS source,
    CASE event_type WHEN 'signup' THEN 'new' WHEN 'view' THEN 'contacted'
      WHEN 'click' THEN 'negotiation' WHEN 'purchase' THEN 'abonement_sold'
      WHEN 'error' THEN 'no_show' END AS stage,
    CAST(ts AS TIMESTAMP) AS event_ts, event_id AS obs_id
  FROM events""")

# E-01/E-02: created + status_changed, repeats of one stage collapsed
_view("lead_events", ["lead_states"], """
  SELECT studio_id, source, lead_id, obs_id AS event_id,
    CASE WHEN prev_stage IS NULL THEN 'created' ELSE 'status_changed' END AS event_type,
    prev_stage AS stage_from, stage AS stage_to, event_ts, prev_ts
  FROM (
    SELECT *, lag(stage) OVER w AS prev_stage, lag(event_ts) OVER w AS prev_ts,
      row_number() OVER w AS rn
    FROM lead_states
    WINDOW w AS (PARTITION BY studio_id, source, lead_id ORDER BY event_ts, obs_id))
  WHERE rn = 1 OR stage IS DISTINCT FROM prev_stage""")

_view("ev", ["lead_events"], """
  SELECT *, lag(event_ts) OVER (PARTITION BY studio_id, source, lead_id ORDER BY event_ts, event_id) AS prev_event_ts
  FROM lead_events""")

# E-04: SCD2 snapshots [valid_from, valid_to)
_view("lead_snapshots", ["lead_events"], """
  SELECT studio_id, source, lead_id, event_id AS snapshot_id, stage_to AS stage,
    event_ts AS valid_from,
    lead(event_ts) OVER (PARTITION BY studio_id, source, lead_id ORDER BY event_ts, event_id) AS valid_to
  FROM lead_events""")

_view("studios", [], """
  SELECT 'studio_' || CAST(r_regionkey AS VARCHAR) AS studio_id, r_name AS studio_name,
    CASE r_regionkey WHEN 0 THEN 'Africa/Cairo' WHEN 1 THEN 'America/New_York' WHEN 2 THEN 'Asia/Tokyo'
      WHEN 3 THEN 'Europe/Moscow' WHEN 4 THEN 'Asia/Dubai' END AS timezone,
    r_regionkey <> 4 AS is_active
  FROM region""")

_view("funnel_stages", [], """
  SELECT * FROM (VALUES (1, 'new_lead', 'new', 74087434), (1, 'new_lead', 'new', 74087430),
    (2, 'negotiation', 'active', 74087586), (2, 'negotiation', 'active', 84866070),
    (3, 'no_answer', 'active', 74087582), (3, 'no_answer', 'active', 84866066),
    (4, 'visit_scheduled', 'active', 74087590), (5, 'no_show', 'visited', 74087594),
    (6, 'first_visit_complete', 'visited', NULL), (7, 'not_purchased', 'visited', 74087598),
    (8, 'deposit_paid', 'closed_won', 84237074), (9, 'success', 'closed_won', 142),
    (10, 'no_renewal', 'closed_lost', 83303646), (11, 'renewed', 'closed_won', 84237070),
    (12, 'closed_not_realized', 'closed_lost', 143)) t(stage_order, stage_code, stage_group, status_id)""")

_view("records", ["leads", "bookings", "ad_leads"], """
  SELECT studio_id, phone, 'amo' AS source, created_at AS ts, 0 AS visit,
    CAST(NULL AS DECIMAL(18,2)) AS revenue, CAST(lead_id AS VARCHAR) AS rec_id FROM leads WHERE phone_valid
  UNION ALL
  SELECT studio_id, phone, 'yclients', visit_ts, CASE WHEN status = 'visited' THEN 1 ELSE 0 END,
    CASE WHEN status = 'visited' THEN amount END, CAST(booking_id AS VARCHAR) FROM bookings WHERE phone_valid
  UNION ALL
  SELECT studio_id, phone, 'gsheets', created_at, 0, NULL, CAST(ad_lead_id AS VARCHAR) FROM ad_leads
  WHERE phone_valid""")

_view("event_stages", [], """
  SELECT * FROM (VALUES ('new', 'New lead', 'new', 0), ('contacted', 'Contact made', 'active', 1),
    ('negotiation', 'Negotiation', 'active', 2), ('booking_made', 'Booking made', 'active', 3),
    ('visited', 'Visited', 'visited', 4), ('abonement_sold', 'Subscription sold', 'closed_won', 5),
    ('no_show', 'No-show', 'closed_lost', 99), ('canceled', 'Canceled', 'closed_lost', 99),
    ('lost', 'Lost', 'closed_lost', 99)) t(stage_code, stage_name, stage_group, stage_order)""")


def _needed(body: str) -> list[str]:
    order: list[str] = []

    def visit(name: str) -> None:
        for d in VIEWS[name][0]:
            visit(d)
        if name not in order:
            order.append(name)

    for name in VIEWS:
        if re.search(rf"\b{name}\b", body):
            visit(name)
    return order


def with_views(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the fixture views (and ``extra`` CTEs) it refers to."""
    extra = extra or []
    text = body + " ".join(sql for _, sql in extra)
    names = _needed(text)
    ctes = [f"{n} AS ({VIEWS[n][1]})" for n in names] + [f"{n} AS ({sql})" for n, sql in extra]
    return ("WITH " + ",\n".join(ctes) + "\n" + body) if ctes else body
