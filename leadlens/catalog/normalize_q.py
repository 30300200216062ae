"""Normalisation (N-*) and identity (I-*) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadlens.functions import business_date, channel_type
from leadlens.plans import identity as I
from leadlens.plans import normalize as N
from leadlens.registry import query
from leadlens.sources import fixtures as fx

STATUS_CODE_SQL = """CASE WHEN status_id IN (74087434, 74087430) THEN 'NEW'
  WHEN status_id IN (74087586, 84866070, 74087582, 84866066) THEN 'IN_WORK'
  WHEN status_id IN (74087590, 74087594) THEN 'APPOINTMENT'
  WHEN status_id IN (74087598, 84237074, 142, 84237070) THEN 'COMPLETED'
  WHEN status_id IN (143, 83303646) THEN 'REFUSAL' ELSE CAST(status_id AS VARCHAR) END"""

CUTOFF = "1996-01-01"


@query("n01_phone_normalize", """SELECT studio_id, phone, phone_valid, count(*) AS leads
FROM leads GROUP BY ALL""")
def n01(ctx):
    """Normalised phone per lead, grouped."""
    return ctx.leads.groupBy("studio_id", "phone", "phone_valid").agg(F.count(F.lit(1)).alias("leads"))


@query("n02_phone_valid", """SELECT studio_id, count(*) AS leads,
  count(*) FILTER (WHERE NOT phone_valid) AS invalid_phones FROM leads GROUP BY studio_id""")
def n02(ctx):
    return ctx.leads.groupBy("studio_id").agg(F.count(F.lit(1)).alias("leads"),
                                              F.count_if(~F.col("phone_valid")).alias("invalid_phones"))


@query("n03_status_codes", f"""SELECT studio_id, {STATUS_CODE_SQL} AS status_code, count(*) AS leads
FROM leads GROUP BY ALL""")
def n03(ctx):
    return ctx.leads.groupBy("studio_id", "status_code").agg(F.count(F.lit(1)).alias("leads"))


@query("n04_map_stage", """SELECT l.studio_id, coalesce(s.stage_code, 'unknown') AS stage_code, s.stage_order,
  s.stage_group, count(*) AS leads
FROM leads l LEFT JOIN funnel_stages s ON s.status_id = l.status_id GROUP BY ALL""")
def n04(ctx):
    m = N.map_stage(ctx.leads, N.stage_dim(ctx.spark))
    return m.groupBy("studio_id", "stage_code", "stage_order", "stage_group").agg(F.count(F.lit(1)).alias("leads"))


@query("n05_booking_stage", """SELECT studio_id, status, booking_stage, count(*) AS bookings
FROM bookings GROUP BY ALL""")
def n05(ctx):
    return ctx.bookings.groupBy("studio_id", "status", "booking_stage").agg(F.count(F.lit(1)).alias("bookings"))


@query("n07_channels", """SELECT studio_id, channel,
  CASE WHEN channel IN ('yandex', 'google') THEN 'paid'
       WHEN channel IN ('vk', 'instagram', 'telegram') THEN 'social'
       WHEN channel = 'site' THEN 'organic' WHEN channel = 'referral' THEN 'referral'
       ELSE 'other' END AS channel_type,
  count(*) AS ad_leads
FROM ad_leads GROUP BY ALL""")
def n07(ctx):
    a = ctx.ad_leads.withColumn("channel_type", channel_type("channel"))
    return a.groupBy("studio_id", "channel", "channel_type").agg(F.count(F.lit(1)).alias("ad_leads"))


@query("n08_utm_from_url", """SELECT page_id,
  nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS utm_source,
  nullif(regexp_extract(url, '[?&]utm_medium=([^&#]*)', 1), '') AS utm_medium,
  nullif(regexp_extract(url, '[?&]utm_campaign=([^&#]*)', 1), '') AS utm_campaign
FROM pages""")
def n08(ctx):
    """UTM fields parsed out of landing-page URLs."""
    p = ctx.t.pages.select("page_id", "url")
    return p.select("page_id", *[F.parse_url(F.col("url"), F.lit("QUERY"), F.lit(k)).alias(k)
                                 for k in ("utm_source", "utm_medium", "utm_campaign")])


@query("n09_detect_studio", """SELECT studio_id,
  coalesce(CASE WHEN status_id IN (74087582, 74087586) THEN 'studio_a'
                WHEN status_id IN (84866066, 84866070) THEN 'studio_b' END,
           CASE responsible_id WHEN 12112418 THEN 'studio_a' WHEN 12112458 THEN 'studio_b' END,
           CASE WHEN lower(client_name) LIKE '%люблино%' THEN 'studio_b'
                WHEN lower(client_name) LIKE '%рязанский%' THEN 'studio_a' END) AS derived_studio,
  CASE WHEN status_id IN (74087582, 74087586, 84866066, 84866070) THEN 'status'
       WHEN responsible_id IN (12112418, 12112458) THEN 'user'
       WHEN lower(client_name) LIKE '%люблино%' OR lower(client_name) LIKE '%рязанский%' THEN 'name'
  END AS studio_source,
  count(*) AS leads
FROM leads GROUP BY ALL""")
def n09(ctx):
    d = N.detect_studio(ctx.leads)
    return d.groupBy("studio_id", "derived_studio", "studio_source").agg(F.count(F.lit(1)).alias("leads"))


@query("n10_dedupe_bookings", """SELECT booking_id, studio_id, visit_ts, CAST(amount AS DOUBLE) AS amount, status
FROM bookings""")
def n10(ctx):
    """Bookings deduplicated by id with a total order."""
    return ctx.bookings.select("booking_id", "studio_id", "visit_ts", F.col("amount").cast("double").alias("amount"),
                               "status")


@query("n11_unify_leads", """SELECT studio_id, source, count(*) AS records,
  count(*) FILTER (WHERE phone_valid) AS valid_phones
FROM (SELECT studio_id, 'amo' AS source, phone_valid FROM leads
      UNION ALL SELECT studio_id, 'yclients', phone_valid FROM bookings
      UNION ALL SELECT studio_id, 'gsheets', phone_valid FROM ad_leads) GROUP BY ALL""")
def n11(ctx):
    u = N.unify_leads(ctx.leads, ctx.bookings, ctx.ad_leads)
    return u.groupBy("studio_id", "source").agg(F.count(F.lit(1)).alias("records"),
                                                F.count_if("phone_valid").alias("valid_phones"))


@query("n12_attach_booking", """SELECT studio_id, lead_id, yc_booking_id, booking_ts, booking_status,
  CAST(booking_amount AS DOUBLE) AS booking_amount FROM leads_booked""")
def n12(ctx):
    """Earliest booking at or after the lead (as-of join on studio + phone)."""
    return ctx.leads_booked.select("studio_id", "lead_id", "yc_booking_id", "booking_ts", "booking_status",
                                   F.col("booking_amount").cast("double").alias("booking_amount"))


@query("n13_enrich_utm", """SELECT l.studio_id,
  coalesce(CASE WHEN length(lower(trim(l.utm_source))) > 0 THEN lower(trim(l.utm_source)) END, a.channel) AS utm_source,
  coalesce(CASE WHEN length(lower(trim(l.utm_source))) > 0 THEN lower(trim(l.utm_source)) END, a.channel) IS NULL AS ad_channel_unknown,
  a.phone IS NOT NULL AS from_ads,
  count(*) AS leads
FROM leads l LEFT JOIN (
  SELECT * FROM (SELECT studio_id, phone, channel, utm_campaign,
    row_number() OVER (PARTITION BY studio_id, phone ORDER BY created_at DESC, ad_lead_id DESC) AS rn
    FROM ad_leads WHERE phone_valid) WHERE rn = 1) a
  ON a.studio_id = l.studio_id AND a.phone = l.phone
GROUP BY ALL""")
def n13(ctx):
    e = N.enrich_utm(ctx.leads, ctx.ad_leads)
    return e.groupBy("studio_id", "utm_source", "ad_channel_unknown", "from_ads").agg(F.count(F.lit(1)).alias("leads"))


@query("n14_visit_flags", """SELECT studio_id, count(*) FILTER (WHERE rn = 1) AS first_visits,
  count(*) FILTER (WHERE rn > 1) AS repeat_visits
FROM (SELECT studio_id, row_number() OVER (PARTITION BY studio_id, phone ORDER BY visit_ts, booking_id) AS rn
      FROM bookings WHERE status = 'visited' AND phone_valid) GROUP BY studio_id""")
def n14(ctx):
    v = N.visit_flags(ctx.bookings)
    return v.groupBy("studio_id").agg(F.count_if("is_first_visit").alias("first_visits"),
                                      F.count_if("is_repeat").alias("repeat_visits"))


@query("n14_created_by_admin", """SELECT b.studio_id, b.booking_id, b.phone FROM bookings b
WHERE b.phone_valid AND NOT EXISTS (SELECT 1 FROM leads l WHERE l.phone_valid AND l.studio_id = b.studio_id
  AND l.phone = b.phone)""")
def n14b(ctx):
    return N.created_by_admin(ctx.bookings, ctx.leads).select("studio_id", "booking_id", "phone")


@query("n15_business_date", """SELECT l.studio_id,
  CAST(timezone(s.timezone, l.created_at AT TIME ZONE 'UTC') AS DATE) AS business_date, count(*) AS leads
FROM leads l JOIN studios s ON s.studio_id = l.studio_id GROUP BY ALL""")
def n15(ctx):
    """Lead date in the studio's time zone."""
    s = fx.studios(ctx.t).select("studio_id", "timezone")
    j = ctx.leads.join(s, "studio_id")
    d = business_date("created_at", F.col("timezone"))
    return j.groupBy("studio_id", d.alias("business_date")).agg(F.count(F.lit(1)).alias("leads"))


@query("n16_abonement_type", """SELECT b.studio_id, p.p_type AS service_type, count(*) AS bookings,
  CAST(sum(b.amount) AS DOUBLE) AS revenue
FROM bookings b JOIN part p ON p.p_partkey = b.service_id WHERE b.quantity >= 40 GROUP BY ALL""")
def n16(ctx):
    """Subscription type of qualifying bookings (quantity >= 40)."""
    b = ctx.bookings.filter(F.col("quantity") >= 40).join(fx.part_types(ctx.t), "service_id")
    return b.groupBy("studio_id", "service_type").agg(
        F.count(F.lit(1)).alias("bookings"), F.sum("amount").cast("double").alias("revenue"))


@query("i01_client_profiles", """SELECT md5(studio_id || ':' || phone) AS client_id, studio_id, phone,
  (SELECT min(r2.source) FROM records r2 WHERE r2.studio_id = a.studio_id AND r2.phone = a.phone
     AND r2.ts = a.first_seen_at) AS first_source,
  first_seen_at, last_seen_at, total_visits, total_revenue, records
FROM (SELECT studio_id, phone, min(ts) AS first_seen_at, max(ts) AS last_seen_at,
        CAST(sum(visit) AS BIGINT) AS total_visits,
        CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS total_revenue, count(*) AS records
      FROM records GROUP BY ALL) a""")
def i01(ctx):
    """One profile per studio + phone across the three sources."""
    return I.client_profiles(ctx.leads, ctx.bookings, ctx.ad_leads)


@query("i02_client_id", "SELECT studio_id, lead_id, client_id FROM leads")
def i02(ctx):
    """Deterministic client key stamped on every lead."""
    return ctx.leads.select("studio_id", "lead_id", "client_id")


@query("i03_new_profiles", f"""SELECT studio_id, phone, min(ts) AS first_seen_at FROM records r
WHERE ts >= TIMESTAMP '{CUTOFF}' AND NOT EXISTS (SELECT 1 FROM records e WHERE e.ts < TIMESTAMP '{CUTOFF}'
  AND e.studio_id = r.studio_id AND e.phone = r.phone)
GROUP BY ALL""")
def i03(ctx):
    """Clients first seen in the batch after a cutoff (anti join to existing profiles)."""
    r = I._records(ctx.leads, ctx.bookings, ctx.ad_leads)
    cut = F.lit(CUTOFF).cast("timestamp_ntz")
    batch = r.filter(F.col("ts") >= cut).groupBy("studio_id", "phone").agg(F.min("ts").alias("first_seen_at"))
    existing = r.filter(F.col("ts") < cut).select("studio_id", "phone")
    return I.new_profiles(existing, batch)


@query("i05_match_by_name", """SELECT studio_id, lead_id, matched_name, score FROM (
  SELECT l.studio_id, l.lead_id, c.ad_name AS matched_name,
    round(0.7 + 0.3 * (1.0 - levenshtein(l.name, c.ad_name) / greatest(length(l.name), length(c.ad_name), 1)), 4) AS score,
    row_number() OVER (PARTITION BY l.studio_id, l.lead_id
      ORDER BY round(0.7 + 0.3 * (1.0 - levenshtein(l.name, c.ad_name) / greatest(length(l.name), length(c.ad_name), 1)), 4) DESC,
               length(c.ad_name), c.ad_name DESC) AS rn
  FROM (SELECT studio_id, lead_id, phone, lower(trim(client_name)) AS name FROM leads WHERE phone_valid) l
  JOIN (SELECT DISTINCT studio_id, phone, lower(trim(client_name)) AS ad_name FROM ad_leads
        WHERE phone_valid AND client_name IS NOT NULL) c
    ON c.studio_id = l.studio_id AND c.phone = l.phone)
WHERE rn = 1 AND score >= 0.8""")
def i05(ctx):
    """Phone + name score (0.7 / 0.3, Levenshtein), best ad-sheet name per lead."""
    return I.match_by_name(ctx.leads, ctx.ad_leads, 0.8)


# greedy by rank: pair i is taken if neither of its records was taken by a pair before it
@query("i06_match_by_time", """SELECT studio_id, rec_id, r_id, round(similarity, 4) AS similarity FROM (
  WITH RECURSIVE l AS (SELECT studio_id, CAST(lead_id AS VARCHAR) AS rec_id, lower(trim(client_name)) AS name, created_at AS ts
    FROM leads a WHERE NOT (phone_valid AND EXISTS (SELECT 1 FROM ad_leads b WHERE b.phone_valid
      AND b.studio_id = a.studio_id AND b.phone = a.phone))),
  r AS (SELECT studio_id, CAST(ad_lead_id AS VARCHAR) AS r_id, lower(trim(client_name)) AS r_name, created_at AS r_ts
    FROM ad_leads a WHERE NOT (phone_valid AND EXISTS (SELECT 1 FROM leads b WHERE b.phone_valid
      AND b.studio_id = a.studio_id AND b.phone = a.phone))),
  p AS (SELECT l.studio_id, rec_id, r_id, 1.0::DOUBLE - levenshtein(name, r_name) / greatest(length(name), length(r_name), 1) AS similarity,
      abs(date_diff('microsecond', ts, r_ts)) AS us
    FROM l JOIN r ON r.studio_id = l.studio_id AND abs(date_diff('microsecond', ts, r_ts)) <= 86400000000
    WHERE 10 * (greatest(length(name), length(r_name), 1) - levenshtein(name, r_name)) > 8 * greatest(length(name), length(r_name), 1)),
  o AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, us, rec_id, r_id) AS i FROM p),
  g AS (SELECT 0::BIGINT AS i, []::VARCHAR[] AS used, []::BIGINT[] AS taken
    UNION ALL
    SELECT o.i, CASE WHEN list_has_any(g.used, ['l' || o.studio_id || o.rec_id, 'r' || o.studio_id || o.r_id]) THEN g.used
        ELSE g.used || ['l' || o.studio_id || o.rec_id, 'r' || o.studio_id || o.r_id] END,
      CASE WHEN list_has_any(g.used, ['l' || o.studio_id || o.rec_id, 'r' || o.studio_id || o.r_id]) THEN g.taken
        ELSE g.taken || [o.i] END
    FROM g JOIN o ON o.i = g.i + 1)
  SELECT o.* FROM o WHERE list_contains((SELECT taken FROM g ORDER BY i DESC LIMIT 1), o.i))""")
def i06(ctx):
    """Leads without a phone match against ad leads that no phone match uses: +-24 h, name
    similarity > 80%, one match a lead."""
    record = lambda d, i: d.select("studio_id", F.col(i).cast("string").alias("rec_id"),
                                   F.lower(F.trim("client_name")).alias("name"), F.col("created_at").alias("ts"))
    l = I.without_phone_match(ctx.leads.select("studio_id", "lead_id", "phone", "phone_valid", "client_name", "created_at"),
                              ctx.ad_leads)
    r = I.without_phone_match(ctx.ad_leads.select("studio_id", "ad_lead_id", "phone", "phone_valid", "client_name", "created_at"),
                              ctx.leads)
    return I.assign_by_time(record(l, "lead_id"), record(r, "ad_lead_id"), 24, 0.8)


@query("i07_merged_leads", """SELECT studio_id, client_id, lead_id, merged_into, created_at FROM (
  SELECT a.studio_id, a.client_id, a.lead_id, b.lead_id AS merged_into, a.created_at,
    row_number() OVER (PARTITION BY a.studio_id, a.lead_id ORDER BY coalesce(b.closed_at, TIMESTAMP '9999-12-31') DESC,
      b.created_at DESC, b.lead_id DESC) AS rn
  FROM leads a JOIN leads b ON b.studio_id = a.studio_id AND b.client_id = a.client_id
    AND (b.created_at, b.lead_id) < (a.created_at, a.lead_id) AND (b.closed_at IS NULL OR b.closed_at > a.created_at)
  WHERE a.phone_valid AND b.phone_valid) WHERE rn = 1""")
def i07(ctx):
    """Leads created while any earlier lead of the client was still open."""
    return I.merged_leads(ctx.leads)


@query("i08_client_timeline", """SELECT md5(studio_id || ':' || phone) AS client_id, studio_id, ts, source, rec_id,
  row_number() OVER (PARTITION BY md5(studio_id || ':' || phone) ORDER BY ts, source || ':' || rec_id) AS seq
FROM records""")
def i08(ctx):
    """Client 360: records of all sources per client in time order."""
    return I.client_timeline(ctx.leads, ctx.bookings, ctx.ad_leads)
