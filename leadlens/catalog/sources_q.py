"""Source-side queries over the fixtures (S-*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from leadlens.catalog.normalize_q import STATUS_CODE_SQL
from leadlens.plans.identity import _records
from leadlens.registry import query
from leadlens.session import ensure_checkpoint_dir
from leadlens.sources import fixtures as fx
from leadlens.sources import landed as S
from leadlens.sources.fixtures import AS_OF_STAR
from leadlens.sources.manifest import choose_loads
from leadlens.sources.sinks import upsert

FRM, TO = "2000-01-01", "2000-12-31"
ALL_RECORDS = [("all_records", """SELECT studio_id, 'amo' AS source, created_at AS ts FROM leads
  UNION ALL SELECT studio_id, 'yclients', visit_ts FROM bookings
  UNION ALL SELECT studio_id, 'gsheets', created_at FROM ad_leads""")]
DOMAIN = r"^https?://([^/?#]+).*$"


@query("s06_active_studio_leads", """SELECT l.studio_id, count(*) AS leads FROM leads l
WHERE EXISTS (SELECT 1 FROM studios s WHERE s.is_active AND s.studio_id = l.studio_id) GROUP BY l.studio_id""")
def s06(ctx):
    """Leads of active studios only (registry drives the run; one job, semi join)."""
    l = S.for_studios(ctx.leads, S.active_studios(fx.studios(ctx.t)))
    return l.groupBy("studio_id").agg(F.count(F.lit(1)).alias("leads"))


@query("s07_period", f"""SELECT studio_id, lead_id, created_at FROM leads
WHERE created_at >= DATE '{FRM}' AND CAST(created_at AS DATE) <= DATE '{TO}'""")
def s07(ctx):
    """Leads of a period (backfill bounds)."""
    return S.in_period(ctx.leads, "created_at", FRM, TO).select("studio_id", "lead_id", "created_at")


@query("s09_fill_domain", f"""SELECT page_id, regexp_replace(url, '{DOMAIN}', '\\1') AS domain FROM pages""")
def s09(ctx):
    """Fill a missing domain from the URL; unmatched URLs stay whole."""
    p = ctx.t.pages.select("page_id", "url", F.lit(None).cast("string").alias("domain"))
    return S.fill_missing(p, "domain", "url", DOMAIN).select("page_id", "domain")


@query("s10_keep_since", f"""SELECT studio_id, lead_date, count(*) AS leads FROM leads
WHERE lead_date >= DATE '{AS_OF_STAR}' - 90 GROUP BY ALL""")
def s10(ctx):
    """Retention window of 90 days applied to daily metric rows."""
    d = ctx.leads.groupBy("studio_id", "lead_date").agg(F.count(F.lit(1)).alias("leads"))
    return S.keep_since(d, "lead_date", AS_OF_STAR, 90)


@query("s11_last_loaded", f"""SELECT studio_id, source, max(ts) AS last_loaded_at,
  date_diff('day', CAST(max(ts) AS DATE), DATE '{AS_OF_STAR}') > 1 AS is_stale
FROM all_records GROUP BY studio_id, source""", views=ALL_RECORDS)
def s11(ctx):
    """Latest data per studio and source with a staleness flag."""
    r = _records(ctx.leads, ctx.bookings, ctx.ad_leads, valid_only=False)
    return S.last_loaded(r, ["studio_id", "source"], "ts", AS_OF_STAR, 1)


@query("s12_input_health", f"""SELECT s.studio_id, x.source, coalesce(c.rows, 0) AS rows, coalesce(c.rows, 0) = 0 AS is_empty
FROM studios s CROSS JOIN (VALUES ('amo'), ('yclients'), ('gsheets')) x(source)
LEFT JOIN (SELECT studio_id, source, count(*) AS rows FROM all_records
           WHERE ts >= TIMESTAMP '2001-07-01' AND ts < TIMESTAMP '2001-08-01' GROUP BY ALL) c
  ON c.studio_id = s.studio_id AND c.source = x.source
WHERE s.is_active""", views=ALL_RECORDS)
def s12(ctx):
    """Rows per active studio and source in a month; empty inputs flagged."""
    r = _records(ctx.leads, ctx.bookings, ctx.ad_leads, valid_only=False)
    r = r.filter((F.col("ts") >= F.lit("2001-07-01").cast("timestamp_ntz"))
                 & (F.col("ts") < F.lit("2001-08-01").cast("timestamp_ntz")))
    counts = r.groupBy("studio_id", "source").agg(F.count(F.lit(1)).alias("rows"))
    return S.input_health(counts, fx.studios(ctx.t), ["amo", "yclients", "gsheets"])


@query("s08_upsert_moves_keys", """SELECT studio_id, status_code, count(*) AS leads,
  CAST(sum(epoch_us(updated_at) // 1000000) AS BIGINT) AS updated_s FROM (
  SELECT * FROM (SELECT studio_id, lead_id, created_at AS updated_at, 'NEW' AS status_code FROM leads
    UNION ALL SELECT studio_id, lead_id, closed_at, {status} FROM leads WHERE closed_at IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY studio_id, lead_id ORDER BY updated_at DESC, status_code DESC) = 1)
GROUP BY ALL""".format(status=STATUS_CODE_SQL))
def s08(ctx):
    """A lead table partitioned by status after three upserts: all leads as they came in, their
    closings (which move them to another partition), and the first load delivered again."""
    path = f"{ensure_checkpoint_dir(ctx.spark).rstrip('/')}/leadlens-upsert/{uuid.uuid4().hex}"
    row = lambda ts, status: ctx.leads.select("studio_id", "lead_id", F.col(ts).alias("updated_at"),
                                              status.alias("status_code"))
    first = row("created_at", F.lit("NEW"))
    for batch in (first, row("closed_at", F.col("status_code")).filter("updated_at IS NOT NULL"), first):
        upsert(ctx.spark, path, batch, ["studio_id", "lead_id"], ["updated_at"], ["studio_id", "status_code"])
    t = ctx.spark.read.schema(first.schema).parquet(path)
    return t.groupBy("studio_id", "status_code").agg(
        F.count(F.lit(1)).alias("leads"), F.sum(F.unix_timestamp(F.col("updated_at").cast("timestamp"))).alias("updated_s"))


@query("s11_chosen_loads", f"""SELECT s.studio_id, x.source, l.load_id, l.rows, l.loaded_at,
  coalesce(l.loaded_at < TIMESTAMP '{AS_OF_STAR}', false) AS is_stale, l.load_id IS NULL AS is_missing
FROM studios s CROSS JOIN (VALUES ('amo'), ('yclients'), ('gsheets')) x(source)
LEFT JOIN (SELECT studio_id, source, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS load_id, count(*) AS rows,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) AS loaded_at FROM all_records WHERE ts < DATE '{AS_OF_STAR}' + 1
    GROUP BY studio_id, source, CAST(ts AS DATE)
    QUALIFY row_number() OVER (PARTITION BY studio_id, source ORDER BY CAST(ts AS DATE) DESC) = 1) l
  ON l.studio_id = s.studio_id AND l.source = x.source
WHERE s.is_active""", views=ALL_RECORDS)
def s11_loads(ctx):
    """The load that a run on the as-of date reads per active studio and source (a day's records are a
    load): that day's, or the last complete one, flagged stale."""
    r = _records(ctx.leads, ctx.bookings, ctx.ad_leads, valid_only=False)
    m = r.groupBy("source", "studio_id", F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    m = m.select("source", "studio_id", F.date_format("d", "yyyy-MM-dd").alias("load_id"), "rows",
                 F.col("d").cast("timestamp_ntz").alias("loaded_at"))
    return choose_loads(m, fx.studios(ctx.t), ["amo", "yclients", "gsheets"], AS_OF_STAR)


@query("s05_payload", """SELECT page_id, CASE WHEN page_id % 7 >= 2 THEN url END AS link,
  CASE WHEN page_id % 7 >= 2 THEN length(html) END AS size, CASE WHEN page_id % 7 >= 2 THEN page_id END AS first_id
FROM pages""")
def s05(ctx):
    """Typed paths of a nested payload kept with each page; some payloads are null, some cut off."""
    p = ctx.t.pages
    raw = F.to_json(F.struct(F.struct(F.col("url").alias("href"), F.length("html").alias("size")).alias("page"),
                             F.array("page_id").alias("ids")))
    kept = p.select("page_id", F.when(p.page_id % 7 == 0, None).when(p.page_id % 7 == 1, F.substring(raw, 1, 9))
                    .otherwise(raw).alias("raw_data"))
    return S.with_payload(kept, {"link": "$.page.href", "size": ("$.page.size", "bigint"),
                                 "first_id": ("$.ids[0]", "bigint")}).drop("raw_data")
