"""Scans of landed source files (S-01 .. S-07, S-09 .. S-12).

The connectors of the original system call REST APIs; here each source is a
folder of landed files (JSON pages from the CRM and the booking system, CSV
exports of the sheets) read with an explicit schema, so nothing is inferred
and malformed rows are kept in a corrupt-record column instead of failing the
job.  Landed folders are expected to be partitioned by ``studio_id`` and
``load_date`` so that the studio and period predicates prune files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRM_PAGE_SCHEMA = """_embedded struct<leads: array<struct<
    id: bigint, name: string, price: double, status_id: bigint, pipeline_id: bigint,
    responsible_user_id: bigint, created_at: bigint, updated_at: bigint, closed_at: bigint,
    custom_fields_values: array<struct<field_code: string, values: array<struct<value: string>>>>,
    contact: struct<name: string, first_name: string, last_name: string, phone: string, email: string>>>>,
    studio_id string, load_date date"""

BOOKING_PAGE_SCHEMA = """data array<struct<id: bigint, client: struct<id: bigint, name: string, phone: string>,
    services: array<struct<id: bigint, title: string, cost: double>>, staff_id: bigint, staff_name: string,
    datetime: string, attendance: int, paid_full: int, comment: string>>,
    studio_id string, load_date date"""

SPEND_CSV_SCHEMA = ("expense_date date, article string, amount decimal(18,2), channel string, "
                    "_corrupt_record string")
AD_LEADS_CSV_SCHEMA = ("deal_id bigint, source_name string, utm_source string, utm_campaign string, "
                       "client_name string, client_phone string, studio_name string, created_at timestamp_ntz, "
                       "_corrupt_record string")

UTM_FIELDS = ["utm_source", "utm_campaign", "utm_medium", "utm_content", "utm_term"]


def in_period(df: DataFrame, col: str, frm: str | None, to: str | None) -> DataFrame:
    """S-07: inclusive period on a date or timestamp column (pushed to the scan)."""
    c = F.col(col)
    if frm:
        df = df.filter(c >= F.lit(frm).cast("date"))
    if to:
        df = df.filter(F.to_date(c) <= F.lit(to).cast("date"))
    return df


def active_studios(studios: DataFrame) -> DataFrame:
    """S-06: the registry rows with ``is_active``."""
    return studios.filter(F.col("is_active")).select("studio_id")


def for_studios(df: DataFrame, studios: DataFrame | None) -> DataFrame:
    """Keep the rows of the given studios with a left-semi join (one job for all studios)."""
    return df if studios is None else df.join(studios.select("studio_id"), "studio_id", "left_semi")


def _utm(fields: Column, code: str) -> Column:
    hit = F.filter(fields, lambda x: x["field_code"] == F.lit(code.upper()))
    return F.try_element_at(F.try_element_at(hit, F.lit(1))["values"], F.lit(1))["value"]


def scan_crm(spark: SparkSession, path: str, studios: DataFrame | None = None,
             frm: str | None = None, to: str | None = None) -> DataFrame:
    """S-01: CRM lead pages -> one row per lead (N-08: UTM from custom fields)."""
    pages = spark.read.schema(CRM_PAGE_SCHEMA).json(path)
    pages = in_period(pages, "load_date", frm, None) if frm else pages
    leads = pages.select("studio_id", "load_date", F.explode("_embedded.leads").alias("l"))
    # epoch seconds -> UTC wall clock, independent of the session time zone
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    ts = lambda c: F.timestamp_add("SECOND", F.col("l." + c), epoch)
    out = leads.select(
        F.col("l.id").alias("lead_id"), "studio_id", F.col("l.status_id").alias("status_id"),
        *[_utm(F.col("l.custom_fields_values"), u).alias(u) for u in UTM_FIELDS],
        F.col("l.pipeline_id").alias("pipeline_id"), F.col("l.responsible_user_id").alias("responsible_id"),
        ts("created_at").alias("created_at"), ts("updated_at").alias("updated_at"),
        ts("closed_at").alias("closed_at"), F.col("l.price").cast("decimal(18,2)").alias("price"),
        F.col("l.name").alias("name"), F.col("l.contact.name").alias("client_name"),
        F.col("l.contact.first_name").alias("client_first_name"),
        F.col("l.contact.last_name").alias("client_last_name"),
        F.col("l.contact.phone").alias("client_phone"), F.col("l.contact.email").alias("client_email"),
        F.lit("amo").alias("source"), F.to_json("l").alias("raw_data"),
        F.col("load_date").cast("timestamp_ntz").alias("loaded_at"))
    return in_period(for_studios(out, studios), "created_at", frm, to)


def scan_bookings(spark: SparkSession, path: str, studios: DataFrame | None = None,
                  frm: str | None = None, to: str | None = None) -> DataFrame:
    """S-02: booking-system record pages -> one row per record."""
    pages = spark.read.schema(BOOKING_PAGE_SCHEMA).json(path)
    r = pages.select("studio_id", "load_date", F.explode("data").alias("r"))
    visit_ts = F.to_timestamp_ntz(F.substring(F.col("r.datetime"), 1, 19))
    out = r.select(
        F.col("r.id").alias("booking_id"), "studio_id", F.col("r.client.id").alias("client_ref"),
        F.col("r.client.name").alias("client_name"), F.col("r.client.phone").alias("client_phone"),
        F.try_element_at("r.services", F.lit(1))["id"].alias("service_id"),
        F.try_element_at("r.services", F.lit(1))["title"].alias("service_name"),
        F.col("r.staff_id").alias("master_id"), F.col("r.staff_name").alias("master_name"),
        visit_ts.alias("visit_ts"),
        F.aggregate("r.services", F.lit(0.0), lambda acc, s: acc + F.coalesce(s["cost"], F.lit(0.0)))
         .cast("decimal(18,2)").alias("amount"),
        F.col("r.attendance").alias("attendance"), (F.col("r.paid_full") == 1).alias("paid"),
        F.col("r.comment").alias("comment"), F.to_json("r").alias("raw_data"),
        F.col("load_date").cast("timestamp_ntz").alias("loaded_at"))
    return in_period(for_studios(out, studios), "visit_ts", frm, to)


def scan_spend(spark: SparkSession, path: str, studios: DataFrame | None = None,
               frm: str | None = None, to: str | None = None) -> DataFrame:
    """S-03: spend sheet CSV export; bad rows land in ``_corrupt_record``."""
    df = (spark.read.schema(SPEND_CSV_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))
    return in_period(for_studios(df, studios), "expense_date", frm, to) if "studio_id" in df.columns else \
        in_period(df, "expense_date", frm, to)


def scan_ad_leads(spark: SparkSession, path: str, studios: DataFrame | None = None,
                  frm: str | None = None, to: str | None = None) -> DataFrame:
    """S-04: ad-lead sheet CSV export."""
    df = (spark.read.schema(AD_LEADS_CSV_SCHEMA).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").csv(path))
    df = in_period(df, "created_at", frm, to)
    return for_studios(df, studios) if "studio_id" in df.columns else df


def with_payload(df: DataFrame, paths: dict[str, str | tuple[str, str]], payload: str = "raw_data") -> DataFrame:
    """S-05: read paths out of the kept raw payload: ``{'out_col': '$.a.b'}``, or ``('$.a.b', type)`` for
    another type than string.

    The payload is parsed once a row, into a VARIANT, however many paths are read.  A null or
    malformed payload, a path that is not there and a value that has not the type give null.
    """
    v = df.withColumn("_payload", F.try_parse_json(F.col(payload)))
    typed = {n: (p, "string") if isinstance(p, str) else p for n, p in paths.items()}
    return v.select(*[c for c in df.columns if c not in typed], *[
        F.try_variant_get("_payload", p, t).alias(n) for n, (p, t) in typed.items()])


def fill_missing(df: DataFrame, target: str, source: str, pattern: str, replacement: str = "$1") -> DataFrame:
    """S-09: set ``target`` from ``regexp_replace(source, pattern, replacement)`` where it is NULL.

    Like PostgreSQL's regexp_replace, a source that does not match stays whole.
    """
    return df.withColumn(target, F.coalesce(F.col(target), F.regexp_replace(F.col(source), pattern, replacement)))


def keep_since(df: DataFrame, col: str, as_of: str, days: int) -> DataFrame:
    """S-10: retention window, ``col >= as_of - days``."""
    return df.filter(F.col(col) >= F.date_sub(F.lit(as_of).cast("date"), days))


def last_loaded(df: DataFrame, keys: list[str], loaded_col: str, as_of: str, stale_days: int = 1) -> DataFrame:
    """S-11: latest load per key (studio, source) with an ``is_stale`` flag."""
    g = df.groupBy(*keys).agg(F.max(loaded_col).alias("last_loaded_at"))
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("last_loaded_at"))
    return g.withColumn("is_stale", age > stale_days)


def input_health(counts: DataFrame, studios: DataFrame, sources: list[str]) -> DataFrame:
    """S-12: rows per active studio and source in a period; 0 rows -> ``is_empty``.

    The studio x source grid is the studio table with a fixed array of source
    names exploded (no cross join of data tables).  ``counts``: studio_id, source, rows.
    """
    grid = active_studios(studios).select("studio_id", F.explode(F.array(*[F.lit(s) for s in sources])).alias("source"))
    j = grid.join(counts, ["studio_id", "source"], "left")
    return j.withColumn("rows", F.coalesce("rows", F.lit(0).cast("bigint"))).withColumn("is_empty", F.col("rows") == 0)
