"""WARC: resolution of not-modified revisits (operator 9).

A revisit record with status 304 holds no body; it stands for the latest earlier full
response of the same canonical URL.  The match is a backward as-of join: the shared
forward helper ``next_match`` on negated time, which splits a hot URL's history by time
bucket and never forms response x revisit pairs.  Then

* validators are compared: payload digest, entity tag (weak comparison), and the date of
  last change where neither tag is missing.  All that both records carry must agree;
* the headers a 304 may change replace those of the response, the rest stay.

Each revisit gets one row with ``resolution``: ``resolved``, ``validator_mismatch``,
``no_validator`` (nothing to compare) or ``no_earlier_response``.  Headers are merged only
for ``resolved``.

Cases: a null or malformed URL, or a null date, matches nothing; of responses with one
date the smallest record id counts, and a response with the revisit's own date is not
earlier; repeated revisits are resolved row by row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm.common import table
from leadlens.operators.sequence import next_match

# Headers that a 304 response may replace; query keys that name no resource.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary", "age", "warning",
             "set-cookie", "last-modified"]
TRACKING = r"^(utm_[a-z]*|gclid|fbclid|ref)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in small letters without ``www.`` and default port, path without a final slash,
    sorted query without tracking keys; no scheme, user or fragment.  Null if malformed."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    rest = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    path = F.regexp_replace(F.regexp_replace(rest, r"\?.*$", ""), "/+$", "")
    query = F.array_join(F.array_sort(F.filter(
        F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&"),
        lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(host != "", F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _header(headers: Column, name: str) -> Column:
    return F.get(F.filter(headers, lambda h: h["name"] == name), F.lit(0))["value"]


def _agree(a: Column, b: Column) -> Column:
    """True or false where both are there, else null."""
    return F.when(a.isNotNull() & b.isNotNull(), a == b)


def _strong(tag: Column) -> Column:
    return F.regexp_replace(tag, "^W/", "")


def resolve_revisits(records: DataFrame, bucket: str = "hour") -> DataFrame:
    """``records``: record_id, record_type, url, date (timestamp), status, digest,
    headers (array of name, value; names in small letters, at most one row a name)."""
    r = records.select("record_id", "record_type", "status", "date", "digest",
                       F.array_sort("headers").alias("headers"), canonical_url(F.col("url")).alias("canonical_url"),
                       # later is smaller; a revisit starts just before its own date
                       F.timestamp_micros(-F.unix_micros("date")
                                          + F.when(F.col("record_type") == "revisit", 1).otherwise(0)).alias("_back"))
    known = F.col("canonical_url").isNotNull() & F.col("date").isNotNull()
    revisits = r.filter((F.col("record_type") == "revisit"))
    full = r.filter((F.col("record_type") == "response") & (F.col("status") == 200) & known).select(
        "canonical_url", "_back", "record_id", F.col("date").alias("response_date"),
        F.col("digest").alias("response_digest"), F.col("headers").alias("response_headers"),
        F.col("status").alias("response_status"))
    matched = next_match(revisits.filter(known), full, ["canonical_url"], "_back", "_back", "record_id",
                         ["response_date", "response_digest", "response_headers", "response_status"], bucket=bucket)
    lost = revisits.filter(~known).withColumn("match", F.lit(None).cast(matched.schema["match"].dataType))
    d = matched.unionByName(lost).select(
        "*", "match.response_headers", "match.response_date", "match.response_digest", "match.response_status",
        F.col("match.tb").alias("response_id"))
    own, then = F.col("headers"), F.col("response_headers")
    by_tag = _agree(_strong(_header(own, "etag")), _strong(_header(then, "etag")))
    checks = F.filter(F.array(
        _agree(F.col("digest"), F.col("response_digest")), by_tag,
        F.when(by_tag.isNull(), _agree(_header(own, "last-modified"), _header(then, "last-modified")))),
        lambda x: x.isNotNull())
    resolution = (F.when(F.col("response_id").isNull(), "no_earlier_response")
                  .when(F.size(checks) == 0, "no_validator")
                  .when(F.forall(checks, lambda x: x), "resolved").otherwise("validator_mismatch"))
    fresh = F.filter(own, lambda h: h["name"].isin(PERMITTED))
    stays = F.filter(then, lambda h: ~F.array_contains(F.transform(fresh, lambda f: f["name"]), h["name"]))
    d = d.withColumn("resolution", resolution)
    good = F.col("resolution") == "resolved"
    return d.select("record_id", "canonical_url", "date", "resolution", "response_id", "response_date",
                    F.when(good, F.col("response_status")).alias("status"),
                    F.when(good, F.col("response_digest")).alias("digest"),
                    F.when(good, F.array_sort(F.concat(stays, fresh))).alias("headers"))


def _headers(**values: Column) -> Column:
    return F.array(*[F.struct(F.lit(k.replace("_", "-")).alias("name"), v.cast("string").alias("value"))
                     for k, v in values.items()])


def records_of(pages: DataFrame) -> DataFrame:
    """Capture records of crawled pages: page p is fetched in full at minute p of the crawl
    and asked for again a day later and half a day earlier, with its own validators; the
    second answer carries a weak tag, and no digest."""
    base, minute = F.lit("2024-01-01 00:00:00").cast("timestamp"), F.col("page_id") * 60
    at = lambda shift: F.timestamp_seconds(F.unix_timestamp(base) + minute + shift)
    tag, stamp = F.md5("html"), F.lit("max-age=60")
    row = lambda kind, n, shift, status, digest, headers: F.struct(
        (F.col("page_id") * 3 + n).alias("record_id"), F.lit(kind).alias("record_type"), F.col("url"),
        at(shift).alias("date"), F.lit(status).alias("status"), digest.alias("digest"), headers.alias("headers"))
    date = lambda shift: F.date_format(at(shift), "yyyy-MM-dd HH:mm:ss")
    none = F.lit(None).cast("string")
    return pages.select(F.explode(F.array(
        row("response", 0, 0, 200, F.sha1("html"), _headers(
            content_length=F.length("html"), content_type=F.lit("text/html"), date=date(0), etag=tag)),
        row("revisit", 1, 86400, 304, F.sha1("html"), _headers(
            cache_control=stamp, content_length=F.lit(0), date=date(86400), etag=tag)),
        row("revisit", 2, -43200, 304, none, _headers(
            date=date(-43200), etag=F.concat(F.lit("W/"), tag), server=F.lit("cache")))
    )).alias("r")).select("r.*")


def op9_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = resolve_revisits(records_of(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    text = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return d.select("record_id", "canonical_url", F.unix_timestamp("date").alias("date_s"), "resolution",
                    "response_id", F.unix_timestamp("response_date").alias("response_date_s"), "status", "digest",
                    text.alias("headers"))


QUERIES = {"op9_warc_revisit": op9_warc_revisit}

ORACLE = {"op9_warc_revisit": rf"""
WITH p AS (SELECT *, 1704067200 + page_id * 60 AS s, md5(html) AS tag, sha1(html) AS sha,
    regexp_replace(trim(url), '#.*$', '') AS u FROM pages),
q AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u,
        '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)', 1)), '^www\.', ''), ':(80|443)$', '') AS host,
      regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '') AS rest FROM p),
c AS (SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
        lambda x: x <> '' AND NOT regexp_matches(x, '{TRACKING}'))), '&') AS qs FROM q),
k AS (SELECT *, CASE WHEN host <> '' THEN host || regexp_replace(regexp_replace(rest, '\?.*$', ''), '/+$', '')
        || CASE WHEN qs <> '' THEN '?' || qs ELSE '' END END AS canonical_url FROM c),
f AS (SELECT canonical_url, s, min(page_id * 3) AS response_id, arg_min(tag, page_id) AS rtag,
             arg_min(sha, page_id) AS rsha, arg_min(length(html), page_id) AS rlen
      FROM k WHERE canonical_url IS NOT NULL AND s IS NOT NULL GROUP BY ALL),
v AS (SELECT page_id * 3 + 1 AS record_id, canonical_url, s + 86400 AS t, tag, sha, 1 AS kind FROM k
      UNION ALL SELECT page_id * 3 + 2, canonical_url, s - 43200, tag, NULL, 2 FROM k),
j AS (SELECT v.*, f.response_id, f.s AS rs, f.rtag, f.rsha, f.rlen
      FROM v ASOF LEFT JOIN f ON v.canonical_url = f.canonical_url AND v.t > f.s),
r AS (SELECT *, CASE WHEN response_id IS NULL THEN 'no_earlier_response'
        WHEN tag = rtag AND (sha IS NULL OR sha = rsha) THEN 'resolved' ELSE 'validator_mismatch' END AS resolution
      FROM j)
SELECT record_id, canonical_url, t AS date_s, resolution, response_id, rs AS response_date_s,
  CASE WHEN resolution = 'resolved' THEN 200 END AS status,
  CASE WHEN resolution = 'resolved' THEN rsha END AS digest,
  CASE WHEN resolution = 'resolved' THEN
    CASE WHEN kind = 1 THEN 'cache-control: max-age=60' || chr(10) ELSE '' END
    || 'content-length: ' || rlen || chr(10) || 'content-type: text/html' || chr(10)
    || 'date: ' || strftime(to_timestamp(t) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') || chr(10)
    || 'etag: ' || CASE WHEN kind = 2 THEN 'W/' ELSE '' END || tag END AS headers
FROM r"""}
