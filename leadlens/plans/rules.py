"""Stage validation rules (V-01 .. V-15).

Every check returns the same shape: studio_id, entity_id, rule_id, severity,
detail.  Per-client facts (visit counts, paid sums, future bookings) are
aggregated once per client before they meet the leads, so a lead joins at
most one row per fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens import config as C
from leadlens.functions import pct
from leadlens.operators.broadcast import bounded_broadcast
from leadlens.plans.metrics import client_visits

VIOLATION_COLS = ["studio_id", "entity_id", "rule_id", "severity", "detail"]


def _v(df: DataFrame, rule: str, sev: str, detail: Column, entity: str = "lead_id") -> DataFrame:
    return df.select("studio_id", F.col(entity).cast("string").alias("entity_id"), F.lit(rule).alias("rule_id"),
                     F.lit(sev).alias("severity"), detail.cast("string").alias("detail"))


def _asof(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def check_new_lead(enriched: DataFrame) -> DataFrame:
    """V-01: new leads not found in the ad sheet, with a bad phone (A13) or no channel (A14)."""
    n = enriched.filter(F.col("status_id").isin(*C.STATUS_NEW))
    return (_v(n.filter(~F.col("from_ads")), "V01", "INFO", F.lit("not_from_ads"))
            .unionByName(_v(n.filter(~F.col("phone_valid")), "A13", "INFO", F.col("client_phone")))
            .unionByName(_v(n.filter(F.col("ad_channel_unknown")), "A14", "INFO", F.lit("unknown_channel"))))


def check_new_lead_sla(leads: DataFrame, as_of: str, hours: float) -> DataFrame:
    """V-02: new lead unchanged for more than ``hours``; no manager assigned."""
    n = leads.filter(F.col("status_id").isin(*C.STATUS_NEW))
    age = F.timestamp_diff("HOUR", F.col("updated_at"), _asof(as_of))
    idle = F.timestamp_diff("MICROSECOND", F.col("updated_at"), _asof(as_of))
    return (_v(n.filter(idle > int(hours * 3_600_000_000)), "V02", "WARNING", age)
            .unionByName(_v(n.filter(F.col("responsible_id").isNull()), "V02_unassigned", "WARNING", F.lit("no_manager"))))


def check_negotiation(leads: DataFrame, as_of: str, days: float) -> DataFrame:
    """V-03 / A05: open negotiation older than N days (created_at)."""
    n = leads.filter(F.col("status_id").isin(*C.STATUS_NEGOTIATION) & F.col("closed_at").isNull())
    age = F.datediff(_asof(as_of), F.col("created_at"))
    return _v(n.filter(age > days), "A05", "WARNING", age)


def check_no_answer(leads: DataFrame, as_of: str, days: float) -> DataFrame:
    """V-04 / A06: open no-answer lead without a status change for N days (updated_at)."""
    n = leads.filter(F.col("status_id").isin(*C.STATUS_NO_ANSWER) & F.col("closed_at").isNull())
    age = F.datediff(_asof(as_of), F.col("updated_at"))
    return _v(n.filter(age > days), "A06", "WARNING", age)


def check_appointment(leads: DataFrame, bookings: DataFrame, as_of: str) -> DataFrame:
    """V-05 / A07: appointment without a confirmed or waiting *future* booking."""
    fut = (bookings.filter(F.col("phone_valid") & F.col("status").isin("confirmed", "waiting")
                           & (F.col("visit_ts") > _asof(as_of)))
           .select("studio_id", "phone").distinct())
    a = leads.filter(F.col("status_id") == C.STATUS_APPOINTMENT)
    return _v(a.join(fut, ["studio_id", "phone"], "left_anti"), "A07", "WARNING", F.lit("no_future_booking"))


def check_no_show(leads: DataFrame, bookings: DataFrame) -> DataFrame:
    """V-06 / A08: CRM no-show although the booking system shows a visit (semi join)."""
    vis = (bookings.filter(F.col("phone_valid") & (F.col("status") == "visited"))
           .select("studio_id", "phone").distinct())
    a = leads.filter((F.col("status_id") == C.STATUS_NO_SHOW) & F.col("phone_valid"))
    return _v(a.join(vis, ["studio_id", "phone"], "left_semi"), "A08", "WARNING", F.lit("visited_in_bookings"))


def check_first_visit(visit_flags: DataFrame) -> DataFrame:
    """V-07: completed first visits -> upsell list."""
    f = visit_flags.filter("is_first_visit")
    return _v(f, "V07", "INFO", F.col("phone"), entity="booking_id")


def check_not_purchased(leads: DataFrame, bookings: DataFrame) -> DataFrame:
    """V-08 / A09: 'not bought' but the client has visits."""
    cv = client_visits(bookings).select("studio_id", "phone", "visits")
    a = leads.filter(F.col("status_id") == C.STATUS_NOT_PURCHASED).join(cv, ["studio_id", "phone"])
    return _v(a.filter(F.col("visits") > 0), "A09", "INFO", F.col("visits"))


def _paid(leads: DataFrame, bookings: DataFrame, status: int) -> DataFrame:
    cv = client_visits(bookings).select("studio_id", "phone", "revenue")
    return leads.filter(F.col("status_id") == status).join(cv, ["studio_id", "phone"], "left")


def check_deposit(leads: DataFrame, bookings: DataFrame) -> DataFrame:
    """V-09 / A11: deposit stage with no payment or paid sum below the CRM price."""
    a = _paid(leads, bookings, C.STATUS_DEPOSIT)
    bad = F.col("revenue").isNull() | (F.col("revenue") < F.col("price"))
    return _v(a.filter(bad), "A11", "WARNING", F.coalesce(F.col("revenue"), F.lit(0)) - F.col("price"))


def check_success(leads: DataFrame, bookings: DataFrame) -> DataFrame:
    """V-10 / A10: won deal whose booking revenue is below the CRM price."""
    a = _paid(leads, bookings, C.STATUS_SUCCESS)
    return _v(a.filter(F.coalesce(F.col("revenue"), F.lit(0)) < F.col("price")), "A10", "WARNING",
              F.coalesce(F.col("revenue"), F.lit(0)) - F.col("price"))


def check_not_renewed(leads: DataFrame, bookings: DataFrame, as_of: str, days: float) -> DataFrame:
    """V-11: not renewed and the last visit is more than N days before as_of."""
    v = bookings.filter(F.col("phone_valid") & (F.col("status") == "visited")
                        & (F.col("visit_date") <= F.lit(as_of).cast("date")))
    last = v.groupBy("studio_id", "phone").agg(F.max("visit_date").alias("last_visit"))
    a = leads.filter(F.col("status_id") == C.STATUS_NO_RENEWAL).join(last, ["studio_id", "phone"])
    gap = F.datediff(F.lit(as_of).cast("date"), F.col("last_visit"))
    return _v(a.filter(gap > days), "V11", "INFO", gap)


def check_regular_visits(leads: DataFrame, bookings: DataFrame) -> DataFrame:
    """V-12: two or more visits while the CRM status is still an early stage."""
    early = C.STATUS_NEW + C.STATUS_NEGOTIATION + C.STATUS_NO_ANSWER + [C.STATUS_APPOINTMENT]
    cv = client_visits(bookings).select("studio_id", "phone", "visits")
    a = leads.filter(F.col("status_id").isin(*early)).join(cv, ["studio_id", "phone"])
    return _v(a.filter(F.col("visits") >= 2), "V12", "INFO", F.col("visits"))


def check_closure_rate(leads_booked: DataFrame, threshold: float) -> DataFrame:
    """V-13 / A12: share of closed-lost leads above the threshold, per studio; the
    detail carries how many of them never had a booking."""
    lost = F.col("status_id") == C.STATUS_CLOSED_LOST
    g = leads_booked.groupBy("studio_id").agg(
        F.count(F.lit(1)).alias("leads"), F.count_if(lost).alias("lost"),
        F.count_if(lost & F.col("yc_booking_id").isNull()).alias("lost_no_booking"))
    g = g.withColumn("rate", pct("lost", "leads", 2))
    return g.filter(F.col("rate") > threshold).select(
        "studio_id", F.col("studio_id").alias("entity_id"), F.lit("A12").alias("rule_id"),
        F.lit("WARNING").alias("severity"),
        F.concat_ws(":", F.col("rate").cast("string"), F.col("lost_no_booking").cast("string")).alias("detail"))


# ---------------------------------------------------------------------------
# V-14 rule-table engine
# ---------------------------------------------------------------------------

RULE_SCHEMA = ("rule_id string, stage_code string, studio_id string, check_type string, "
               "criteria string, alert_template string, severity string, is_active boolean")
CRITERIA_SCHEMA = ("stage_ids array<bigint>, timeout_days int, statuses array<string>, "
                   "min_visits int, max_days_since int")

# Rule table of the fixtures (ours): one rule per check type.
DEFAULT_RULES = [
    ("R1", "visit_scheduled", "all", "phone_exists", '{"stage_ids":[74087590],"statuses":["confirmed","waiting"]}',
     "lead {entity}: appointment without booking", "WARNING", True),
    ("R2", "no_show", "all", "status_match", '{"stage_ids":[74087594],"statuses":["no_show","canceled"]}',
     "lead {entity}: booking status {detail}", "WARNING", True),
    ("R3", "success", "all", "sum_compare", '{"stage_ids":[142]}',
     "lead {entity}: paid differs by {detail}", "WARNING", True),
    ("R4", "not_purchased", "all", "visit_count", '{"stage_ids":[74087598],"min_visits":1}',
     "lead {entity}: {detail} visits but no purchase", "INFO", True),
    ("R5", "negotiation", "all", "timeout", '{"stage_ids":[74087586,84866070],"timeout_days":7}',
     "lead {entity}: {detail} days in negotiation", "WARNING", True),
]


def rules_table(spark, rows=None) -> DataFrame:
    r = spark.createDataFrame(rows or DEFAULT_RULES, RULE_SCHEMA)
    return r.withColumn("c", F.from_json("criteria", CRITERIA_SCHEMA)).filter("is_active")


def run_rules(leads_booked: DataFrame, bookings: DataFrame, rules: DataFrame, as_of: str) -> DataFrame:
    """V-14: evaluate a table of rules in one pass.

    Each rule applies to the leads whose status is in its ``stage_ids`` and whose
    studio equals the rule's (or the rule is 'all').  The facts every check type
    needs (visits, paid sum, the set of booking statuses seen - at most five
    values) are one row per client, joined once; the check type then selects
    the failing condition in a single CASE, so the leads are read once.
    """
    r = bounded_broadcast(rules.select("rule_id", F.col("studio_id").alias("rule_studio"), "check_type",
                                       F.explode("c.stage_ids").alias("rule_status"), "c", "severity"))
    l = leads_booked.select("studio_id", "lead_id", "phone", "status_id", "price", "created_at",
                            "closed_at", "booking_status")
    v = bookings.filter("phone_valid")
    facts = v.groupBy("studio_id", "phone").agg(
        F.count_if(F.col("status") == "visited").alias("visits"),
        F.sum(F.when(F.col("status") == "visited", F.col("amount"))).alias("revenue"),
        F.collect_set("status").alias("statuses_seen"))
    j = l.join(r, F.col("status_id") == F.col("rule_status"))
    j = j.filter((F.col("rule_studio") == "all") | (F.col("rule_studio") == F.col("studio_id")))
    j = j.join(facts, ["studio_id", "phone"], "left")
    statuses = F.col("c.statuses")
    paid = F.coalesce(F.col("revenue"), F.lit(0))
    visits = F.coalesce(F.col("visits"), F.lit(0).cast("bigint"))
    age = F.datediff(_asof(as_of), F.col("created_at"))
    ct = F.col("check_type")
    seen = F.coalesce(F.col("statuses_seen"), F.array().cast("array<string>"))
    failed = (F.when(ct == "phone_exists", ~F.exists(seen, lambda x: F.array_contains(statuses, x)))
              .when(ct == "status_match", F.col("booking_status").isNotNull()
                    & ~F.array_contains(statuses, F.col("booking_status")))
              .when(ct == "sum_compare", paid < F.col("price"))
              .when(ct == "visit_count", visits >= F.col("c.min_visits"))
              .when(ct == "timeout", F.col("closed_at").isNull() & (age > F.col("c.timeout_days")))
              .otherwise(F.lit(False)))
    detail = (F.when(ct == "phone_exists", F.lit("missing"))
              .when(ct == "status_match", F.col("booking_status"))
              .when(ct == "sum_compare", (paid - F.col("price")).cast("string"))
              .when(ct == "visit_count", visits.cast("string"))
              .when(ct == "timeout", age.cast("string")))
    return j.filter(failed).select("studio_id", F.col("lead_id").cast("string").alias("entity_id"), "rule_id",
                                   "severity", detail.alias("detail"))


def rule_alerts(violations: DataFrame, rules: DataFrame) -> DataFrame:
    """V-15: one alert row per failed rule with its template filled in."""
    r = bounded_broadcast(rules.select("rule_id", "alert_template"))
    j = violations.join(r, "rule_id")
    text = F.replace(F.replace(F.col("alert_template"), F.lit("{entity}"), F.col("entity_id")),
                     F.lit("{detail}"), F.coalesce(F.col("detail"), F.lit("")))
    return j.select("studio_id", "entity_id", "rule_id", "severity", text.alias("message"))


def check_attempts(events: DataFrame, stage: str, min_attempts: int = 2, max_attempts: int = 3) -> DataFrame:
    """V-04 attempts (ours): entries of a lead into ``stage`` counted from its events.

    ``min_attempts`` or more entries -> WARNING; ``max_attempts`` or more -> the
    lead should move to closed-lost (detail 'close').  One aggregate per lead.
    """
    e = events.filter(F.col("stage_to") == stage)
    g = e.groupBy("studio_id", "source", "lead_id").agg(F.count(F.lit(1)).alias("attempts"))
    g = g.filter(F.col("attempts") >= min_attempts)
    return g.select("studio_id", F.col("lead_id").cast("string").alias("entity_id"), F.lit("A06").alias("rule_id"),
                    F.lit("WARNING").alias("severity"),
                    F.when(F.col("attempts") >= max_attempts, F.concat(F.lit("close:"), F.col("attempts").cast("string")))
                    .otherwise(F.col("attempts").cast("string")).alias("detail"))
