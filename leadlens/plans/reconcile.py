"""Reconciliation between sources (R-01 .. R-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens import config as C
from leadlens.functions import safe_div, severity
from leadlens.operators.grouping import with_consolidated


def mismatch_pct(a: Column | str, b: Column | str) -> Column:
    """100 * |a - b| / greatest(a, b), NULL when both are 0 (R-02)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.round(F.lit(100.0) * safe_div(F.abs(a - b), F.greatest(a, b)), 2)


def with_severity(df: DataFrame, pct_col: str) -> DataFrame:
    """R-04 band plus the immediate-escalation flag (A-20, > 20%)."""
    return (df.withColumn("severity", severity(pct_col))
            .withColumn("escalate", F.coalesce(F.col(pct_col) > C.ESCALATE_ABOVE, F.lit(False))))


def reconcile_bookings(leads_booked: DataFrame) -> DataFrame:
    """R-01: appointment leads without a booking, per studio and 'all'."""
    appt = F.col("status_id") == C.STATUS_APPOINTMENT
    g = with_consolidated(leads_booked, "studio_id", [], [
        F.count_if(appt).alias("appointments"),
        F.count_if(appt & F.col("yc_booking_id").isNull()).alias("unmatched")])
    g = g.withColumn("mismatch_pct", F.round(F.lit(100.0) * safe_div("unmatched", "appointments"), 2))
    return with_severity(g, "mismatch_pct")


def compare_totals(a: DataFrame, b: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Full-outer comparison of two aggregated sides: ``<m>_a``, ``<m>_b``, ``<m>_pct``.

    Keys are compared null-safely (a NULL channel meets a NULL channel).
    """
    a2 = a.select(*keys, *[F.col(m).alias(m + "_a") for m in measures])
    b2 = b.select(*[F.col(k).alias("_b_" + k) for k in keys], *[F.col(m).alias(m + "_b") for m in measures])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col("_b_" + k))
        cond = c if cond is None else cond & c
    j = a2.join(b2, cond, "full_outer")
    out = [F.coalesce(F.col(k), F.col("_b_" + k)).alias(k) for k in keys]
    for m in measures:
        va = F.coalesce(F.col(m + "_a"), F.lit(0))
        vb = F.coalesce(F.col(m + "_b"), F.lit(0))
        out += [va.alias(m + "_a"), vb.alias(m + "_b"), mismatch_pct(va, vb).alias(m + "_pct")]
    return j.select(*out)


def reconcile_ad_leads(leads: DataFrame, ad_leads: DataFrame) -> DataFrame:
    """R-02: CRM vs ad-sheet lead counts per studio and month."""
    a = leads.groupBy("studio_id", F.trunc("created_at", "month").alias("month")).agg(F.count(F.lit(1)).alias("leads"))
    b = ad_leads.groupBy("studio_id", F.trunc("created_at", "month").alias("month")).agg(F.count(F.lit(1)).alias("leads"))
    return with_severity(compare_totals(a, b, ["studio_id", "month"], ["leads"]), "leads_pct")


def reconcile_sales(bookings: DataFrame, leads: DataFrame) -> DataFrame:
    """R-03: booking-side visits and sales vs the CRM's closed-won deals per studio and month.

    (The fixtures carry no summary sheet of sales; the CRM's won deals stand in.)
    """
    v = bookings.filter(F.col("status") == "visited")
    a = v.groupBy("studio_id", F.trunc("visit_ts", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("visits"), F.sum("amount").cast("double").alias("sales"))
    won = leads.filter(F.col("status_id").isin(C.STATUS_SUCCESS, C.STATUS_DEPOSIT) & F.col("closed_at").isNotNull())
    b = won.groupBy("studio_id", F.trunc("closed_at", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("visits"), F.sum("price").cast("double").alias("sales"))
    return compare_totals(a, b, ["studio_id", "month"], ["visits", "sales"])


def _matchable(df: DataFrame) -> DataFrame:
    return df.filter(F.col("phone_valid")).select("studio_id", "phone").distinct()


def advanced_without_booking(leads: DataFrame, bookings: DataFrame) -> DataFrame:
    """R-05: leads in an advanced status with no booking for their phone (NOT EXISTS)."""
    adv = leads.filter(F.col("status_id").isin(*C.ADVANCED_STATUSES))
    return adv.join(_matchable(bookings), ["studio_id", "phone"], "left_anti")


def booking_without_lead(bookings: DataFrame, leads: DataFrame) -> DataFrame:
    """R-06: bookings whose phone has no CRM lead in any studio."""
    lp = leads.filter(F.col("phone_valid")).select("phone").distinct()
    return bookings.join(lp, "phone", "left_anti")


def studio_mismatch(leads_with_derived: DataFrame, bookings: DataFrame) -> DataFrame:
    """R-07: the booking studio differs from the studio derived for the CRM lead (N-09).

    Bookings are first reduced to distinct (phone, studio), so a lead meets at
    most one row per studio.
    """
    bs = bookings.filter(F.col("phone_valid")).select("phone", F.col("studio_id").alias("booking_studio")).distinct()
    l = leads_with_derived.filter(F.col("derived_studio").isNotNull() & F.col("phone_valid"))
    j = l.join(bs, "phone")
    return j.filter(F.col("booking_studio") != F.col("derived_studio")).select(
        "studio_id", "lead_id", "derived_studio", "booking_studio")


def attendance_mismatch(leads_booked: DataFrame) -> DataFrame:
    """R-08: (no-show AND status <> no-show) OR (visited AND status NOT IN (success, deposit)).

    Evaluated on the lead's own booking (N-12); a lead without one is not a mismatch.
    """
    bs, st = F.col("booking_status"), F.col("status_id")
    cond = (((bs == "no_show") & (st != C.STATUS_NO_SHOW))
            | ((bs == "visited") & ~st.isin(*C.ATTENDED_OK_STATUSES)))
    return leads_booked.filter(F.coalesce(cond, F.lit(False)))


def reconcile_grid(leads: DataFrame, ad_leads: DataFrame) -> DataFrame:
    """R-09: lead ids of both sides by studio, date and channel: in both / only one side."""
    a = leads.select("studio_id", "lead_id", F.to_date("created_at").alias("d_a"), F.col("utm_source").alias("ch_a"),
                     F.lit(1).alias("in_crm"))
    b = ad_leads.select("studio_id", F.col("ad_lead_id").alias("lead_id"), F.to_date("created_at").alias("d_b"),
                        F.col("channel").alias("ch_b"), F.lit(1).alias("in_sheet"))
    j = a.join(b, ["studio_id", "lead_id"], "full_outer")
    j = j.select("studio_id", F.coalesce("d_a", "d_b").alias("lead_date"),
                 F.coalesce("ch_a", "ch_b").alias("channel"),
                 F.col("in_crm").isNotNull().alias("a"), F.col("in_sheet").isNotNull().alias("b"))
    return j.groupBy("studio_id", "lead_date", "channel").agg(
        F.count_if(F.col("a") & F.col("b")).alias("in_both"),
        F.count_if(F.col("a") & ~F.col("b")).alias("crm_only"),
        F.count_if(~F.col("a") & F.col("b")).alias("sheet_only"))


PRESENCE = {1: "crm", 2: "booking", 3: "crm+booking", 4: "sheet", 5: "crm+sheet", 6: "booking+sheet", 7: "all three"}


def presence_grid(leads_booked: DataFrame, bookings: DataFrame, ad_leads: DataFrame) -> DataFrame:
    """R-09 over three key sets: per studio, date, channel and presence class (which of CRM, bookings
    and sheet have the lead) the number of leads, and of those present in CRM and sheet the
    ones that disagree on the date and on the channel.

    The three sets are tagged with a bit, put under each other and grouped by key once: the
    bits of a key are its presence class.  A booking stands under the lead that it was matched
    to, one without a lead under its own id.  Date and channel are the CRM's, else the sheet's,
    else the booking's date; null channels agree with each other.
    """
    none = F.lit(None)
    key = lambda mark, c: F.concat(F.lit(mark), F.col(c).cast("string")).alias("key")
    tagged = lambda d, k, bit, day, ch: d.select(
        "studio_id", k, F.lit(bit).alias("bit"), F.to_date(day).alias("d"), ch.cast("string").alias("ch"))
    matched = leads_booked.filter(F.col("yc_booking_id").isNotNull())
    alone = bookings.join(matched.select(F.col("yc_booking_id").alias("booking_id")).distinct(), "booking_id", "left_anti")
    u = (tagged(leads_booked, key("l", "lead_id"), 1, F.col("created_at"), F.col("utm_source"))
         .unionByName(tagged(matched, key("l", "lead_id"), 2, F.col("booking_ts"), none))
         .unionByName(tagged(alone, key("b", "booking_id"), 2, F.col("visit_ts"), none))
         .unionByName(tagged(ad_leads, key("l", "ad_lead_id"), 4, F.col("created_at"), F.col("channel"))))
    of = lambda bit, c: F.max(F.when(F.col("bit") == bit, F.col(c)))
    k = u.groupBy("studio_id", "key").agg(
        F.bit_or("bit").alias("mask"), of(1, "d").alias("d1"), of(2, "d").alias("d2"), of(4, "d").alias("d4"),
        of(1, "ch").alias("c1"), of(4, "ch").alias("c4"))
    both = F.col("mask").bitwiseAND(5) == 5
    names = F.create_map(*[F.lit(x) for m in PRESENCE.items() for x in m])
    g = k.groupBy("studio_id", F.coalesce("d1", "d4", "d2").alias("lead_date"), F.coalesce("c1", "c4").alias("channel"), "mask").agg(
        F.count(F.lit(1)).alias("leads"), F.count_if(both & ~F.col("d1").eqNullSafe(F.col("d4"))).alias("date_differs"),
        F.count_if(both & ~F.col("c1").eqNullSafe(F.col("c4"))).alias("channel_differs"))
    return g.select("studio_id", "lead_date", "channel", names[F.col("mask")].alias("presence"), "leads", "date_differs",
                    "channel_differs")


def reconcile_totals(grid: DataFrame) -> DataFrame:
    """R-10: totals of the grid per studio and across studios, with mismatch % and severity."""
    g = with_consolidated(grid, "studio_id", [], [
        F.sum("in_both").cast("bigint").alias("in_both"), F.sum("crm_only").cast("bigint").alias("crm_only"),
        F.sum("sheet_only").cast("bigint").alias("sheet_only")])
    tot = F.col("in_both") + F.col("crm_only") + F.col("sheet_only")
    g = g.withColumn("mismatch_pct", F.round(F.lit(100.0) * safe_div(F.col("crm_only") + F.col("sheet_only"), tot), 2))
    return with_severity(g, "mismatch_pct")
