"""Snapshot metrics (M-01 .. M-31).

Ratios use ``try_divide`` (NULL on a zero denominator) and are rounded in
the same place on every path.  Money is summed as DECIMAL(18,2) and only the
final value is cast to double, so sums do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlens import config as C
from leadlens.functions import kpi_status, pct, romi, safe_div, week_start
from leadlens.operators.grouping import with_consolidated
from leadlens.operators.selection import exact_quantiles, same_keys


def _money(col: str):
    return F.sum(F.col(col).cast("decimal(18,2)"))


def lead_to_booking(leads_booked: DataFrame) -> DataFrame:
    """M-02 + M-05 + M-10: leads, booked leads and conversion % per studio, source, day,
    with the consolidated ``studio_id='all'`` rows from the same pass."""
    g = with_consolidated(
        leads_booked, "studio_id", ["utm_source", "lead_date"],
        [F.count(F.lit(1)).alias("leads"),
         F.count_if(F.col("yc_booking_id").isNotNull()).alias("bookings")])
    return g.withColumn("conversion", pct("bookings", "leads"))


def daily_summary(leads_booked: DataFrame, bookings: DataFrame) -> DataFrame:
    """M-01: one row per studio x date x channel (plus channel 'all' and studio 'all').

    A booking has the channel of the lead it was matched to (of several, the earliest lead);
    one that no lead was matched to is 'unknown'.

    Lead measures come from the lead side, visit measures from bookings; each
    side is aggregated before the (full outer) join, so nothing fans out.
    """
    lead_side = leads_booked.select(
        "studio_id", F.col("lead_date").alias("summary_date"),
        F.coalesce(F.col("utm_source"), F.lit("unknown")).alias("channel"),
        "yc_booking_id", "booking_status", "phone_valid")
    sets_l = [["studio_id", "summary_date", "channel"], ["studio_id", "summary_date"],
              ["summary_date", "channel"], ["summary_date"]]
    l_agg = (lead_side.groupingSets([[F.col(c) for c in s] for s in sets_l],
                                    "studio_id", "summary_date", "channel")
             .agg(F.count(F.lit(1)).alias("leads"),
                  F.count_if(F.col("yc_booking_id").isNotNull()).alias("bookings"),
                  F.count_if(F.col("booking_status") == "visited").alias("booked_visited"),
                  F.count_if(~F.col("phone_valid")).alias("invalid_phones"),
                  F.grouping("studio_id").alias("_gs"), F.grouping("channel").alias("_gc")))
    origin = leads_booked.filter(F.col("yc_booking_id").isNotNull()).groupBy(F.col("yc_booking_id").alias("booking_id")).agg(
        F.min(F.struct("created_at", "lead_id", "utm_source")).alias("_l"))
    b = bookings.select("booking_id", "studio_id", F.col("visit_date").alias("summary_date"), "status", "amount").join(
        origin, "booking_id", "left").withColumn("channel", F.coalesce("_l.utm_source", F.lit("unknown")))
    b_agg = (b.groupingSets([[F.col(c) for c in s] for s in sets_l], "studio_id", "summary_date", "channel")
             .agg(F.count(F.lit(1)).alias("visits_booked"),
                  F.count_if(F.col("status") == "visited").alias("visits"),
                  F.count_if(F.col("status") == "no_show").alias("no_shows"),
                  F.count_if(F.col("status") == "canceled").alias("cancellations"),
                  _money("amount").alias("_rev"),
                  F.sum(F.when(F.col("status") == "visited", F.col("amount").cast("decimal(18,2)"))).alias("_vrev"),
                  F.grouping("studio_id").alias("_gs"), F.grouping("channel").alias("_gc")))
    fix = lambda df: df.withColumn("studio_id", F.when(F.col("_gs") == 1, "all").otherwise(F.col("studio_id"))).withColumn(
        "channel", F.when(F.col("_gc") == 1, "all").otherwise(F.col("channel"))).drop("_gs", "_gc")
    j = fix(l_agg).join(fix(b_agg), ["studio_id", "summary_date", "channel"], "full_outer")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    return j.select(
        "studio_id", "summary_date", "channel",
        zero("leads").alias("leads"), zero("bookings").alias("bookings"),
        zero("booked_visited").alias("booked_visited"), zero("invalid_phones").alias("invalid_phones"),
        zero("visits_booked").alias("visits_booked"), zero("visits").alias("visits"),
        zero("no_shows").alias("no_shows"), zero("cancellations").alias("cancellations"),
        F.coalesce(F.col("_rev"), F.lit(0)).cast("double").alias("revenue"),
        F.coalesce(F.col("_vrev"), F.lit(0)).cast("double").alias("visit_revenue"),
        pct("bookings", "leads").alias("lead_to_booking"),
        pct("visits", "visits_booked").alias("booking_to_visit"),
        pct("no_shows", "visits_booked").alias("no_show_rate"),
        pct("cancellations", "visits_booked").alias("cancellation_rate"))


WON = [C.STATUS_DEPOSIT, C.STATUS_SUCCESS, C.STATUS_SINGLE_VISITS]


def _month(col: str):
    return F.trunc(F.col(col), "month")


def booking_to_visit(bookings: DataFrame) -> DataFrame:
    """M-03: visited / all bookings per studio and month, plus 'all'."""
    b = bookings.withColumn("month", _month("visit_ts"))
    g = with_consolidated(b, "studio_id", ["month"], [
        F.count(F.lit(1)).alias("booked"), F.count_if(F.col("status") == "visited").alias("visits")])
    return g.withColumn("booking_to_visit", pct("visits", "booked"))


def lead_to_abonement(leads_booked: DataFrame) -> DataFrame:
    """M-04: won deals among all leads and among visited leads, per studio and month."""
    won = F.col("status_id").isin(*WON)
    vis = F.col("booking_status") == "visited"
    l = leads_booked.withColumn("month", _month("created_at"))
    g = with_consolidated(l, "studio_id", ["month"], [
        F.count(F.lit(1)).alias("leads"), F.count_if(vis).alias("visited"),
        F.count_if(won).alias("abonements"), F.count_if(won & vis).alias("abon_visited")])
    return (g.withColumn("lead_to_abonement", pct("abonements", "leads"))
            .withColumn("visit_to_abon", pct("abon_visited", "visited")))


def client_visits(bookings: DataFrame) -> DataFrame:
    """Visited bookings per client (studio + valid phone)."""
    v = bookings.filter((F.col("status") == "visited") & F.col("phone_valid"))
    return v.groupBy("studio_id", "phone").agg(F.count(F.lit(1)).alias("visits"),
                                               F.sum("amount").alias("revenue"))


def repeat_rate(bookings: DataFrame) -> DataFrame:
    """M-06: clients with two or more visits / clients with a visit."""
    cv = client_visits(bookings)
    g = with_consolidated(cv, "studio_id", [], [
        F.count(F.lit(1)).alias("clients"), F.count_if(F.col("visits") >= 2).alias("repeat_clients")])
    return g.withColumn("repeat_purchase_rate", pct("repeat_clients", "clients"))


def no_show_rate(bookings: DataFrame) -> DataFrame:
    """M-07: no-shows / bookings by day, week, studio and master in one Expand."""
    b = bookings.withColumn("week", week_start("visit_ts"))
    sets = [["studio_id", "visit_date"], ["studio_id", "week"], ["studio_id"], ["studio_id", "master_id"]]
    g = (b.groupingSets([[F.col(c) for c in s] for s in sets], "studio_id", "visit_date", "week", "master_id")
         .agg(F.count(F.lit(1)).alias("booked"), F.count_if(F.col("status") == "no_show").alias("no_shows"),
              F.grouping("visit_date").alias("_gd"), F.grouping("week").alias("_gw"),
              F.grouping("master_id").alias("_gm")))
    grain = (F.when(F.col("_gd") == 0, "day").when(F.col("_gw") == 0, "week")
             .when(F.col("_gm") == 0, "master").otherwise("studio"))
    return g.select("studio_id", grain.alias("grain"), F.coalesce("visit_date", "week").alias("period_start"),
                    "master_id", "booked", "no_shows", pct("no_shows", "booked").alias("no_show_rate"))


def cancel_rate(bookings: DataFrame) -> DataFrame:
    """M-08: cancellations / bookings per studio and month."""
    b = bookings.withColumn("month", _month("visit_ts"))
    g = with_consolidated(b, "studio_id", ["month"], [
        F.count(F.lit(1)).alias("booked"), F.count_if(F.col("status") == "canceled").alias("cancellations")])
    return g.withColumn("cancellation_rate", pct("cancellations", "booked"))


def first_visit_no_show(bookings: DataFrame) -> DataFrame:
    """M-09: share of no-shows among clients' first bookings, of any status."""
    b = bookings.filter(F.col("phone_valid"))
    first = b.groupBy("studio_id", "phone").agg(F.min(F.struct("visit_ts", "booking_id", "status")).alias("_f"))
    g = with_consolidated(first, "studio_id", [], [
        F.count(F.lit(1)).alias("first_bookings"),
        F.count_if(F.col("_f.status") == "no_show").alias("first_no_shows")])
    return g.withColumn("first_visit_no_show_rate", pct("first_no_shows", "first_bookings"))


def channel_economics(leads_booked: DataFrame, spend: DataFrame) -> DataFrame:
    """M-11 / M-13 / M-14 / M-22: per studio, month and channel: leads, bookings,
    buyers, revenue and spend, then CPL, CAC and ROMI.  Both sides are
    aggregated before the full outer join (no fan-out)."""
    l = leads_booked.select(
        "studio_id", _month("created_at").alias("month"),
        F.coalesce("utm_source", F.lit("unknown")).alias("channel"), "yc_booking_id", "status_id",
        F.when(F.col("booking_status") == "visited", F.col("booking_amount")).alias("rev"))
    la = l.groupBy("studio_id", "month", "channel").agg(
        F.count(F.lit(1)).alias("leads"), F.count_if(F.col("yc_booking_id").isNotNull()).alias("bookings"),
        F.count_if(F.col("status_id").isin(*WON)).alias("buyers"), F.sum("rev").alias("_rev"))
    sa = (spend.select("studio_id", _month("expense_date").alias("month"),
                       F.coalesce("channel", F.lit("unknown")).alias("channel"), "amount")
          .groupBy("studio_id", "month", "channel").agg(F.sum("amount").alias("_spend")))
    j = la.join(sa, ["studio_id", "month", "channel"], "full_outer")
    z = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint"))
    j = j.select("studio_id", "month", "channel", z("leads").alias("leads"), z("bookings").alias("bookings"),
                 z("buyers").alias("buyers"),
                 F.coalesce(F.col("_rev"), F.lit(0)).cast("double").alias("revenue"),
                 F.coalesce(F.col("_spend"), F.lit(0)).cast("double").alias("spend"))
    return (j.withColumn("cpl", F.round(safe_div("spend", "leads"), 2))
            .withColumn("cac", F.round(safe_div("spend", "buyers"), 2))
            .withColumn("romi", romi("revenue", "spend")))


def first_lead(leads: DataFrame) -> DataFrame:
    """The first CRM lead of each client (studio + valid phone): time and channel."""
    f = leads.filter("phone_valid").groupBy("studio_id", "phone").agg(
        F.min(F.struct("created_at", "lead_id", "utm_source")).alias("_f"))
    return f.select("studio_id", "phone", F.col("_f.created_at").alias("first_seen_at"),
                    F.coalesce(F.col("_f.utm_source"), F.lit("unknown")).alias("channel"))


def ltv(leads: DataFrame, bookings: DataFrame, months: int = C.LTV_MONTHS) -> DataFrame:
    """M-12: mean visit revenue per client in the first ``months`` months after the
    first lead (half open), per studio and channel; clients without visits count."""
    cl = first_lead(leads)
    v = bookings.filter((F.col("status") == "visited") & F.col("phone_valid")).select(
        "studio_id", "phone", "visit_ts", "amount")
    j = v.join(cl, ["studio_id", "phone"])
    j = j.filter((F.col("visit_ts") >= F.col("first_seen_at"))
                 & (F.col("visit_ts") < F.timestamp_add("MONTH", F.lit(months), F.col("first_seen_at"))))
    rev = j.groupBy("studio_id", "phone").agg(F.sum("amount").alias("rev"))
    c = cl.join(rev, ["studio_id", "phone"], "left")
    g = c.groupBy("studio_id", "channel").agg(F.count(F.lit(1)).alias("clients"),
                                              F.coalesce(F.sum("rev"), F.lit(0)).alias("_r"))
    return g.select("studio_id", "channel", "clients", F.col("_r").cast("double").alias("revenue"),
                    F.round(safe_div(F.col("_r"), F.col("clients")), 2).alias("ltv"))


def weekly_funnel(leads_staged: DataFrame) -> DataFrame:
    """M-15: leads per studio, week and stage; conversion from the stage before it in the
    dimension's order (none if that stage has no leads; 'unknown' has no order and is no
    base) and mean hours from creation to last update."""
    l = leads_staged.withColumn("week_start", week_start("created_at"))
    g = l.groupBy("studio_id", "week_start", "stage_code", "stage_order").agg(
        F.count(F.lit(1)).alias("lead_count"),
        F.round(F.avg(F.timestamp_diff("MICROSECOND", F.col("created_at"), F.col("updated_at")))
                / F.lit(3_600_000_000.0), 4).alias("avg_hours"))
    # the base is the row before only if it is the stage before: at most a row a stage
    w = Window.partitionBy("studio_id", "week_start").orderBy("stage_order")
    base = F.when(F.lag("stage_order").over(w) == F.col("stage_order") - 1, F.lag("lead_count").over(w))
    return g.withColumn("conversion", pct(F.col("lead_count"), base))


def trend(leads: DataFrame, unit: str = "week") -> DataFrame:
    """M-16: leads per studio on a dense week (or month) grid with the change from
    the previous period; empty periods are 0, not skipped."""
    p = week_start("created_at") if unit == "week" else _month("created_at")
    step = F.expr("INTERVAL 7 DAYS") if unit == "week" else F.expr("INTERVAL 1 MONTH")
    c = leads.groupBy("studio_id", p.alias("period")).agg(F.count(F.lit(1)).alias("leads"))
    rng = c.groupBy("studio_id").agg(F.min("period").alias("p0"), F.max("period").alias("p1"))
    grid = rng.select("studio_id", F.explode(F.sequence("p0", "p1", step)).alias("period"))
    g = grid.join(c, ["studio_id", "period"], "left").withColumn("leads", F.coalesce("leads", F.lit(0).cast("bigint")))
    w = Window.partitionBy("studio_id").orderBy("period")
    g = g.withColumn("prev_leads", F.lag("leads").over(w))
    return (g.withColumn("delta", F.col("leads") - F.col("prev_leads"))
            .withColumn("pct_change", pct(F.col("leads") - F.col("prev_leads"), F.col("prev_leads"))))


def visits_of_clients(bookings: DataFrame, as_of: str | None = None) -> DataFrame:
    v = bookings.filter((F.col("status") == "visited") & F.col("phone_valid"))
    if as_of:
        v = v.filter(F.col("visit_date") <= F.lit(as_of).cast("date"))
    return v


def _client_months(bookings: DataFrame) -> DataFrame:
    """A row per client and month with a visit: revenue, whether it was the client's first month
    (``is_new``), whether the month before it had one too (``stayed``), and whether the next has
    none (``leaves``).  Visits are summed by client and month first, so a client's window has a
    row a month."""
    cm = visits_of_clients(bookings).groupBy("studio_id", "phone", _month("visit_ts").alias("month")).agg(
        F.sum("amount").alias("rev"))
    w = Window.partitionBy("studio_id", "phone").orderBy("month")
    prev, after = F.lag("month").over(w), F.lead("month").over(w)
    return cm.select("studio_id", "month", "rev", F.min("month").over(Window.partitionBy("studio_id", "phone")).alias("cohort_month"),
                     prev.isNull().alias("is_new"), F.coalesce(prev == F.add_months("month", -1), F.lit(False)).alias("stayed"),
                     (~F.coalesce(after == F.add_months("month", 1), F.lit(False))).alias("leaves"))


def _flows(cm: DataFrame) -> DataFrame:
    """Client-months as flows: a row in the month itself and, where a run of months ends, one
    ``lost`` in the month after it."""
    zero = F.lit(0)
    return cm.select("studio_id", "cohort_month", F.explode(F.filter(F.array(
        F.struct("month", F.lit(1).alias("active"), F.col("is_new").cast("int").alias("new"),
                 F.col("stayed").cast("int").alias("retained"),
                 (~F.col("is_new") & ~F.col("stayed")).cast("int").alias("returned"), zero.alias("lost"), F.col("rev")),
        F.when(F.col("leaves"), F.struct(
            F.add_months("month", 1).alias("month"), zero.alias("active"), zero.alias("new"), zero.alias("retained"),
            zero.alias("returned"), F.lit(1).alias("lost"), F.lit(0).cast("decimal(18,2)").alias("rev")))),
        lambda x: x.isNotNull())).alias("f")).select("studio_id", "cohort_month", "f.*")


_COUNTS = ["active", "new", "retained", "returned", "lost"]


def _flow_sums() -> list:
    return [F.sum(c).cast("bigint").alias(c) for c in _COUNTS] + [F.sum("rev").alias("rev")]


def _on_grid(grid: DataFrame, flows: DataFrame, keys: list[str]) -> DataFrame:
    return grid.join(flows, keys, "left").fillna(0, _COUNTS).withColumn("rev", F.coalesce("rev", F.lit(0)))


def monthly_cohorts(bookings: DataFrame, spend: DataFrame) -> DataFrame:
    """M-17: cohorts by first-visit month on a dense month grid, per studio and 'all'.

    For each month from the cohort's own to the studio's last one with a visit: ``active`` clients,
    ``returned`` after a gap, ``lost`` (active in the month before, not in this one),
    revenue, ``ltv`` (revenue so far per client), ``cac`` (ad spend of the cohort's month per
    client) and ``romi`` of that spend so far.  ``clients`` is the size of the cohort.
    """
    flows = with_consolidated(_flows(_client_months(bookings)), "studio_id", ["cohort_month", "month"], _flow_sums())
    w = Window.partitionBy("studio_id", "cohort_month")
    last = flows.filter("active > 0").groupBy("studio_id").agg(F.max("month").alias("last"))
    size = flows.filter("new > 0").select("studio_id", "cohort_month", F.col("new").alias("clients"))
    cost = with_consolidated(spend.withColumn("cohort_month", _month("expense_date")), "studio_id", ["cohort_month"],
                             [F.sum("amount").alias("spend")])
    grid = size.join(last, "studio_id").join(cost, ["studio_id", "cohort_month"], "left").select(
        "studio_id", "cohort_month", "clients", "spend",
        F.explode(F.sequence("cohort_month", "last", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    g = _on_grid(grid, flows, ["studio_id", "cohort_month", "month"])
    so_far = F.sum("rev").over(w.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return g.withColumn("_so_far", so_far).select(
        "studio_id", "cohort_month", "month", F.months_between("month", "cohort_month").cast("int").alias("months_since"),
        "clients", "active", "returned", "lost", F.col("rev").cast("double").alias("revenue"),
        safe_div("_so_far", "clients").alias("ltv"), safe_div("spend", "clients").alias("cac"),
        (F.lit(100.0) * safe_div(F.col("_so_far").cast("double") - F.col("spend").cast("double"), "spend")).alias("romi"))


def _month_of_min(col: str):
    return F.trunc(F.min(F.col(col)), "month")


def activity_segments(bookings: DataFrame, as_of: str) -> DataFrame:
    """M-18: per client: new (first visit within 30 days), returned (active after a
    gap of more than 90 days), active (< 30 days), passive (30..90), lost (> 90)."""
    v = visits_of_clients(bookings, as_of)
    c = v.groupBy("studio_id", "phone").agg(F.min("visit_date").alias("first_visit"),
                                            F.max("visit_date").alias("last_visit"))
    prev = (v.join(c.select("studio_id", "phone", "last_visit"), ["studio_id", "phone"])
            .filter(F.col("visit_date") < F.col("last_visit"))
            .groupBy("studio_id", "phone").agg(F.max("visit_date").alias("prev_visit")))
    c = c.join(prev, ["studio_id", "phone"], "left")
    a = F.lit(as_of).cast("date")
    days = F.datediff(a, F.col("last_visit"))
    seg = (F.when(F.col("first_visit") >= F.date_sub(a, C.ACTIVE_DAYS), "new")
           .when((days < C.ACTIVE_DAYS) & (F.datediff("last_visit", "prev_visit") > C.RETENTION_DAYS), "returned")
           .when(days < C.ACTIVE_DAYS, "active")
           .when(days <= C.RETENTION_DAYS, "passive")
           .otherwise("lost"))
    return c.withColumn("segment", seg).withColumn("days_since_visit", days)


def retention(bookings: DataFrame) -> DataFrame:
    """M-19: per studio (and 'all') and month of a dense grid: active clients, those retained from
    the month before, retention = retained / active then, churn = 100 - retention, and the mean
    LTV (revenue of all months so far per client seen so far).  A month in which every client
    stayed away has a row with churn 100."""
    flows = with_consolidated(_flows(_client_months(bookings)), "studio_id", ["month"], _flow_sums())
    grid = flows.filter("active > 0").groupBy("studio_id").agg(F.min("month").alias("a"), F.max("month").alias("b")).select(
        "studio_id", F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    g = _on_grid(grid, flows, ["studio_id", "month"])
    w = Window.partitionBy("studio_id").orderBy("month")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g = g.withColumn("prev_active", F.lag("active").over(w)).withColumn("retention", pct("retained", "prev_active"))
    return g.select("studio_id", "month", "active", "retained", "prev_active", "retention",
                    F.round(F.lit(100.0) - F.col("retention"), 1).alias("churn"),
                    F.round(safe_div(F.sum("rev").over(so_far), F.sum("new").over(so_far)), 2).alias("mean_ltv"))


def funnel_kpis(leads_booked: DataFrame) -> DataFrame:
    """M-20: lead->visit, visit->purchase, S05/S04 no-show, sales cycle, revenue per lead."""
    vis = F.col("booking_status") == "visited"
    won = F.col("status_id").isin(*WON)
    succ = F.col("status_id") == C.STATUS_SUCCESS
    g = with_consolidated(leads_booked, "studio_id", [], [
        F.count(F.lit(1)).alias("leads"), F.count_if(vis).alias("visited"),
        F.count_if(vis & won).alias("purchases"),
        F.count_if(F.col("status_id") == C.STATUS_APPOINTMENT).alias("s04"),
        F.count_if(F.col("status_id") == C.STATUS_NO_SHOW).alias("s05"),
        F.avg(F.when(succ, F.timestamp_diff("MICROSECOND", F.col("created_at"), F.col("closed_at")))).alias("_cyc"),
        F.sum(F.when(succ, F.col("price"))).alias("_rev")])
    return g.select(
        "studio_id", "leads", "visited", "purchases",
        pct("visited", "leads").alias("lead_to_visit"),
        pct("purchases", "visited").alias("visit_to_purchase"),
        pct("s05", "s04").alias("funnel_no_show_rate"),
        F.round(F.col("_cyc") / F.lit(86_400_000_000.0), 2).alias("sales_cycle_days"),
        F.round(safe_div(F.col("_rev"), F.col("leads")), 2).alias("revenue_per_lead"))


def kpi_report(leads_booked: DataFrame, bookings: DataFrame) -> DataFrame:
    """M-21: the three conversion KPIs per studio with status against their norms."""
    l = with_consolidated(leads_booked, "studio_id", [], [
        F.count(F.lit(1)).alias("leads"), F.count_if(F.col("yc_booking_id").isNotNull()).alias("booked"),
        F.count_if(F.col("status_id").isin(*WON)).alias("won")])
    b = with_consolidated(bookings, "studio_id", [], [
        F.count(F.lit(1)).alias("bookings"), F.count_if(F.col("status") == "visited").alias("visits")])
    j = l.join(b, "studio_id", "full_outer")
    out = j.select("studio_id", pct("booked", "leads").alias("lead_to_booking"),
                   pct("visits", "bookings").alias("booking_to_visit"),
                   pct("won", "leads").alias("lead_to_abonement"))
    for k, (lo, hi) in C.KPI_NORMS.items():
        out = out.withColumn(k + "_status", kpi_status(k, lo, hi))
    return out


def abonement_ranking(bookings: DataFrame, types: DataFrame) -> DataFrame:
    """M-23: subscriptions sold per studio and type: revenue, share %, mean check, rank.

    The share and rank windows run on the aggregated frame (one row per type).
    """
    q = (bookings.filter((F.col("quantity") >= 40) & (F.col("status") == "visited"))
         .join(types, "service_id"))
    g = q.groupBy("studio_id", "service_type").agg(F.count(F.lit(1)).alias("sold"), F.sum("amount").alias("_r"))
    w = Window.partitionBy("studio_id")
    wr = Window.partitionBy("studio_id").orderBy(F.desc("_r"))
    g = (g.withColumn("revenue", F.col("_r").cast("double"))
         .withColumn("share_pct", pct(F.col("_r"), F.sum("_r").over(w)))
         .withColumn("mean_check", F.round(safe_div("revenue", "sold"), 2))
         .withColumn("rank", F.rank().over(wr)))
    return g.withColumn("is_top3", F.col("rank") <= 3).drop("_r")


def new_clients_by_master(bookings: DataFrame) -> DataFrame:
    """M-24: clients whose first visit falls in a week, by master."""
    v = visits_of_clients(bookings)
    f = v.groupBy("studio_id", "phone").agg(F.min(F.struct("visit_ts", "booking_id", "master_id")).alias("_f"))
    return (f.groupBy("studio_id", week_start("_f.visit_ts").alias("week_start"),
                      F.col("_f.master_id").alias("master_id"))
            .agg(F.count(F.lit(1)).alias("new_clients")))


def traffic_quality(leads_booked: DataFrame, bookings: DataFrame) -> DataFrame:
    """M-25: per studio, month and channel: conversion, mean check and the share of
    leads whose client came back (two or more visits)."""
    cv = client_visits(bookings).select("studio_id", "phone", "visits")
    l = leads_booked.join(cv, ["studio_id", "phone"], "left").select(
        "studio_id", _month("created_at").alias("month"),
        F.coalesce("utm_source", F.lit("unknown")).alias("channel"), "yc_booking_id", "booking_status",
        "booking_amount", "visits")
    vis = F.col("booking_status") == "visited"
    g = l.groupBy("studio_id", "month", "channel").agg(
        F.count(F.lit(1)).alias("leads"), F.count_if(F.col("yc_booking_id").isNotNull()).alias("booked"),
        F.count_if(vis).alias("visited"), F.sum(F.when(vis, F.col("booking_amount"))).alias("_amt"),
        F.count_if(F.col("visits") >= 2).alias("returning"))
    return g.select("studio_id", "month", "channel", "leads",
                    pct("booked", "leads").alias("conversion"),
                    safe_div(F.col("_amt"), F.col("visited")).alias("avg_check"),
                    pct("returning", "leads").alias("retention"))


def source_ranking(leads: DataFrame) -> DataFrame:
    """M-26: sources by lead count per studio (ties by name, NULL last)."""
    g = leads.groupBy("studio_id", "utm_source").agg(F.count(F.lit(1)).alias("leads"))
    w = Window.partitionBy("studio_id").orderBy(F.desc("leads"), F.asc_nulls_last("utm_source"))
    return g.withColumn("rank", F.row_number().over(w))


def weak_channels(leads_booked: DataFrame, threshold: float) -> DataFrame:
    """M-27: channels whose conversion from lead to subscription is below the threshold, with
    their booked leads and the conversion from lead to booking."""
    g = leads_booked.groupBy("studio_id", "utm_source").agg(
        F.count(F.lit(1)).alias("leads"), F.count_if(F.col("yc_booking_id").isNotNull()).alias("bookings"),
        F.count_if(F.col("status_id").isin(*WON)).alias("abonements"))
    g = g.withColumn("lead_to_booking", pct("bookings", "leads")).withColumn("conversion", pct("abonements", "leads"))
    return g.filter(F.col("conversion") < threshold)


def loss_analysis(leads: DataFrame) -> DataFrame:
    """M-28: closed-lost leads by source and price band: count, exact median price, days open."""
    keys = ["studio_id", "utm_source", "price_band"]
    p = F.col("price")
    band = (F.when(p < 100000, "<100k").when(p < 200000, "100k-200k").when(p < 300000, "200k-300k")
            .otherwise(">=300k"))
    l = leads.filter(F.col("status_id") == C.STATUS_CLOSED_LOST).withColumn("price_band", band)
    g = l.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("leads"),
        F.round(F.avg(F.timestamp_diff("MICROSECOND", F.col("created_at"), F.col("closed_at")))
                / F.lit(86_400_000_000.0), 2).alias("avg_days_open"))
    q = exact_quantiles(l, keys, p * 100, {"median_price": 0.5}, 100.0)
    return g.alias("g").join(q.alias("q"), same_keys("g", "q", keys), "left").select(
        *[f"g.{k}" for k in keys], "leads", "median_price", "avg_days_open")


def deposit_clients(leads: DataFrame, bookings: DataFrame) -> DataFrame:
    """M-29: deposit-stage clients with what they paid (visits) and still owe."""
    d = leads.filter(F.col("status_id") == C.STATUS_DEPOSIT)
    paid = client_visits(bookings).select("studio_id", "phone", F.col("revenue").alias("paid"))
    j = d.join(paid, ["studio_id", "phone"], "left")
    paid_c = F.coalesce(F.col("paid"), F.lit(0))
    return j.select("studio_id", "lead_id", "client_name", "phone", F.col("price").cast("double").alias("deposit"),
                    paid_c.cast("double").alias("paid"), (F.col("price") - paid_c).cast("double").alias("debt"))


def lapsed_history(leads: DataFrame, bookings: DataFrame, as_of: str, days: int) -> DataFrame:
    """M-30: not-renewed clients whose last visit is more than ``days`` before as_of:
    visit count, last visit, all service ids (sorted) and masters seen."""
    l = leads.filter((F.col("status_id") == C.STATUS_NO_RENEWAL) & F.col("phone_valid"))
    v = visits_of_clients(bookings, as_of)
    h = v.groupBy("studio_id", "phone").agg(
        F.count(F.lit(1)).alias("visit_count"), F.max("visit_date").alias("last_visit"),
        F.array_sort(F.collect_set("service_id")).alias("_svc"),
        F.countDistinct("master_id").alias("masters"))
    j = l.join(h, ["studio_id", "phone"])
    a = F.lit(as_of).cast("date")
    j = j.withColumn("days_since", F.datediff(a, F.col("last_visit"))).filter(F.col("days_since") > days)
    return j.select("studio_id", "lead_id", "phone", "visit_count", "last_visit", "days_since",
                    F.array_join(F.transform("_svc", lambda x: x.cast("string")), ",").alias("services"),
                    "masters")


def quality_scores(traffic: DataFrame) -> DataFrame:
    """Channel quality score per studio, month and channel (ours): the share of a
    channel's leads whose client came back, as a 0..1 factor."""
    return traffic.select("studio_id", "month", "channel",
                          F.round(F.col("retention") / F.lit(100.0), 4).alias("quality_score"))


def with_quality(df: DataFrame, scores: DataFrame) -> DataFrame:
    """M-31: carry the quality score on channel metrics (no reweighting).

    The score table has one row per studio, month and channel, so the left join
    is one-to-one; its size follows the data, so the planner picks the strategy.
    """
    return df.join(scores, ["studio_id", "month", "channel"], "left")
