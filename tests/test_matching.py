"""New mechanisms against brute force: one-to-one match, running maximum, nearest, quantiles, instants."""

import datetime as dt
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from leadlens.operators.selection import exact_quantiles
from leadlens.operators.sequence import nearest_match, running_max
from leadlens.plans import identity as I
from leadlens.plans.events import states_at

BASE = dt.datetime(2024, 1, 1)
RECORD = "studio_id string, rec_id string, name string, ts timestamp_ntz"


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_match(left, right, hours, s):
    pairs = []
    for ls, li, ln, lt in left:
        for rs, ri, rn, rt in right:
            if ls == rs and None not in (ln, rn, lt, rt) and abs(lt - rt) <= dt.timedelta(hours=hours):
                longer = max(len(ln), len(rn), 1)
                d = lev(ln, rn)
                if (longer - d) * 100 > round(s * 100) * longer:
                    pairs.append((-(1.0 - d / longer), abs(lt - rt), li, ri, ls))
    out, used = [], set()
    for sim, _, li, ri, studio in sorted(pairs):
        if (studio, "l", li) not in used and (studio, "r", ri) not in used:
            used |= {(studio, "l", li), (studio, "r", ri)}
            out.append((studio, li, ri, round(-sim, 4)))
    return sorted(out)


def records(n, seed, mark):
    rng = random.Random(seed)
    names = ["anna", "anne", "hanna", "ivan petrov", "ivan petrow", "ivam petrow", "", "q", "aaaaaaaaaa", "aaaaaaaaab",
             "maria de la cruz", "maria del cruz", None]
    out = []
    for i in range(n):
        name = "ivan petrov" if rng.random() < 0.4 else rng.choice(names)
        ts = None if rng.random() < 0.03 else BASE + dt.timedelta(minutes=rng.randrange(0, 4 * 1440, 7))
        out.append((rng.choice(["s1", "s1", "s2"]), f"{mark}{i:03d}", name, ts))
    return out


@pytest.mark.parametrize("hours,sim", [(24, 0.8), (30, 0.5)])
def test_match_by_time_is_the_greedy_assignment(spark, hours, sim):
    left, right = records(90, 1, "l"), records(70, 2, "r")
    got = I.assign_by_time(spark.createDataFrame(left, RECORD), spark.createDataFrame(right, RECORD), hours, sim)
    assert sorted(tuple(r) for r in got.collect()) == brute_match(left, right, hours, sim)
    none = spark.createDataFrame([], RECORD)
    assert I.assign_by_time(none, spark.createDataFrame(right, RECORD)).collect() == []


def test_without_phone_match(spark):
    d = lambda rows: spark.createDataFrame(rows, "studio_id string, phone string, phone_valid boolean, id int")
    a = d([("s", "1", True, 1), ("s", "2", True, 2), ("s", "0", False, 3), ("s", None, None, 4), ("t", "1", True, 5)])
    b = d([("s", "1", True, 1), ("s", "0", False, 2), ("s", "2", False, 3)])
    assert sorted(r.id for r in I.without_phone_match(a, b).collect()) == [2, 3, 4, 5]


def test_merged_into_a_lead_that_was_opened_long_ago(spark):
    day = lambda n: BASE + dt.timedelta(days=n)
    rows = [("s", "c", 1, day(0), day(50), True), ("s", "c", 2, day(1), day(2), True), ("s", "c", 3, day(10), day(11), True),
            ("s", "c", 4, day(60), None, True), ("s", "c", 5, day(61), day(61), True), ("s", "d", 6, day(5), None, True)]
    l = spark.createDataFrame(rows, "studio_id string, client_id string, lead_id long, created_at timestamp_ntz, "
                                    "closed_at timestamp_ntz, phone_valid boolean")
    assert sorted((r.lead_id, r.merged_into) for r in I.merged_leads(l).collect()) == [(2, 1), (3, 1), (5, 4)]


def test_running_max_and_nearest(spark):
    rng = random.Random(4)
    rows = [("hot" if i % 3 == 0 else f"k{i % 5}", BASE + dt.timedelta(hours=rng.randrange(300)), i, rng.choice([None, *range(50)]))
            for i in range(300)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, v long")
    got = {r.id: r.m for r in running_max(df, ["k"], "ts", "id", F.col("v"), "m").collect()}
    for k, ts, i, _ in rows:
        before = [v for a, b, j, v in rows if a == k and (b, j) < (ts, i) and v is not None]
        assert got[i] == (max(before) if before else None)
    right = [(k, ts + dt.timedelta(minutes=13), 1000 + i) for k, ts, i, _ in rows if i % 4 == 1]
    near = nearest_match(df, spark.createDataFrame(right, "k string, ts timestamp_ntz, id long"), ["k"], "ts", "id")
    got = {r.id: r.match and (r.match.us, r.match.tb) for r in near.collect()}
    for k, ts, i, _ in rows:
        best = min(((abs(ts - t) // dt.timedelta(microseconds=1), j) for a, t, j in right if a == k), default=None)
        assert got[i] == best


def test_exact_quantiles(spark):
    rng = random.Random(6)
    groups = {None: [5], "one": [7, 7, 7], "hot": [rng.randrange(10 ** 12) for _ in range(3000)] + [4] * 2000,
              "neg": list(range(-50, 51)), "none": [None, None]}
    df = spark.createDataFrame([(k, v, 1) for k, vs in groups.items() for v in vs], "k string, v long, one int")
    got = {r.k: r for r in exact_quantiles(df, ["k"], F.col("v"), {"q0": 0.0, "q5": 0.5, "q95": 0.95, "q1": 1.0}, 10.0).collect()}
    assert set(got) == {None, "one", "hot", "neg"}
    for k, vs in groups.items():
        if k in got:
            for name, q in (("q0", 0.0), ("q5", 0.5), ("q95", 0.95), ("q1", 1.0)):
                assert got[k][name] == pytest.approx(np.quantile(np.array(vs) / 10.0, q), rel=1e-12)


@pytest.mark.parametrize("unit", ["hour", "day", "week"])
def test_states_at_many_instants(spark, unit):
    rng = random.Random(8)
    at = lambda h: BASE + dt.timedelta(hours=h)
    rows = []
    for lead in range(60):
        cuts = sorted(rng.sample(range(0, 800), 5))
        rows += [("s", "amo", lead, f"st{i}", at(a), at(b) if b else None) for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], None]))]
    snaps = spark.createDataFrame(rows, "studio_id string, source string, lead_id long, stage string, "
                                        "valid_from timestamp_ntz, valid_to timestamp_ntz")
    times = [at(h) for h in (-5, 0, 1, 30, 31, 32, 200, 200, 799, 5000)]
    got = states_at(snaps, spark.createDataFrame([(t,) for t in [*times, None]], "t timestamp_ntz"), unit)
    want = sorted((t, r[2], r[3]) for t in set(times) for r in rows if r[4] <= t and (r[5] is None or r[5] > t))
    assert sorted((r.t, r.lead_id, r.stage) for r in got.collect()) == want
    assert states_at(snaps, spark.createDataFrame([], "t timestamp_ntz"), unit).collect() == []


def test_definitions_from_the_text(spark):
    """Cases that the earlier definitions got wrong: no-shows by all bookings, the base of a stage,
    a month without clients, the CRM's own campaign, a channel's bookings."""
    from leadlens.plans import alerts as AL, metrics as M, normalize as N
    d = lambda m, day=1: dt.datetime(2024, m, day)
    b = spark.createDataFrame(
        [("s", i, f"7{i:010d}", True, d(1, 5), d(1, 5).date(), "no_show" if i == 0 else "visited" if i < 3 else "confirmed", None)
         for i in range(13)],
        "studio_id string, booking_id long, phone string, phone_valid boolean, visit_ts timestamp_ntz, visit_date date, "
        "status string, amount decimal(18,2)")
    assert AL.alert_a02(b, 25.0).collect() == []  # one of 13, not one of three
    first = {r.studio_id: r.first_visit_no_show_rate for r in M.first_visit_no_show(b).collect()}
    assert first == {"s": 7.7, "all": 7.7}
    l = spark.createDataFrame([("s", d(1), d(1), c, o) for c, o, n in (
        ("unknown", None, 9), ("new_lead", 1, 4), ("negotiation", 2, 2), ("no_show", 5, 1)) for _ in range(n)],
        "studio_id string, created_at timestamp_ntz, updated_at timestamp_ntz, stage_code string, stage_order int")
    got = {r.stage_code: r.conversion for r in M.weekly_funnel(l).collect()}
    assert got == {"unknown": None, "new_lead": None, "negotiation": 50.0, "no_show": None}
    v = spark.createDataFrame([("s", "1", True, "visited", d(m), 100) for m in (1, 2, 4)] + [("s", "2", True, "visited", d(2), 50)],
                              "studio_id string, phone string, phone_valid boolean, status string, visit_ts timestamp_ntz, amount int"
                              ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    r = {x.month.month: x for x in M.retention(v).filter("studio_id = 's'").collect()}
    assert sorted(r) == [1, 2, 3, 4] and (r[3].active, r[3].retention, r[3].churn) == (0, 0.0, 100.0)
    assert r[4].retention is None and r[4].mean_ltv == 175.0
    spend = spark.createDataFrame([("s", d(1).date(), 50)], "studio_id string, expense_date date, amount int")
    c = {(x.studio_id, x.cohort_month.month, x.month.month): x for x in M.monthly_cohorts(v, spend).collect()}
    one = [c["s", 1, m] for m in (1, 2, 3, 4)]
    assert [(x.active, x.returned, x.lost, x.ltv, x.romi) for x in one] == [
        (1, 0, 0, 100.0, 100.0), (1, 0, 0, 200.0, 300.0), (0, 0, 1, 200.0, 300.0), (1, 1, 0, 300.0, 500.0)]
    assert (c["s", 2, 3].lost, c["s", 2, 3].cac) == (1, None) and one[0].cac == 50.0 and ("all", 2, 4) in c
    leads = spark.createDataFrame([(1, "s", "7000000001", True, "vk", "own"), (2, "s", "7000000001", True, None, None),
                                   (3, "s", "0", False, "vk", "own"), (4, "s", None, None, None, None)],
                                  "lead_id long, studio_id string, phone string, phone_valid boolean, utm_source string, utm_campaign string")
    ads = spark.createDataFrame([(9, "s", "7000000001", True, d(1), "google", "theirs")],
                                "ad_lead_id long, studio_id string, phone string, phone_valid boolean, created_at timestamp_ntz, "
                                "channel string, utm_campaign string")
    e = {x.lead_id: (x.utm_source, x.utm_campaign, x.from_ads) for x in N.enrich_utm(leads, ads).collect()}
    assert e == {1: ("vk", "own", True), 2: ("google", "theirs", True), 3: ("vk", "own", False), 4: (None, None, False)}


def test_missing_load_falls_back(spark, tmp_dir):
    from leadlens.sources import manifest as mf
    rows = lambda *r: spark.createDataFrame(list(r), "studio_id string, id long")
    studios = spark.createDataFrame([("s1", True), ("s2", True), ("s3", False)], "studio_id string, is_active boolean")
    mf.land(spark, tmp_dir, rows(("s1", 1), ("s2", 2)), "amo", "d1", "2024-01-01 08:00:00")
    mf.land(spark, tmp_dir, rows(("s1", 3), ("s1", 4)), "amo", "d2", "2024-01-02 08:00:00")
    mf.land(spark, tmp_dir, rows(("s1", 5)), "amo", "d2", "2024-01-02 09:00:00")  # delivered again
    mf.land(spark, tmp_dir, rows(("s1", 9), ("s2", 9)), "amo", "d3", "2024-01-03 08:00:00")
    manifest = spark.read.schema(mf.MANIFEST).parquet(f"{tmp_dir}/manifest")
    chosen = mf.choose_loads(manifest, studios, ["amo", "sheet"], "2024-01-02")
    got = {(r.studio_id, r.source): (r.load_id, r.rows, r.is_stale, r.is_missing) for r in chosen.collect()}
    assert got == {("s1", "amo"): ("d2", 1, False, False), ("s2", "amo"): ("d1", 1, True, False),
                   ("s1", "sheet"): (None, None, False, True), ("s2", "sheet"): (None, None, False, True)}
    schema = rows(("s1", 1)).withColumns({"source": F.lit(""), "load_id": F.lit("")}).schema
    data = mf.read_loads(spark, tmp_dir, schema, chosen)
    assert sorted((r.studio_id, r.id, r.is_stale) for r in data.collect()) == [("s1", 5, False), ("s2", 2, True)]


def test_presence_classes(spark):
    from leadlens.plans import reconcile as R
    d = lambda n: dt.datetime(2024, 1, n)
    l = spark.createDataFrame([("s", 1, d(1), "vk", 10, d(5)), ("s", 2, d(1), None, None, None), ("s", 3, d(1), "vk", None, None),
                               ("s", 4, d(1), "vk", 11, d(5)), ("s", 5, d(1), None, None, None), ("s", 6, d(1), "vk", 11, d(5))],
                              "studio_id string, lead_id long, created_at timestamp_ntz, utm_source string, yc_booking_id long, booking_ts timestamp_ntz")
    b = spark.createDataFrame([("s", 10, d(5)), ("s", 11, d(5)), ("s", 12, d(6))], "studio_id string, booking_id long, visit_ts timestamp_ntz")
    a = spark.createDataFrame([("s", 1, d(2), "vk"), ("s", 3, d(1), "google"), ("s", 5, d(1), None), ("s", 7, d(3), "vk"), ("t", 2, d(1), None)],
                              "studio_id string, ad_lead_id long, created_at timestamp_ntz, channel string")
    got = sorted((r.studio_id, r.lead_date.day, r.channel or "", r.presence, r.leads, r.date_differs, r.channel_differs)
                 for r in R.presence_grid(l, b, a).collect())
    assert got == sorted([
        ("s", 1, "vk", "all three", 1, 1, 0), ("s", 1, "", "crm", 1, 0, 0), ("s", 1, "vk", "crm+sheet", 1, 0, 1),
        ("s", 1, "vk", "crm+booking", 2, 0, 0), ("s", 1, "", "crm+sheet", 1, 0, 0), ("s", 6, "", "booking", 1, 0, 0),
        ("s", 3, "vk", "sheet", 1, 0, 0), ("t", 1, "", "sheet", 1, 0, 0)])
