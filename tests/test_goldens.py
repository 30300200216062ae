"""Hand-made boundary rows from the rules (FIXTURES.md section 3)."""

import datetime as dt

from pyspark.sql import functions as F

from leadlens.operators.grouping import with_consolidated
from leadlens.plans import alerts as AL
from leadlens.plans import events as E
from leadlens.plans import metrics as M
from leadlens.plans import normalize as N

D = dt.datetime


def test_e02_collapse(spark):
    states = spark.createDataFrame(
        [(1, "s", "amo", "new", D(2024, 1, 1, 10), 1), (1, "s", "amo", "new", D(2024, 1, 1, 11), 2),
         (1, "s", "amo", "negotiation", D(2024, 1, 3, 9), 3)],
        "lead_id long, studio_id string, source string, stage string, event_ts timestamp_ntz, obs_id long")
    ev = E.lead_events(states).orderBy("event_ts").collect()
    assert [(r.event_type, r.stage_from, r.stage_to) for r in ev] == [
        ("created", None, "new"), ("status_changed", "new", "negotiation")]
    assert ev[1].prev_event_ts == D(2024, 1, 1, 10)
    snaps = E.snapshots(E.lead_events(states)).orderBy("valid_from").collect()
    assert snaps[0].valid_to == D(2024, 1, 3, 9) and snaps[1].valid_to is None
    # E-05: valid_to exactly at t is not in the state at t
    at = E.state_at(E.snapshots(E.lead_events(states)), "2024-01-03 09:00:00").collect()
    assert [r.stage for r in at] == ["negotiation"]


def test_a01_consecutive_days(spark):
    # conversions 29, 29, 31, 29, 29, 29 % by day -> fires on day 6 only
    rows = []
    for day, conv in enumerate([29, 29, 31, 29, 29, 29]):
        for i in range(100):
            rows.append(("s1", dt.date(2024, 1, 1 + day), 1 if i < conv else None))
    lb = spark.createDataFrame(rows, "studio_id string, lead_date date, yc_booking_id long")
    hits = AL.alert_a01(lb, 30.0, 3).collect()
    assert [str(r.alert_date) for r in hits] == ["2024-01-06"]


def test_a18_gate_skips_only_that_studio(spark):
    studios = spark.createDataFrame([("studio_a", True), ("studio_b", True), ("studio_c", False)],
                                    "studio_id string, is_active boolean")
    gates = spark.createDataFrame([("studio_a", "A04", "open")], "studio_id string, alert_id string, status string")
    assert sorted(r.studio_id for r in AL.runnable_studios(studios, gates).collect()) == ["studio_b"]
    acks = spark.createDataFrame([("studio_a", "A04", "ops", D(2024, 1, 2))],
                                 "studio_id string, alert_id string, ack_by string, ack_at timestamp_ntz")
    resolved = AL.resolve_gates(gates, acks).collect()[0]
    assert resolved.status == "resolved" and resolved.ack_by == "ops"


def test_m18_segment_boundaries(spark):
    as_of = "2024-06-30"
    rows = []
    for phone, gap in [("p29", 29), ("p30", 30), ("p90", 90), ("p91", 91)]:
        last = dt.date(2024, 6, 30) - dt.timedelta(days=gap)
        for d in (last - dt.timedelta(days=10), last):
            rows.append((1, "s", phone, True, "visited", D(d.year, d.month, d.day), d))
    b = spark.createDataFrame(rows, "booking_id long, studio_id string, phone string, phone_valid boolean, "
                                    "status string, visit_ts timestamp_ntz, visit_date date")
    got = {r.phone: r.segment for r in M.activity_segments(b, as_of).collect()}
    assert got == {"p29": "active", "p30": "passive", "p90": "passive", "p91": "lost"}


def test_m10_null_key_survives(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("a", "vk")], "studio_id string, utm_source string")
    g = with_consolidated(df, "studio_id", ["utm_source"], [F.count(F.lit(1)).alias("n")])
    got = {(r.studio_id, r.utm_source, r.n) for r in g.collect()}
    assert ("all", None, 2) in got and ("a", None, 1) in got and ("b", None, 1) in got and ("all", "vk", 1) in got


def test_n09_status_wins(spark):
    df = spark.createDataFrame([(74087582, 12112458, "x")], "status_id bigint, responsible_id bigint, client_name string")
    r = N.detect_studio(df).first()
    assert r.derived_studio == "studio_a" and r.studio_source == "status"


def test_illegal_transitions(spark):
    ev = spark.createDataFrame([("s", "amo", 1, 1, "status_changed", "negotiation", "new_lead"),
                                ("s", "amo", 1, 2, "status_changed", "new_lead", "negotiation")],
                               "studio_id string, source string, lead_id long, event_id long, event_type string, "
                               "stage_from string, stage_to string")
    bad = E.illegal_transitions(ev, E.funnel_edges(spark)).collect()
    assert [r.event_id for r in bad] == [1]
