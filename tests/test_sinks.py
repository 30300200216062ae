"""Upsert idempotence, key replacement and landed-file scans."""

import datetime as dt
import json
import os

from leadlens.sources import landed as S
from leadlens.sources.sinks import replace_keys, upsert


def test_upsert_twice_equals_once(spark, tmp_dir):
    target = os.path.join(tmp_dir, "leads")
    b1 = spark.createDataFrame([("s1", 1, "NEW", dt.datetime(2024, 1, 1)), ("s2", 2, "NEW", dt.datetime(2024, 1, 1))],
                               "studio_id string, id long, status string, updated_at timestamp_ntz")
    b2 = spark.createDataFrame([("s1", 1, "IN_WORK", dt.datetime(2024, 1, 2)), ("s1", 3, "NEW", dt.datetime(2024, 1, 2))],
                               "studio_id string, id long, status string, updated_at timestamp_ntz")
    upsert(spark, target, b1, ["studio_id", "id"], ["updated_at"], ["studio_id"])
    upsert(spark, target, b2, ["studio_id", "id"], ["updated_at"], ["studio_id"])
    once = sorted(tuple(r) for r in spark.read.parquet(target).select("studio_id", "id", "status").collect())
    upsert(spark, target, b2, ["studio_id", "id"], ["updated_at"], ["studio_id"])
    twice = sorted(tuple(r) for r in spark.read.parquet(target).select("studio_id", "id", "status").collect())
    assert once == twice == [("s1", 1, "IN_WORK"), ("s1", 3, "NEW"), ("s2", 2, "NEW")]
    # an older row never overwrites a newer one
    old = spark.createDataFrame([("s1", 1, "NEW", dt.datetime(2023, 1, 1))],
                                "studio_id string, id long, status string, updated_at timestamp_ntz")
    upsert(spark, target, old, ["studio_id", "id"], ["updated_at"], ["studio_id"])
    assert spark.read.parquet(target).filter("id = 1").first().status == "IN_WORK"


def test_replace_keys(spark, tmp_dir):
    target = os.path.join(tmp_dir, "ev")
    a = spark.createDataFrame([("s", 1, 1), ("s", 1, 2), ("s", 2, 1)], "studio_id string, lead_id long, e long")
    replace_keys(spark, target, a, ["studio_id", "lead_id"], ["studio_id"])
    b = spark.createDataFrame([("s", 1, 9)], "studio_id string, lead_id long, e long")
    replace_keys(spark, target, b, ["studio_id", "lead_id"], ["studio_id"])
    got = sorted((r.lead_id, r.e) for r in spark.read.parquet(target).collect())
    assert got == [(1, 9), (2, 1)]


def test_scan_crm_and_spend(spark, tmp_dir):
    crm_dir = os.path.join(tmp_dir, "crm")
    os.makedirs(crm_dir)
    page = {"studio_id": "studio_a", "load_date": "2024-01-02", "_embedded": {"leads": [
        {"id": 5, "name": "deal", "price": 1000.5, "status_id": 74087434, "pipeline_id": 9226358,
         "responsible_user_id": 12112418, "created_at": 1704153600, "updated_at": 1704157200, "closed_at": None,
         "custom_fields_values": [{"field_code": "UTM_SOURCE", "values": [{"value": "vk"}]}],
         "contact": {"name": "Anna", "phone": "+7 (999) 772-10-79"}}]}}
    with open(os.path.join(crm_dir, "p1.json"), "w") as f:
        f.write(json.dumps(page) + "\n")
    df = S.scan_crm(spark, crm_dir, frm="2024-01-01", to="2024-01-31")
    r = df.first()
    assert r.lead_id == 5 and r.utm_source == "vk" and r.client_phone.startswith("+7")
    assert str(r.created_at) == "2024-01-02 00:00:00"
    spend_dir = os.path.join(tmp_dir, "spend")
    os.makedirs(spend_dir)
    with open(os.path.join(spend_dir, "s.csv"), "w") as f:
        f.write("expense_date,article,amount,channel\n2024-01-02,ads,100.50,vk\nnot-a-date,ads,x,vk\n")
    sp = S.scan_spend(spark, spend_dir).collect()
    assert len(sp) == 2 and sum(1 for r in sp if r._corrupt_record is not None) == 1


def test_scan_bookings_adleads_payload_and_metric_write(spark, tmp_dir):
    from leadlens.plans import reconcile as R
    from leadlens.sources.sinks import write_metric
    bdir = os.path.join(tmp_dir, "yc")
    os.makedirs(bdir)
    page = {"studio_id": "studio_a", "load_date": "2024-01-03", "data": [
        {"id": 7, "client": {"id": 1, "name": "Anna", "phone": "89997721079"},
         "services": [{"id": 11, "title": "massage", "cost": 1500.0}, {"id": 12, "title": "oil", "cost": 200.0}],
         "staff_id": 5111463, "staff_name": "m", "datetime": "2024-01-05T10:00:00+03:00", "attendance": 1,
         "paid_full": 1, "comment": "ok"},
        {"id": 8, "client": {"id": 2, "name": "Oleg", "phone": "9997721078"}, "services": [],
         "staff_id": 1, "staff_name": "n", "datetime": "2024-02-05T10:00:00+03:00", "attendance": -1,
         "paid_full": 0, "comment": None}]}
    with open(os.path.join(bdir, "p.json"), "w") as f:
        f.write(json.dumps(page) + "\n")
    b = {r.booking_id: r for r in S.scan_bookings(spark, bdir, frm="2024-01-01", to="2024-12-31").collect()}
    assert float(b[7].amount) == 1700.0 and b[7].service_id == 11 and str(b[7].visit_ts) == "2024-01-05 10:00:00"
    assert b[8].service_id is None and float(b[8].amount) == 0.0
    p = S.with_payload(S.scan_bookings(spark, bdir), {"staff": "$.staff_name"}).filter("booking_id = 7").first()
    assert p.staff == "m"
    adir = os.path.join(tmp_dir, "ads")
    os.makedirs(adir)
    with open(os.path.join(adir, "a.csv"), "w") as f:
        f.write("deal_id,source_name,utm_source,utm_campaign,client_name,client_phone,studio_name,created_at\n"
                "1,ВК,vk,c1,Anna,+79997721079,A,2024-01-02 10:00:00\n")
    a = S.scan_ad_leads(spark, adir).first()
    assert a.deal_id == 1 and a.utm_source == "vk"
    out = os.path.join(tmp_dir, "metric")
    m = spark.createDataFrame([("s1", 1), ("s2", 2)], "studio_id string, v int")
    write_metric(m, out, ["studio_id"], "2024-01-31 00:00:00")
    write_metric(spark.createDataFrame([("s1", 5)], "studio_id string, v int"), out, ["studio_id"], "2024-02-01 00:00:00")
    got = sorted((r.studio_id, r.v) for r in spark.read.parquet(out).collect())
    assert got == [("s1", 5), ("s2", 2)]
    x = spark.createDataFrame([("s1", None, 10), ("s2", "vk", 5)], "studio_id string, ch string, n long")
    y = spark.createDataFrame([("s1", None, 9), ("s3", "vk", 1)], "studio_id string, ch string, n long")
    c = {(r.studio_id, r.ch): (r.n_a, r.n_b, r.n_pct) for r in R.compare_totals(x, y, ["studio_id", "ch"], ["n"]).collect()}
    assert c[("s1", None)] == (10, 9, 10.0) and c[("s2", "vk")] == (5, 0, 100.0) and c[("s3", "vk")] == (0, 1, 100.0)


SCHEMA = "studio_id string, id long, month string, v long, updated_at timestamp_ntz"


def _rows(spark, path):
    return sorted(tuple(r) for r in spark.read.schema(SCHEMA).parquet(path).select("studio_id", "id", "month", "v").collect())


def test_upsert_moves_a_key_between_partitions(spark, tmp_dir):
    target = os.path.join(tmp_dir, "moving")
    t = lambda d: dt.datetime(2024, 1, d)
    put = lambda rows: upsert(spark, target, spark.createDataFrame(rows, SCHEMA), ["studio_id", "id"],
                              ["updated_at"], ["month"])
    put([("s", 1, "2024-01", 1, t(1)), ("s", 2, "2024-01", 2, t(1)), ("s", 3, "2024-02", 3, t(1)), ("s", 4, None, 4, t(1))])
    # 1 moves, 3 is the last row of its month and moves, 4 leaves the null partition
    move = [("s", 1, "2024-03", 10, t(2)), ("s", 3, "2024-03", 30, t(2)), ("s", 4, "2024-01", 40, t(2))]
    put(move)
    want = [("s", 1, "2024-03", 10), ("s", 2, "2024-01", 2), ("s", 3, "2024-03", 30), ("s", 4, "2024-01", 40)]
    assert _rows(spark, target) == want
    assert not os.path.exists(os.path.join(target, "month=2024-02"))
    put(move)
    assert _rows(spark, target) == want
    # an older row for another partition loses and moves nothing
    put([("s", 1, "2024-09", 99, t(1))])
    assert _rows(spark, target) == want and not os.path.exists(os.path.join(target, "month=2024-09"))
    # keys are found without a locator too (a table that was there before, or a lost one)
    import shutil
    shutil.rmtree(target + "__locator")
    put([("s", 2, "2024-05", 20, t(3))])
    assert _rows(spark, target) == sorted([w for w in want if w[1] != 2] + [("s", 2, "2024-05", 20)])
    assert not os.path.exists(target + "__staging") or not os.listdir(target + "__staging")


def test_upsert_broken_off_and_run_again(spark, tmp_dir, monkeypatch):
    from leadlens.sources import sinks
    target = os.path.join(tmp_dir, "broken")
    one = spark.createDataFrame([("s", 1, "a", 1, dt.datetime(2024, 1, 1))], SCHEMA)
    two = spark.createDataFrame([("s", 1, "b", 2, dt.datetime(2024, 1, 2))], SCHEMA)
    three = spark.createDataFrame([("s", 1, "c", 3, dt.datetime(2024, 1, 3))], SCHEMA)
    args = (["studio_id", "id"], ["updated_at"], ["month"])
    upsert(spark, target, one, *args)
    whole = sinks._overwrite_partitions

    def fails(*a):
        whole(*a)
        raise RuntimeError("lost after writing, before the old partition is emptied")
    monkeypatch.setattr(sinks, "_overwrite_partitions", fails)
    try:
        upsert(spark, target, two, *args)
    except RuntimeError:
        pass
    monkeypatch.setattr(sinks, "_overwrite_partitions", whole)
    upsert(spark, target, three, *args)  # another batch, without the broken one coming again
    assert _rows(spark, target) == [("s", 1, "c", 3)]


def test_touched_partitions_prune_the_scan(spark, tmp_dir):
    from leadlens.sources.sinks import in_partitions
    target = os.path.join(tmp_dir, "pruned")
    spark.createDataFrame([(f"s{i % 3}", i, f"m{i % 7}", i, None) for i in range(50)], SCHEMA).write.partitionBy(
        "studio_id", "month").parquet(target)
    t = spark.read.schema(SCHEMA).parquet(target)
    some = t.filter(in_partitions([("s1", "m2"), ("s1", "m3"), ("s2", "m1")], ["studio_id", "month"]))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    want = {("s1", "m2"), ("s1", "m3"), ("s2", "m1")}
    assert {(r.studio_id, r.month) for r in some.collect()} <= want
    assert some.count() == sum((f"s{i % 3}", f"m{i % 7}") in want for i in range(50))
    assert t.filter(in_partitions([], ["studio_id", "month"])).count() == 0
    # beyond the limit the predicate covers each column, and so at least the partitions
    many = in_partitions([("s1", f"x{i}") for i in range(3000)] + [("s2", None)], ["studio_id", "month"])
    assert t.filter(many).count() == 0


def test_metric_partitions_without_rows_go(spark, tmp_dir):
    from leadlens.sources.sinks import write_metric
    out = os.path.join(tmp_dir, "covered")
    m = lambda rows: spark.createDataFrame(rows, "studio_id string, v int")
    ran = lambda *s: spark.createDataFrame([(x,) for x in s], "studio_id string")
    rows = lambda: sorted((r.studio_id, r.v) for r in spark.read.parquet(out).collect())
    write_metric(m([("s1", 1), ("s2", 2), ("all", 3)]), out, ["studio_id"], "2024-01-31 00:00:00", ran("s1", "s2", "all"))
    write_metric(m([("s1", 5)]), out, ["studio_id"], "2024-02-01 00:00:00", ran("s1", "s2"))
    assert rows() == [("all", 3), ("s1", 5)]
