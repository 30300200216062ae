"""I-01 without sorting all records before the shuffle."""

import datetime as dt

from leadlens.plans import identity as I

D = dt.datetime


def _tables(spark):
    leads = spark.createDataFrame(
        [("s", "71", True, 1, D(2024, 1, 2)), ("s", "72", True, 2, None), ("s", "73", False, 3, D(2020, 1, 1)),
         (None, "74", True, 4, D(2024, 1, 5)), ("s", "75", True, 5, D(2024, 1, 9))],
        "studio_id string, phone string, phone_valid boolean, lead_id long, created_at timestamp_ntz")
    books = spark.createDataFrame(
        [("s", "71", True, 10, D(2024, 1, 2), "visited", 5), ("s", "71", True, 11, D(2024, 1, 1, 5), "no_show", 7),
         ("s", "72", True, 12, D(2024, 1, 1), "visited", None), ("s", "75", True, 13, None, "visited", 1)],
        "studio_id string, phone string, phone_valid boolean, booking_id long, visit_ts timestamp_ntz, status string, amount int"
    ).withColumn("amount", I.F.col("amount").cast("decimal(18,2)"))
    ads = spark.createDataFrame(
        [("s", "71", True, 20, D(2024, 1, 1, 5)), ("s", "72", True, 21, None), (None, "74", True, 22, D(2024, 1, 5))],
        "studio_id string, phone string, phone_valid boolean, ad_lead_id long, created_at timestamp_ntz")
    return leads, books, ads


def test_first_source_ties_and_unknown_times(spark):
    df = I.client_profiles(*_tables(spark))
    got = {(r.studio_id, r.phone): (r.first_source, r.first_seen_at, r.last_seen_at, r.total_visits, r.total_revenue, r.records)
           for r in df.collect()}
    assert got == {
        ("s", "71"): ("gsheets", D(2024, 1, 1, 5), D(2024, 1, 2), 1, 5.0, 4),
        ("s", "72"): ("amo", None, D(2024, 1, 1), 1, 0.0, 3),
        ("s", "75"): ("yclients", None, D(2024, 1, 9), 1, 1.0, 2),
        (None, "74"): ("amo", D(2024, 1, 5), D(2024, 1, 5), 0, 0.0, 2)}


def test_profiles_hash_instead_of_sorting(spark):
    plan = I.client_profiles(*_tables(spark))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
