"""Column functions against the written examples of the business rules."""

from pyspark.sql import functions as F

from leadlens.functions import (attendance_code, booking_stage, booking_status, ceil_day, full_name,
                                normalize_phone, pct, phone_valid, romi, severity, status_code)


def _col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_normalize_phone(spark):
    got = _col(spark, ["+7 (999) 772-10-79", "89997721079", "9997721079", "", None, "12345"], normalize_phone)
    assert got == ["79997721079", "79997721079", "79997721079", None, None, "12345"]


def test_phone_valid(spark):
    got = _col(spark, ["0000000000", "1111111111", "12345", "+7 (999) 772-10-79", None], phone_valid)
    assert got == [False, False, False, True, False]


def test_booking_stage_and_status(spark):
    assert _col(spark, ["visited", "not_visited", "canceled", "confirmed", "waiting"], booking_stage) == \
        ["completed", "no_show", "canceled", None, None]
    assert _col(spark, ["Cancelled", "came", "NOT_VISITED"], booking_status) == ["canceled", "visited", "no_show"]


def test_attendance(spark):
    assert _col(spark, [-1, 0, 1, 2, 5], attendance_code, "int") == ["no_show", "waiting", "visited", "confirmed", None]


def test_status_code(spark):
    assert _col(spark, [74087434, 84866070, 74087590, 142, 143, 999], status_code, "bigint") == \
        ["NEW", "IN_WORK", "APPOINTMENT", "COMPLETED", "REFUSAL", "999"]


def test_severity_bands(spark):
    got = _col(spark, [4.99, 5.0, 10.0, 10.01, 20.01, None], severity, "double")
    assert got == ["INFO", "WARNING", "WARNING", "CRITICAL", "CRITICAL", None]


def test_romi_zero_cost_is_null(spark):
    df = spark.createDataFrame([(100.0, 0.0), (150.0, 100.0)], "r double, c double")
    assert [r[0] for r in df.select(romi("r", "c")).collect()] == [None, 50.0]
    assert [r[0] for r in df.select(pct("r", "c")).collect()] == [None, 150.0]


def test_full_name_and_ceil_day(spark):
    df = spark.createDataFrame([(" Anna ", "Ivanova"), ("", " "), (None, "Petrov")], "f string, l string")
    assert [r[0] for r in df.select(full_name("f", "l")).collect()] == ["Anna Ivanova", None, "Petrov"]
    ts = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 00:00:00' AS a, TIMESTAMP_NTZ'2024-01-02 00:00:01' AS b")
    r = ts.select(ceil_day("a"), ceil_day("b")).first()
    assert str(r[0]) == "2024-01-02" and str(r[1]) == "2024-01-03"


def test_cluster_conf_sizes():
    from leadlens.session import cluster_conf
    c = cluster_conf(100 * (1 << 40))
    assert c["spark.sql.shuffle.partitions"] == str(200_000 if 100 * (1 << 40) // (512 << 20) > 200_000 else 100 * (1 << 40) // (512 << 20))
    assert cluster_conf(1 << 30)["spark.sql.shuffle.partitions"] == "2000"
