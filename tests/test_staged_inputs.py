"""What the staging step shuffles and writes."""

from leadlens.plans import normalize as N
from leadlens.registry import Ctx
from leadlens.sources import fixtures as fx
from tests.conftest import SF_SMALL


def test_lineitems_go_through_one_join(spark):
    plan = fx.bookings(fx.Tables(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joins) == 3 and "l_orderkey" in joins[0], joins


def test_orders_with_several_customers_and_none(spark, tmp_dir):
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/{name}.parquet")
    put("nation", [(1, 0), (2, None)], "n_nationkey int, n_regionkey int")
    put("customer", [(7, "a", 1, "BUILDING"), (7, "b", 2, None), (None, "c", 1, None), (9, "d", None, None)],
        "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    put("orders", [(1, 7), (1, 7), (2, 9), (3, None), (None, 7)], "o_orderkey long, o_custkey long")
    put("lineitem", [(k, n, 1, 1, 2.0, "A", "F", None, 1.0) for k in (1, 2, 3, 4, None) for n in (1, None)],
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp, l_quantity double")
    got = sorted(((r.booking_id or 0, r.client_name, r.studio_id or "") for r in fx.bookings(fx.Tables(spark, tmp_dir)).collect()))
    assert got == sorted([(i, n, s) for i in (11, 0) for n, s in (("a", "studio_0"), ("b", "")) for _ in range(2)])
    assert sorted((r.booking_id or 0, r.client_name) for r in N.prepared_bookings(fx.Tables(spark, tmp_dir)).collect()) == [
        (0, "a"), (11, "a")]


def test_staging_jobs_start_with_many_partitions(spark, monkeypatch):
    """A session with few shuffle partitions does not make the staging jobs sort and spill large ones."""
    from leadlens.plans import staging
    key, seen = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", []

    class Frame:
        def __init__(self):
            self.write = self

        def mode(self, _):
            return self

        def option(self, *_):
            return self

        def parquet(self, path):
            seen.append(int(spark.conf.get(key)))
            if len(seen) == 1:  # a table that another thread stages meanwhile
                staging.staged(spark, "wide", "b", Frame)
                assert int(spark.conf.get(key)) == staging.PARTS
            spark.range(1).write.parquet(path)

    old, enabled = spark.conf.get(key, None), spark.conf.get("leadlens.staging.enabled", "true")
    spark.conf.set("leadlens.staging.enabled", "true")
    try:
        for own, want in ((None, staging.PARTS), ("7", staging.PARTS), ("5000", 5000)):
            seen.clear()
            monkeypatch.setattr(staging, "_STAGED", {})
            spark.conf.unset(key) if own is None else spark.conf.set(key, own)
            monkeypatch.setattr(staging, "_RUN", f"wide-{own}")
            if own == "5000":
                with staging.wide_shuffles(spark):
                    assert spark.conf.get(key) == "5000"
            else:
                staging.staged(spark, "wide", "a", Frame)
                assert seen == [want, want]
            assert spark.conf.get(key, None) == own
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
        spark.conf.set("leadlens.staging.enabled", enabled)


def test_phone_is_made_after_the_deduplication(spark):
    t = fx.Tables(spark, SF_SMALL)
    assert "client_phone" not in fx.phoneless_bookings(t).columns
    plan = N.prepared_bookings(t)._jdf.queryExecution().optimizedPlan().toString()
    agg = plan[plan.index("Aggregate [booking_id"):]
    assert "client_phone" not in agg and "9000000000" not in agg
    want = N.with_phone(N.latest_per_key(fx.bookings(t), ["booking_id"], ["visit_ts", "amount"]))
    got = N.prepared_bookings(t)
    assert got.columns[:len(fx.bookings(t).columns)] == fx.bookings(t).columns
    assert sorted(map(str, got.select("booking_id", "client_phone", "phone", "amount").collect())) == sorted(
        map(str, want.select("booking_id", "client_phone", "phone", "amount").collect()))
