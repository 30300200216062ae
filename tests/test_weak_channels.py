"""M-27 / Q-07 judge the conversion to subscriptions and still take in the booking match."""

from leadlens.plans import metrics as M


def test_weak_channels_count_bookings_and_subscriptions(spark):
    rows = [("s", "vk", 142 if i == 0 else 143, i if i < 3 else None) for i in range(10)]
    rows += [("s", None, 142, None)] * 2 + [("s", "site", 74087590, 1)]
    lb = spark.createDataFrame(rows, "studio_id string, utm_source string, status_id long, yc_booking_id long")
    got = {r.utm_source: (r.leads, r.bookings, r.abonements, r.lead_to_booking, r.conversion)
           for r in M.weak_channels(lb, 30.0).collect()}
    assert got == {"vk": (10, 3, 1, 30.0, 10.0), "site": (1, 1, 0, 100.0, 0.0)}


def test_network_weak_channels_carry_bookings(spark):
    from leadlens import registry
    from tests.conftest import SF_SMALL
    registry.load_all()
    leads = registry.QUERIES["m02_lead_to_booking"](spark, SF_SMALL).filter("studio_id = 'all'")
    booked = {r.utm_source: r.b for r in leads.groupBy("utm_source").agg({"bookings": "sum"}).toDF("utm_source", "b").collect()}
    got = registry.QUERIES["q07_weak_channels_all"](spark, SF_SMALL).collect()
    assert got and all(r.studio_id == "all" and r.bookings == booked[r.utm_source] for r in got)
