"""Adapter views: the driver's star-schema tables in the shapes of the funnel model.

Each view is a projection and a few joins over the given parquet tables, so
its size grows with them.  Joins against ``nation`` / ``region`` are left to
the planner, which broadcasts them after its own size check (AQE re-checks
at run time); nothing here forces a broadcast of a data table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES of the fixture mapping: status_ix (0..13) -> CRM status id.
FIXTURE_STATUS_IDS = [74087434, 74087430, 74087586, 84866070, 74087582, 84866066,
                      74087590, 74087594, 74087598, 84237074, 142, 83303646,
                      84237070, 143]
# Customer segment -> utm_source (MACHINERY has none).
FIXTURE_SEGMENT_UTM = {"AUTOMOBILE": "yandex", "BUILDING": "vk", "FURNITURE": "site",
                       "HOUSEHOLD": "google"}
# events.event_type -> event stage code.
FIXTURE_EVENT_STAGE = {"signup": "new", "view": "contacted", "click": "negotiation",
                       "purchase": "abonement_sold", "error": "no_show"}
# Fixture responsible users (two ids of the studio-detection rules).
FIXTURE_USERS = [12112418, 12112458]

# Studio time zones by region key (fixture choice); the studio of region 4 is inactive.
FIXTURE_STUDIO_TZ = {0: "Africa/Cairo", 1: "America/New_York", 2: "Asia/Tokyo",
                     3: "Europe/Moscow", 4: "Asia/Dubai"}
FIXTURE_INACTIVE_REGION = 4

AS_OF_STAR = "2001-08-01"
AS_OF_EVENTS = "2024-01-31"

TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]


@dataclass
class Tables:
    """Lazy readers over ``{sf_dir}/{name}.parquet``."""

    spark: SparkSession
    sf_dir: str
    _cache: dict = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]


def _map_expr(mapping: dict) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def fixture_phone(custkey: Column) -> Column:
    """Ten digits 9000000000+custkey, spelled five ways; ten zeros when custkey % 25 = 4."""
    d = (F.lit(9000000000).cast("bigint") + custkey).cast("string")
    style = custkey % 5
    return (F.when(custkey % 25 == 4, F.lit("0000000000"))
            .when(style == 0, F.concat(F.lit("+7 ("), F.substring(d, 1, 3), F.lit(") "),
                                       F.substring(d, 4, 3), F.lit("-"), F.substring(d, 7, 2),
                                       F.lit("-"), F.substring(d, 9, 2)))
            .when(style == 1, F.concat(F.lit("8"), d))
            .when(style == 2, d)
            .when(style == 3, F.concat(F.lit("7"), d))
            .otherwise(F.concat(F.lit("+7"), d)))


def _customer_studio(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_regionkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .select("c_custkey", "c_name", "c_mktsegment",
                    F.concat(F.lit("studio_"), F.col("n_regionkey").cast("string")).alias("studio_id")))


def _lead_base(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                        "o_orderdate", "o_orderpriority")
    cs = _customer_studio(t)
    j = o.join(cs, o.o_custkey == cs.c_custkey)
    status_ids = F.array(*[F.lit(x).cast("bigint") for x in FIXTURE_STATUS_IDS])
    created = F.col("o_orderdate").cast("timestamp_ntz")
    updated = F.timestamp_add("DAY", F.col("o_custkey") % 10, created)
    return j.select(
        F.col("o_orderkey").alias("lead_id"),
        "studio_id",
        F.element_at(status_ids, (F.col("o_orderkey") % 14 + 1).cast("int")).alias("status_id"),
        F.element_at(_map_expr(FIXTURE_SEGMENT_UTM), F.col("c_mktsegment")).alias("utm_source"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        F.when(F.col("o_orderstatus") == "F", updated).alias("closed_at"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("c_name").alias("client_name"),
        fixture_phone(F.col("o_custkey")).alias("client_phone"),
        F.when(F.col("o_custkey") % 3 == 0, F.lit(FIXTURE_USERS[0]).cast("bigint"))
         .when(F.col("o_custkey") % 3 == 1, F.lit(FIXTURE_USERS[1]).cast("bigint"))
         .alias("responsible_id"),
        F.col("o_orderpriority").alias("priority"),
    )


def crm_leads(t: Tables) -> DataFrame:
    """CRM leads: one row per order."""
    return _lead_base(t).drop("priority").withColumn("source", F.lit("amo"))


def bookings(t: Tables) -> DataFrame:
    """Bookings: one row per lineitem; booking_id is duplicated on purpose."""
    return with_client_phone(phoneless_bookings(t))


def with_client_phone(bookings: DataFrame) -> DataFrame:
    """Add the phone after ``client_name``; it follows from ``client_ref``."""
    at = bookings.columns.index("client_name") + 1
    return bookings.select(*bookings.columns[:at], fixture_phone(F.col("client_ref")).alias("client_phone"),
                           *bookings.columns[at:])


def phoneless_bookings(t: Tables) -> DataFrame:
    """The bookings without the clients' phones."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                           "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate",
                           "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey")
    cs = _customer_studio(t)
    # the orders get their customer first: the lineitems then go through one join, not two
    oc = o.join(cs, o.o_custkey == cs.c_custkey)
    j = li.join(oc, li.l_orderkey == oc.o_orderkey)
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    status = (F.when(rf == "A", "visited")
              .when((rf == "R") & (ls == "F"), "not_visited")
              .when(rf == "R", "canceled")
              .when(ls == "F", "confirmed")
              .otherwise("waiting"))
    return j.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("booking_id"),
        "studio_id",
        F.col("o_custkey").alias("client_ref"),
        F.col("c_name").alias("client_name"),
        F.col("l_partkey").alias("service_id"),
        F.col("l_suppkey").alias("master_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("visit_ts"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("l_quantity").alias("quantity"),
        status.alias("status"),
    )


def ad_leads(t: Tables) -> DataFrame:
    """Ad-sheet leads: the CRM leads minus a known 10% gap (lead_id % 10 = 3)."""
    b = _lead_base(t)
    return b.filter(F.col("lead_id") % 10 != 3).select(
        F.col("lead_id").alias("ad_lead_id"), "studio_id", "utm_source",
        F.col("priority").alias("utm_campaign"), "client_name", "client_phone", "created_at")


def ad_spend(t: Tables) -> DataFrame:
    """Ad spend: one row per CRM lead, channel = its utm_source."""
    b = _lead_base(t)
    return b.select(
        F.col("lead_id").alias("spend_id"), "studio_id",
        F.to_date("created_at").alias("expense_date"),
        F.col("utm_source").alias("channel"),
        (F.lit(500) + F.col("lead_id") % 1000).cast("decimal(18,2)").alias("amount"))


def lead_states(t: Tables) -> DataFrame:
    """Observed lead states from the event stream (one row per observation)."""
    e = t.events.select("event_id", "ts", "user_id", "event_type")
    return e.select(
        F.col("user_id").alias("lead_id"),
        F.concat(F.lit("studio_"), (F.col("user_id") % 5).cast("string")).alias("studio_id"),
        F.lit("amo").alias("source"),
        F.element_at(_map_expr(FIXTURE_EVENT_STAGE), F.col("event_type")).alias("stage"),
        F.col("ts").cast("timestamp_ntz").alias("event_ts"),
        F.col("event_id").alias("obs_id"),
    )


def part_types(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("service_id"), F.col("p_type").alias("service_type"))


def studios(t: Tables) -> DataFrame:
    """Studio registry: one row per region."""
    r = t.region.select("r_regionkey", "r_name")
    return r.select(
        F.concat(F.lit("studio_"), F.col("r_regionkey").cast("string")).alias("studio_id"),
        F.col("r_name").alias("studio_name"),
        F.element_at(_map_expr(FIXTURE_STUDIO_TZ), F.col("r_regionkey")).alias("timezone"),
        (F.col("r_regionkey") != FIXTURE_INACTIVE_REGION).alias("is_active"))
