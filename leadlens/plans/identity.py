"""Client identity (I-01 .. I-08)."""

from __future__ import annotations

import uuid
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.operators.sequence import nearest_match, running_max, seq_number
from leadlens.session import ensure_checkpoint_dir


SOURCES = ["amo", "gsheets", "yclients"]


def _records(leads: DataFrame, bookings: DataFrame, ad_leads: DataFrame, valid_only: bool = True) -> DataFrame:
    """All records with a valid phone (or simply all), one shape."""
    if valid_only:
        leads, bookings, ad_leads = (d.filter("phone_valid") for d in (leads, bookings, ad_leads))
    l = leads.select(
        "studio_id", "phone", F.lit("amo").alias("source"), F.col("created_at").alias("ts"),
        F.lit(0).alias("visit"), F.lit(None).cast("decimal(18,2)").alias("revenue"),
        F.col("lead_id").cast("string").alias("rec_id"))
    b = bookings.select(
        "studio_id", "phone", F.lit("yclients").alias("source"), F.col("visit_ts").alias("ts"),
        (F.col("status") == "visited").cast("int").alias("visit"),
        F.when(F.col("status") == "visited", F.col("amount")).alias("revenue"),
        F.col("booking_id").cast("string").alias("rec_id"))
    a = ad_leads.select(
        "studio_id", "phone", F.lit("gsheets").alias("source"), F.col("created_at").alias("ts"),
        F.lit(0).alias("visit"), F.lit(None).cast("decimal(18,2)").alias("revenue"),
        F.col("ad_lead_id").cast("string").alias("rec_id"))
    return l.unionByName(b).unionByName(a)


def client_profiles(leads: DataFrame, bookings: DataFrame, ad_leads: DataFrame) -> DataFrame:
    """I-01: one profile per studio + phone: first source, first/last seen, visits, revenue.

    A single aggregate over the union of sources (partial aggregation map-side).
    The first source is the source of the earliest record, ties by source name.
    """
    r = _records(leads, bookings, ad_leads)
    # the first record by source, in values of fixed width only: a struct would make the
    # aggregate sort all records before its shuffle.  An unknown time comes before all others.
    own = lambda s: F.col("source") == s
    g = r.groupBy("studio_id", "phone").agg(
        *[F.min(F.when(own(s), F.col("ts"))).alias(f"_first_{s}") for s in SOURCES],
        *[F.max(own(s) & F.col("ts").isNull()).alias(f"_unknown_{s}") for s in SOURCES],
        F.max("ts").alias("last_seen_at"),
        F.sum("visit").cast("bigint").alias("total_visits"),
        F.sum("revenue").alias("_rev"),
        F.count(F.lit(1)).alias("records"))
    firsts = F.array(*[F.when(F.col(f"_unknown_{s}") | F.col(f"_first_{s}").isNotNull(), F.struct(
        F.when(~F.col(f"_unknown_{s}"), F.col(f"_first_{s}")).alias("ts"), F.lit(s).alias("source"))) for s in SOURCES])
    g = g.withColumn("_first", F.array_min(firsts))
    return g.select(
        F.md5(F.concat_ws(":", "studio_id", "phone")).alias("client_id"), "studio_id", "phone",
        F.col("_first.source").alias("first_source"), F.col("_first.ts").alias("first_seen_at"),
        "last_seen_at", "total_visits",
        F.coalesce(F.col("_rev"), F.lit(0)).cast("double").alias("total_revenue"), "records")


def new_profiles(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """I-03: profiles of the batch whose client is not known yet (left anti join)."""
    return batch.join(existing.select("studio_id", "phone").distinct(), ["studio_id", "phone"], "left_anti")


def _similarity(a, b):
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def match_by_name(leads: DataFrame, ad_leads: DataFrame, min_score: float = 0.8) -> DataFrame:
    """I-05: score = 0.7 * phone_equal + 0.3 * name similarity (1 - lev / max length).

    With ``min_score > 0.3`` only phone-equal pairs can pass, so candidates are
    blocked on (studio, phone) and the ad side is first reduced to its distinct
    names per phone: a lead meets one row per distinct name, never every ad
    row of a popular phone.  Returns the best name per lead (ties: smaller name).
    A lower ``min_score`` would need pairs with other phones and is an error.
    """
    if min_score <= 0.3:
        raise ValueError("match_by_name needs min_score above 0.3: only pairs of equal phones are looked at")
    cand = (ad_leads.filter("phone_valid").select("studio_id", "phone",
                                                  F.lower(F.trim("client_name")).alias("ad_name"))
            .filter(F.col("ad_name").isNotNull()).distinct())
    l = leads.filter("phone_valid").select("studio_id", "lead_id", "phone",
                                           F.lower(F.trim("client_name")).alias("name"))
    j = l.join(cand, ["studio_id", "phone"])
    j = j.withColumn("score", F.round(F.lit(0.7) + F.lit(0.3) * _similarity(F.col("name"), F.col("ad_name")), 4))
    j = j.filter(F.col("score") >= min_score)
    best = j.groupBy("studio_id", "lead_id").agg(
        F.max(F.struct("score", F.negative(F.length("ad_name")).alias("_l"), "ad_name")).alias("_b"))
    return best.select("studio_id", "lead_id", F.col("_b.ad_name").alias("matched_name"),
                       F.col("_b.score").alias("score"))


def _length_bucket(name, min_sim: float):
    """log-length bucket of base 1/min_sim; empty names get a bucket of their own."""
    import math
    n = F.length(name)
    base = math.log(1.0 / min_sim)
    return F.when(n == 0, F.lit(-1000)).otherwise(F.floor(F.log(n.cast("double")) / F.lit(base)).cast("int"))


def match_by_time(left: DataFrame, right: DataFrame, hours: int = 24, min_sim: float = 0.8) -> DataFrame:
    """All pairs within +-``hours`` of each other and name similarity > ``min_sim``, for small sides;
    ``assign_by_time`` gives each record one partner and makes no pairs.

    Range join by day buckets: the right side is exploded to the neighbour days
    (d-1, d, d+1 for 24 h), equi-joined on (studio, day, length bucket), then the
    exact time and similarity tests run.  ``left``/``right``: studio_id, rec_id,
    name, ts.

    The length bucket is exact blocking: similarity > s needs
    lev < (1 - s) * maxlen, and lev >= |la - lb|, so minlen / maxlen > s; with
    buckets of width log(1/s) in log-length, such pairs sit in the same or an
    adjacent bucket, and the right side is exploded to both neighbours.
    """
    span = (hours + 23) // 24
    r = right.select("studio_id", F.col("rec_id").alias("r_id"), F.col("name").alias("r_name"),
                     F.col("ts").alias("r_ts"))
    r = r.withColumn("_d", F.explode(F.sequence(F.date_sub(F.to_date("r_ts"), span),
                                                F.date_add(F.to_date("r_ts"), span))))
    l = left.withColumn("_d", F.to_date("ts"))
    if 0.0 < min_sim < 1.0:
        rb = _length_bucket(F.col("r_name"), min_sim)
        r = r.withColumn("_lb", F.explode(F.array(rb - 1, rb, rb + 1)))
        l = l.withColumn("_lb", _length_bucket(F.col("name"), min_sim))
        keys = ["studio_id", "_d", "_lb"]
    else:
        keys = ["studio_id", "_d"]
    j = l.join(r, keys)
    dt = F.abs(F.timestamp_diff("SECOND", F.col("ts"), F.col("r_ts")))
    j = j.filter(dt <= hours * 3600).withColumn("similarity", F.round(_similarity(F.col("name"), F.col("r_name")), 4))
    return j.filter(F.col("similarity") > min_sim).select("studio_id", "rec_id", "r_id", "similarity")


GRAM = 2


def _grams(name):
    """The 2-grams of a name with one mark before it, repeats numbered; ``##`` for an empty name."""
    padded = F.concat(F.lit("#"), name)
    grams = F.when(F.length(name) == 0, F.array(F.lit("##"))).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.length(name), F.lit(1))), lambda i: F.substr(padded, i, F.lit(GRAM))))
    return F.transform(grams, lambda g, i: F.concat(g, F.size(F.filter(F.slice(grams, 1, i), lambda x: x == g)).cast("string")))


def _similar_names(a: DataFrame, b: DataFrame, keys: list[str], min_sim: float) -> DataFrame:
    """Pairs (keys, name, other, similarity > ``min_sim``) of the distinct names of two tables.

    An edit-distance join by prefix filter.  Similarity above s allows k < (1 - s) * longer edits, each of
    which touches two 2-grams, and the longer name has at most len / s letters.  So of the grams of either
    name, in one common order (rare ones first), the first 2k + 1 must have one in common: only these are
    joined, and the exact distance decides.
    """
    s = Decimal(str(min_sim))
    sides = [d.select(*keys, n).filter(F.col(n).isNotNull()).distinct().withColumn("_g", F.explode(_grams(F.col(n))))
             for d, n in ((a, "name"), (b, "other"))]
    freq = sides[0].select("_g").unionByName(sides[1].select("_g")).groupBy("_g").agg(F.count(F.lit(1)).alias("_f"))

    def prefixes(side: DataFrame, n: str) -> DataFrame:
        edits = F.greatest(F.ceil(F.length(n) * F.lit((1 - s) / s)) - 1, F.lit(0)).cast("int")
        own = side.join(freq, "_g").groupBy(*keys, n).agg(F.array_sort(F.collect_list(F.struct("_f", "_g"))).alias("_gs"))
        return own.select(*keys, n, F.explode(F.slice("_gs._g", F.lit(1), edits * GRAM + 1)).alias("_g"))

    pairs = prefixes(sides[0], "name").join(prefixes(sides[1], "other"), [*keys, "_g"]).select(
        *keys, "name", "other").distinct()
    longer = F.greatest(F.length("name"), F.length("other"), F.lit(1))
    same = longer - F.levenshtein("name", "other")
    return pairs.filter(same.cast("decimal(20,0)") > longer * F.lit(s)).select(
        *keys, "name", "other", _similarity(F.col("name"), F.col("other")).alias("similarity"))


def assign_by_time(left: DataFrame, right: DataFrame, hours: int = 24, min_sim: float = 0.8) -> DataFrame:
    """I-06: one-to-one matches within +-``hours`` and name similarity > ``min_sim``.

    ``left``/``right``: studio_id, rec_id, name, ts (timestamp_ntz).  Pairs are ranked by
    similarity, then distance in time, then the ids; the best pair is taken, both records
    leave, and so on.  That order is reached by rounds of mutual best pairs: in each round
    every record finds its best partner, and pairs that chose each other are taken.

    Equal names rank before all others, so they are settled first, by as-of joins on the name;
    similar names are looked for only among the records that are left.  A record without a
    partner in a round has none later either and leaves the rounds.

    No table of record pairs is made.  Similar names are found among the distinct names of a
    studio and day (neighbour days on the right side); a record meets each similar name
    once, by an as-of join that gives the nearest record of that name.  A name or a day that
    holds a third of all records therefore never becomes a square.  Null names match nothing.
    """
    span = (hours + 23) // 24
    l = left.filter("name IS NOT NULL AND ts IS NOT NULL").select("studio_id", "rec_id", "name", "ts")
    r = right.filter("name IS NOT NULL AND ts IS NOT NULL").select("studio_id", "rec_id", "name", "ts")
    day = lambda d: d.withColumn("_d", F.to_date("ts"))

    def best(a: DataFrame, b: DataFrame, names: DataFrame | None, own: str, partner: str) -> DataFrame:
        if names is None:
            cand = a.withColumn("similarity", F.lit(1.0))
        else:
            cand = day(a).join(names, ["studio_id", "_d", "name"]).select(
                "studio_id", "rec_id", "ts", F.col("other").alias("name"), "similarity")
        found = nearest_match(cand, b, ["studio_id", "name"], "ts", "rec_id", out="_m")
        found = found.filter(F.col("_m.us") <= hours * 3_600_000_000)
        return found.groupBy("studio_id", F.col("rec_id").alias(own)).agg(F.min(F.struct(
            (-F.col("similarity")).alias("s"), F.col("_m.us").alias("us"), F.col("_m.tb").alias("tb"))).alias("_b")).select(
            "studio_id", own, F.col("_b.tb").alias(partner), (-F.col("_b.s")).alias("similarity"))

    def without(a: DataFrame, taken: DataFrame, own: str) -> DataFrame:
        return a.join(taken.select("studio_id", F.col(own).alias("rec_id")), ["studio_id", "rec_id"], "left_anti")

    def able(a: DataFrame, found: DataFrame, own: str) -> DataFrame:
        f = found.select(F.col("studio_id").alias("_s"), F.col(own).alias("_r"))
        return a.join(f, F.col("studio_id").eqNullSafe(F.col("_s")) & F.col("rec_id").eqNullSafe(F.col("_r")), "left_semi")

    def rounds(l: DataFrame, r: DataFrame, names: DataFrame | None = None, back: DataFrame | None = None) -> list[DataFrame]:
        taken = []
        while True:
            mine = _written(best(l, r, names, "rec_id", "r_id"))
            theirs = _written(best(r, l, back, "r_id", "rec_id"))
            mutual = _written(mine.join(theirs.drop("similarity"), ["studio_id", "rec_id", "r_id"]))
            if mutual.isEmpty():
                return taken or [mutual]
            taken.append(mutual)
            l = _written(without(able(l, mine, "rec_id"), mutual, "rec_id"))
            r = _written(without(able(r, theirs, "r_id"), mutual, "r_id"))
            if l.isEmpty() or r.isEmpty():
                return taken

    taken = []
    l, r = _written(l), _written(r)
    if min_sim < 1:
        taken = rounds(l, r)
        for t in taken:
            l, r = without(l, t, "rec_id"), without(r, t, "r_id")
        l, r = _written(l), _written(r)
    if not taken or not (l.isEmpty() or r.isEmpty()):
        near = r.withColumn("_d", F.explode(F.sequence(F.date_sub(F.to_date("ts"), span), F.date_add(F.to_date("ts"), span))))
        names = _written(_similar_names(day(l), near.withColumnRenamed("name", "other"), ["studio_id", "_d"], min_sim))
        back = names.select("studio_id", F.explode(F.sequence(F.date_sub("_d", span), F.date_add("_d", span))).alias("_d"),
                            F.col("other").alias("name"), F.col("name").alias("other"), "similarity").distinct()
        taken += rounds(l, r, names, back)
    return reduce(DataFrame.unionByName, taken).select(
        "studio_id", "rec_id", "r_id", F.round("similarity", 4).alias("similarity"))


def _written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, so that the next round does not go back beyond it."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/leadlens-match/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without_phone_match(rows: DataFrame, others: DataFrame) -> DataFrame:
    """The rows whose studio and phone no row of ``others`` has.  Invalid phones match nothing
    and do not go through the join."""
    known = others.filter("phone_valid").select("studio_id", "phone").distinct()
    return rows.filter("phone_valid").join(known, ["studio_id", "phone"], "left_anti").select(*rows.columns).unionByName(
        rows.filter(~F.coalesce(F.col("phone_valid"), F.lit(False))))


def merged_leads(leads: DataFrame) -> DataFrame:
    """I-07 (ours): a lead is ``merged`` when any earlier lead of the client was still open (not
    closed, or closed after) at the moment this lead was created.

    ``merged_into`` is the earlier lead that stays open longest (then the later one): the
    running maximum of the closing times of all earlier leads.
    """
    l = leads.filter("phone_valid").select("studio_id", "client_id", "lead_id", "created_at", "closed_at")
    until = F.struct(F.coalesce("closed_at", F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")).alias("until"),
                     "created_at", "lead_id")
    p = running_max(l, ["studio_id", "client_id"], "created_at", "lead_id", until, out="_open")
    return p.filter(F.col("_open.until") > F.col("created_at")).select(
        "studio_id", "client_id", "lead_id", F.col("_open.lead_id").alias("merged_into"), "created_at")


def client_timeline(leads: DataFrame, bookings: DataFrame, ad_leads: DataFrame) -> DataFrame:
    """I-08: every client's records across the three sources, in time order."""
    # the text below the client id is the key: it compresses, the digest of 32 digits does not
    r = _records(leads, bookings, ad_leads).withColumn("_client", F.concat_ws(":", "studio_id", "phone"))
    r = r.withColumn("_tb", F.concat_ws(":", "source", "rec_id"))
    out = seq_number(r, ["_client"], "ts", "_tb", out="seq")
    return out.select(F.md5("_client").alias("client_id"), "studio_id", "ts", "source", "rec_id", "seq")
