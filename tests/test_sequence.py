"""Skew-safe sequence operators against brute force, with one hot key."""

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from leadlens.operators.dedupe import latest_per_key
from leadlens.operators.sequence import next_match, next_row, prev_row, seq_number


def _rows(n=400, seed=7):
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 9)}"
        ts = base + dt.timedelta(minutes=30 * rnd.randint(0, 48 * 6))  # ties, several hours and days
        out.append((key, ts, i, rnd.choice("abc")))
    return out


@pytest.mark.parametrize("bucket", ["day", "hour"])
def test_prev_next_seq(spark, bucket):
    rows = _rows()
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, id long, v string")
    p = {r["id"]: (r["prev_ts"], r["prev_v"]) for r in prev_row(df, ["k"], "ts", "id", ["v"], bucket=bucket).collect()}
    n = {r["id"]: (r["next_ts"], r["next_v"]) for r in next_row(df, ["k"], "ts", "id", ["v"], bucket=bucket).collect()}
    s = {r["id"]: r["seq"] for r in seq_number(df, ["k"], "ts", "id", bucket=bucket).collect()}
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by_key.setdefault(r[0], []).append(r)
    for seq in by_key.values():
        for i, r in enumerate(seq):
            prev = seq[i - 1] if i else None
            nxt = seq[i + 1] if i + 1 < len(seq) else None
            assert p[r[2]] == ((prev[1], prev[3]) if prev else (None, None))
            assert n[r[2]] == ((nxt[1], nxt[3]) if nxt else (None, None))
            assert s[r[2]] == i + 1


@pytest.mark.parametrize("bucket", ["day", "hour"])
def test_next_match(spark, bucket):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    left = [("hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 4)}", base + dt.timedelta(hours=rnd.randint(0, 200)), i)
            for i in range(200)]
    right = [("hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 4)}", base + dt.timedelta(hours=rnd.randint(0, 200)),
              1000 + rnd.randint(0, 50), rnd.choice("xy")) for _ in range(300)]
    L = spark.createDataFrame(left, "k string, t timestamp_ntz, lid long")
    R = spark.createDataFrame(right, "k string, rt timestamp_ntz, rid long, pay string")
    got = {r["lid"]: (r["m"]["ts"], r["m"]["tb"]) if r["m"] else None
           for r in next_match(L, R, ["k"], "t", "rt", "rid", ["pay"], out="m", bucket=bucket).collect()}
    assert len(got) == len(left)
    for k, t, lid in left:
        cands = sorted((rt, rid) for rk, rt, rid, _ in right if rk == k and rt >= t)
        assert got[lid] == (cands[0] if cands else None)


def test_latest_per_key_total_order(spark):
    rows = [(1, 5, "b"), (1, 5, "c"), (1, 3, "z"), (2, None, "a"), (2, 1, "a")]
    df = spark.createDataFrame(rows, "k int, o int, x string")
    got = {r["k"]: (r["o"], r["x"]) for r in latest_per_key(df, ["k"], ["o"]).collect()}
    assert got == {1: (5, "c"), 2: (1, "a")}


def test_hot_key_is_split_across_tasks(spark):
    """A key with most rows, spread over many days, is not processed by one task."""
    base = dt.datetime(2024, 1, 1)
    left = [("hot", base + dt.timedelta(days=d, hours=1), d) for d in range(60)]
    right = [("hot", base + dt.timedelta(days=d, hours=h), 1000 + 24 * d + h, "x") for d in range(60) for h in (0, 5)]
    L = spark.createDataFrame(left, "k string, t timestamp_ntz, lid long")
    R = spark.createDataFrame(right, "k string, rt timestamp_ntz, rid long, pay string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        res = next_match(L, R, ["k"], "t", "rt", "rid", ["pay"], out="m")
        parts = res.select(F.spark_partition_id().alias("p")).distinct().count()
        got = {r.lid: r.m.tb for r in res.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert parts > 1
    assert got == {d: 1000 + 24 * d + 5 for d in range(60)}


def test_match_by_time_length_blocking_is_exact(spark):
    """Blocked fuzzy time match equals the brute force over all pairs."""
    from leadlens.plans.identity import match_by_time
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    names = ["anna", "anna k", "annakarenina", "ivan", "ivanov", "ivanova", "", "petr", "petra", "olga"]
    mk = lambda i: ("s", str(i), rnd.choice(names), base + dt.timedelta(hours=rnd.randint(0, 96)))
    L = [mk(i) for i in range(60)]
    R = [mk(1000 + i) for i in range(60)]
    schema = "studio_id string, rec_id string, name string, ts timestamp_ntz"
    got = {(r.rec_id, r.r_id) for r in match_by_time(spark.createDataFrame(L, schema),
                                                     spark.createDataFrame(R, schema), 24, 0.8).collect()}

    def lev(a, b):
        prev = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            cur = [i]
            for j, cb in enumerate(b, 1):
                cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
            prev = cur
        return prev[-1]

    want = {(l[1], r[1]) for l in L for r in R
            if abs((l[3] - r[3]).total_seconds()) <= 86400
            and round(1 - lev(l[2], r[2]) / max(len(l[2]), len(r[2]), 1), 4) > 0.8}
    assert got == want
