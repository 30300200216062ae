"""Ordered-sequence operators that stay parallel when one key is hot.

A plain ``Window.partitionBy(key)`` sorts every row of a key in one task.
These helpers split each key's sequence by calendar day:

* inside a (key, day) group the usual window runs;
* across days a per-(key, day) aggregate (one row per key and day, made with
  map-side partial aggregation) carries the boundary value, and a window over
  that small table (bounded by the number of days) finds the neighbour day;
* the carry is joined back many-to-one on (key, day), so no pairs are built.

The only remaining unit of work is a single key on a single day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DAY = "_seq_day"
BUCKET = "day"


def _bucket(ts: str, unit: str | None) -> Column:
    """Time bucket of a row; 'day' by default, any ``date_trunc`` unit (e.g. 'hour')."""
    unit = unit or BUCKET
    return F.to_date(F.col(ts)) if unit == "day" else F.date_trunc(unit, F.col(ts))


def _cols(names):
    return [F.col(n) for n in names]


def prev_row(df: DataFrame, keys: list[str], ts: str, tiebreak: str,
             values: list[str], prefix: str = "prev_", bucket: str | None = None) -> DataFrame:
    """Add ``prefix+ts`` and ``prefix+v`` = the previous row of the same key.

    Order is (ts, tiebreak); the first row of a key gets NULLs.
    """
    carried = [ts] + [v for v in values if v != ts]
    base = df.withColumn(_DAY, _bucket(ts, bucket))
    w_in = Window.partitionBy(*keys, _DAY).orderBy(F.col(ts), F.col(tiebreak))
    d = base.select("*", F.lag(F.lit(1)).over(w_in).isNull().alias("_seq_first"),
                    *[F.lag(F.col(c)).over(w_in).alias(prefix + c) for c in carried])
    last = (base.groupBy(*keys, _DAY)
            .agg(F.max(F.struct(F.col(ts).alias("_o1"), F.col(tiebreak).alias("_o2"),
                                *[F.col(c).alias("v_" + c) for c in carried])).alias("_last")))
    w_days = Window.partitionBy(*keys).orderBy(F.col(_DAY))
    carry = last.select(*keys, _DAY, F.lag("_last").over(w_days).alias("_carry"))
    out = d.join(carry, keys + [_DAY], "left")
    fixed = {prefix + c: F.when(F.col("_seq_first"), F.col("_carry.v_" + c)).otherwise(F.col(prefix + c))
             for c in carried}
    return out.select(*[fixed.get(c, F.col(c)).alias(c) for c in d.columns
                        if c not in ("_seq_first", _DAY)])


def next_row(df: DataFrame, keys: list[str], ts: str, tiebreak: str,
             values: list[str], prefix: str = "next_", bucket: str | None = None) -> DataFrame:
    """Add ``prefix+ts`` and ``prefix+v`` = the next row of the same key (NULL for the last)."""
    carried = [ts] + [v for v in values if v != ts]
    base = df.withColumn(_DAY, _bucket(ts, bucket))
    w_in = Window.partitionBy(*keys, _DAY).orderBy(F.col(ts), F.col(tiebreak))
    d = base.select("*", F.lead(F.lit(1)).over(w_in).isNull().alias("_seq_last"),
                    *[F.lead(F.col(c)).over(w_in).alias(prefix + c) for c in carried])
    first = (base.groupBy(*keys, _DAY)
             .agg(F.min(F.struct(F.col(ts).alias("_o1"), F.col(tiebreak).alias("_o2"),
                                 *[F.col(c).alias("v_" + c) for c in carried])).alias("_first")))
    w_days = Window.partitionBy(*keys).orderBy(F.col(_DAY))
    carry = first.select(*keys, _DAY, F.lead("_first").over(w_days).alias("_carry"))
    out = d.join(carry, keys + [_DAY], "left")
    fixed = {prefix + c: F.when(F.col("_seq_last"), F.col("_carry.v_" + c)).otherwise(F.col(prefix + c))
             for c in carried}
    return out.select(*[fixed.get(c, F.col(c)).alias(c) for c in d.columns
                        if c not in ("_seq_last", _DAY)])


def next_match(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str,
               right_ts: str, right_tiebreak: str, right_values: list[str],
               out: str = "match", bucket: str | None = None) -> DataFrame:
    """Forward as-of join.

    For every left row, the right row with equal ``keys`` and the smallest
    ``(right_ts, right_tiebreak)`` with ``right_ts >= left_ts``; returned as a
    struct column ``out`` with fields ts, tb and ``right_values`` (NULL if none).
    Left rows keep their multiplicity; no left x right pairs are formed.
    """
    cand = F.struct(F.col(right_ts).alias("ts"), F.col(right_tiebreak).alias("tb"),
                    *[F.col(v) for v in right_values])
    rgt = right.select(*_cols(keys), _bucket(right_ts, bucket).alias(_DAY), F.lit(0).alias("_k"),
                       F.col(right_ts).alias("_sts"), cand.alias("_cand"))
    ctype = rgt.schema["_cand"].dataType
    lft = left.select("*", _bucket(left_ts, bucket).alias(_DAY), F.lit(1).alias("_k"),
                      F.col(left_ts).alias("_sts"), F.lit(None).cast(ctype).alias("_cand"))
    u = lft.unionByName(rgt, allowMissingColumns=True)
    w_same = (Window.partitionBy(*keys, _DAY)
              .orderBy(F.col("_sts").desc(), F.col("_k").asc(), F.col("_cand.tb").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    same = (u.select("*", F.last("_cand", ignorenulls=True).over(w_same).alias("_m1"))
            .filter(F.col("_k") == 1))
    # later days: earliest candidate per (key, day) vs. distinct left days
    # per-(key, day) summaries, partially aggregated before their shuffle
    rday = rgt.groupBy(*keys, _DAY).agg(F.lit(0).alias("_k"), F.min("_cand").alias("_cand"))
    lday = (lft.select(*keys, _DAY).distinct()
            .select(*keys, _DAY, F.lit(1).alias("_k"), F.lit(None).cast(ctype).alias("_cand")))
    w_days = (Window.partitionBy(*keys).orderBy(F.col(_DAY).desc(), F.col("_k").desc())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    later = (lday.unionByName(rday)
             .select(*keys, _DAY, "_k", F.last("_cand", ignorenulls=True).over(w_days).alias("_m2"))
             .filter(F.col("_k") == 1)
             .select(*keys, _DAY, "_m2"))
    res = same.join(later, keys + [_DAY], "left")
    return res.select(*[F.col(c) for c in left.columns], F.coalesce(F.col("_m1"), F.col("_m2")).alias(out))


def seq_number(df: DataFrame, keys: list[str], ts: str, tiebreak: str,
               out: str = "seq", bucket: str | None = None) -> DataFrame:
    """1-based position of each row in its key's (ts, tiebreak) order.

    In-day ``row_number`` plus the row count of all earlier days of the key
    (a running sum over the per-day counts, one row per key and day).
    """
    base = df.withColumn(_DAY, _bucket(ts, bucket))
    w_in = Window.partitionBy(*keys, _DAY).orderBy(F.col(ts), F.col(tiebreak))
    d = base.withColumn("_rn", F.row_number().over(w_in))
    counts = base.groupBy(*keys, _DAY).agg(F.count(F.lit(1)).alias("_n"))
    w_days = (Window.partitionBy(*keys).orderBy(F.col(_DAY))
              .rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select(*keys, _DAY, F.coalesce(F.sum("_n").over(w_days), F.lit(0)).alias("_base"))
    out_df = d.join(base, keys + [_DAY], "left")
    return out_df.withColumn(out, (F.col("_base") + F.col("_rn")).cast("bigint")).drop(_DAY, "_rn", "_base")


def running_max(df: DataFrame, keys: list[str], ts: str, tiebreak: str, value: Column,
                out: str, bucket: str | None = None) -> DataFrame:
    """Add ``out`` = the greatest ``value`` of all earlier rows of the key (NULL for the first).

    A prefix scan in two steps: the running maximum inside a (key, day), and the running
    maximum over the days' maxima (one row per key and day, combined map-side) before it.
    """
    base = df.withColumn(_DAY, _bucket(ts, bucket)).withColumn("_v", value)
    w_in = (Window.partitionBy(*keys, _DAY).orderBy(F.col(ts), F.col(tiebreak))
            .rowsBetween(Window.unboundedPreceding, -1))
    d = base.withColumn("_in", F.max("_v").over(w_in))
    w_days = (Window.partitionBy(*keys).orderBy(F.col(_DAY))
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = (base.groupBy(*keys, _DAY).agg(F.max("_v").alias("_day_max"))
             .select(*keys, _DAY, F.max("_day_max").over(w_days).alias("_carry")))
    res = d.join(carry, keys + [_DAY], "left")
    return res.select(*_cols(df.columns), F.greatest("_in", "_carry").alias(out))


def nearest_match(left: DataFrame, right: DataFrame, keys: list[str], ts: str, tiebreak: str,
                  out: str = "match", bucket: str | None = None) -> DataFrame:
    """For every left row the right row of equal ``keys`` that is nearest in ``ts`` (ties: the
    smaller ``tiebreak``), as a struct ``out`` of distance in microseconds and tiebreak: two
    as-of joins, forwards and on mirrored time, so no pairs are formed."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))
    found = left.withColumn("_us", micros)
    for sign, name in ((1, "_later"), (-1, "_earlier")):
        at = F.timestamp_micros(micros * sign)
        r = right.select(*keys, at.alias("_at"), F.col(tiebreak).alias("_tb"), micros.alias("_r_us"))
        found = next_match(found.withColumn("_at", at), r, keys, "_at", "_at", "_tb", ["_r_us"], out=name,
                           bucket=bucket).drop("_at")
    near = lambda c: F.when(F.col(c).isNotNull(), F.struct(
        F.abs(F.col("_us") - F.col(f"{c}._r_us")).alias("us"), F.col(f"{c}.tb").alias("tb")))
    return found.select(*_cols(left.columns), F.least(near("_later"), near("_earlier")).alias(out))
