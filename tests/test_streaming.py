"""Streaming: dedup within watermark, foreachBatch event maintenance, daily windows."""

import os

from pyspark.sql import functions as F

from leadlens.plans.events import lead_events
from leadlens.sources import fixtures as fx
from leadlens.streaming.changes import apply_changes, stream_daily, stream_states
from tests.conftest import SF_SMALL


def test_stream_matches_batch(spark, tmp_dir):
    states = fx.lead_states(fx.Tables(spark, SF_SMALL))
    src = os.path.join(tmp_dir, "landed")
    # two deliveries of overlapping files: the second repeats half of the first
    states.filter("obs_id % 2 = 0").write.parquet(os.path.join(src, "f1"))
    states.write.parquet(os.path.join(src, "f2"))
    stream = stream_states(spark, src + "/*", delay="3650 days")
    st_path, ev_path = os.path.join(tmp_dir, "states"), os.path.join(tmp_dir, "events")
    q = (stream.writeStream.foreachBatch(apply_changes(st_path, ev_path))
         .option("checkpointLocation", os.path.join(tmp_dir, "ck1")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.read.parquet(ev_path).select("lead_id", "event_id", "event_type", "stage_to")
    want = lead_events(states).select("lead_id", "event_id", "event_type", "stage_to")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_stream_daily_windows(spark, tmp_dir):
    states = fx.lead_states(fx.Tables(spark, SF_SMALL))
    src = os.path.join(tmp_dir, "landed2")
    states.write.parquet(src)
    daily = stream_daily(stream_states(spark, src, delay="1 day"))
    q = (daily.writeStream.outputMode("append").format("memory").queryName("daily_counts")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck2")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("daily_counts")
    # append mode emits closed days only; all emitted days must equal the batch count
    batch = (states.groupBy(F.to_date("event_ts").alias("d"), "studio_id", "stage").agg(F.count("*").alias("n")))
    j = got.withColumn("d", F.to_date("day_start")).join(batch, ["d", "studio_id", "stage"])
    assert got.count() > 0 and j.filter("n != observations").count() == 0


def test_late_and_repeated_batches_equal_the_batch_result(spark, tmp_dir):
    """Observations arrive newest first and one batch twice: the events are those of the whole history."""
    states = fx.lead_states(fx.Tables(spark, SF_SMALL)).cache()
    st_path, ev_path = os.path.join(tmp_dir, "late_states"), os.path.join(tmp_dir, "late_events")
    put = apply_changes(st_path, ev_path, buckets=8)
    cuts = ["2024-01-20", "2024-01-08", "2023-01-01"]
    upper = None
    for i, low in enumerate(cuts):
        part = states.filter(F.col("event_ts") >= F.lit(low).cast("timestamp_ntz"))
        part = part if upper is None else part.filter(F.col("event_ts") < F.lit(upper).cast("timestamp_ntz"))
        put(part, i)
        upper = low
    put(states.filter(F.col("event_ts") >= F.lit("2024-01-20").cast("timestamp_ntz")), 3)
    cols = ["lead_id", "event_id", "event_type", "stage_from", "stage_to"]
    got, want = spark.read.parquet(ev_path).select(cols), lead_events(states).select(cols)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
