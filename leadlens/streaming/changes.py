"""Structured Streaming over landed change files (W-01 .. W-03).

The batch pipeline stays the source of truth (whole periods, reconcile);
the stream keeps lead events fresh between runs:

* W-01 ``stream_states``: new files of lead-state observations, deduplicated
  within the watermark (``dropDuplicatesWithinWatermark``) so a re-delivered
  file does not double events, with bounded state.
* W-02 ``apply_changes``: ``foreachBatch`` appends the micro-batch's states to
  the state table, recomputes the events of the touched leads from their whole
  history (E-01/E-02) and replaces those leads' rows in the event table, so
  late and out-of-order observations land where event time says.
* W-03 ``stream_daily``: tumbling one-day counts per studio and stage in
  append mode, emitted once the watermark passes the day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.plans.events import LEAD_KEY, lead_events
from leadlens.sources.sinks import in_partitions, replace_keys

STATE_SCHEMA = ("lead_id bigint, studio_id string, source string, stage string, "
                "event_ts timestamp_ntz, obs_id bigint")


def stream_states(spark: SparkSession, path: str, delay: str = "1 day",
                  max_files: int | None = None) -> DataFrame:
    """W-01: streaming lead-state observations, deduplicated within the watermark."""
    r = spark.readStream.schema(STATE_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    df = r.parquet(path)
    # watermarks need TIMESTAMP; the wall-clock NTZ value is read in the session zone
    df = df.withColumn("event_time", F.col("event_ts").cast("timestamp"))
    return (df.withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark(["studio_id", "source", "lead_id", "obs_id"]))


LEAD_BUCKETS = 256


def lead_bucket(buckets: int = LEAD_BUCKETS):
    """Stable bucket of a lead; states and events are partitioned by (studio_id, lead_bucket)."""
    return F.pmod(F.xxhash64("source", "lead_id"), F.lit(buckets)).cast("int")


def apply_changes(states_path: str, events_path: str, buckets: int = LEAD_BUCKETS):
    """W-02: a ``foreachBatch`` function keeping the event table consistent.

    States and events are partitioned by (studio_id, lead_bucket), so a batch
    reads only the history of the buckets it touches and rewrites only those
    event partitions, not a whole studio.  The touched buckets (their number is
    that of folders) become a predicate of literals: the scan prunes them when it is
    planned, and a batch that was applied and comes again changes nothing.
    """

    def _apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.drop("event_time").withColumn("lead_bucket", lead_bucket(buckets))
        batch.write.mode("append").partitionBy("studio_id", "lead_bucket").parquet(states_path)
        touched = batch.select(*LEAD_KEY, "lead_bucket").distinct()
        parts = touched.select("studio_id", "lead_bucket").distinct().collect()
        history = (spark.read.schema(batch.schema).parquet(states_path)
                   .filter(in_partitions(parts, ["studio_id", "lead_bucket"]))
                   .join(touched.select(*LEAD_KEY), LEAD_KEY, "left_semi")
                   .dropDuplicates(["studio_id", "source", "lead_id", "obs_id"]))
        fresh = lead_events(history.drop("lead_bucket")).withColumn("lead_bucket", lead_bucket(buckets))
        replace_keys(spark, events_path, fresh, LEAD_KEY, ["studio_id", "lead_bucket"])

    return _apply


def stream_daily(states: DataFrame) -> DataFrame:
    """W-03: one-day tumbling counts of observations per studio and stage."""
    return (states.groupBy(F.window("event_time", "1 day").alias("w"), "studio_id", "stage")
            .agg(F.count(F.lit(1)).alias("observations"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("day_start"), "studio_id", "stage",
                    "observations"))
