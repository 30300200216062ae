"""The scheduled run over all studios: one Spark job per step, no driver loop.

``run_all`` is the daily run of the funnel step by step:

1. read the studio registry; studios with an open gate are skipped (A-18);
2. normalise and stage the inputs (S2, S2b, S2c);
3. reconcile and raise gates (S3, A-04, A-17);
4. compute the metric tables (S4, S4b) and the alerts (S5a);
5. write each table by ``studio_id`` with dynamic partition overwrite, and
   upsert the normalised leads (S-08).

Every write replaces only the partitions of the studios it ran, so re-running a day
gives the same tables.  The consolidated rows (studio 'all') are written when no active
studio is held back by a gate; else they stay as the last complete run left them, like
the rows of the studios that are held back.

Usage: python -m leadlens.jobs --sf-dir DIR --out DIR [--as-of 2001-08-01]
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens import config as C
from leadlens.plans import alerts as AL
from leadlens.plans import event_metrics as T
from leadlens.plans import metrics as M
from leadlens.plans import reconcile as R
from leadlens.plans.staging import stage_all
from leadlens.registry import Ctx
from leadlens.sources import fixtures as fx
from leadlens.sources.landed import active_studios
from leadlens.sources.sinks import _exists, in_partitions, replace_keys, upsert, write_metric


def _runnable(spark: SparkSession, ctx: Ctx, out: str) -> DataFrame:
    gates_path = os.path.join(out, "ops_gates")
    gates = (spark.read.parquet(gates_path) if _exists(spark, gates_path)
             else spark.createDataFrame([], "studio_id string, alert_id string, status string"))
    return AL.runnable_studios(fx.studios(ctx.t), gates).select("studio_id")


def run_all(spark: SparkSession, sf_dir: str, out: str, as_of: str = fx.AS_OF_STAR,
            loaded_at: str | None = None) -> dict[str, str]:
    """Run every step for the runnable studios; returns table name -> path."""
    ctx = Ctx(spark, sf_dir)
    stage_all(ctx, [["bookings", "leads", "ad_leads", "lead_events"], ["leads_booked", "snapshots"]])
    loaded_at = loaded_at or f"{as_of} 22:30:00"
    studios = _runnable(spark, ctx, out)
    keep = lambda df: df.join(studios, "studio_id", "left_semi")
    leads_booked = keep(ctx.leads_booked)
    bookings = keep(ctx.bookings)
    spend = keep(fx.ad_spend(ctx.t))
    snaps = keep(ctx.snapshots)
    events = keep(ctx.lead_events)

    recon = R.reconcile_bookings(leads_booked)
    cfg = AL.config_table(spark)
    a04 = AL.alert_a04(recon, cfg, as_of)
    alerts = (AL.alert_a01(leads_booked, C.DEFAULT_THRESHOLDS["a01_conversion_min"])
              .unionByName(AL.alert_a02(bookings, C.DEFAULT_THRESHOLDS["a02_no_show_max"]))
              .unionByName(a04.drop("escalate")))
    complete = active_studios(fx.studios(ctx.t)).join(studios, "studio_id", "left_anti").isEmpty()
    covers = studios.unionByName(spark.range(1).select(F.lit("all").alias("studio_id"))) if complete else studios
    tables = {
        "metrics_daily_summary": M.daily_summary(leads_booked, bookings),
        "metrics_lead_to_booking": M.lead_to_booking(leads_booked),
        "metrics_channel_roi": M.channel_economics(leads_booked, spend),
        "metrics_monthly_cohorts": M.monthly_cohorts(bookings, spend),
        "metrics_funnel_transitions": T.transitions(events),
        "metrics_lead_stage_durations": T.stage_durations(snaps),
        "metrics_historical_funnel": T.historical_funnel(snaps, fx.AS_OF_EVENTS),
        "ops_active_alerts": alerts,
    }
    paths = {}
    for name, df in tables.items():
        path = os.path.join(out, name)
        write_metric(df if complete else df.filter(F.col("studio_id") != "all"), path, ["studio_id"], loaded_at, covers)
        paths[name] = path
    raised = AL.open_gates(a04).select("studio_id", "alert_id", F.col("opened_on").cast("timestamp_ntz").alias("ts"),
                                       F.lit("raised").alias("kind"), F.lit("").alias("who"))
    paths["ops_gates"] = _keep_gates(spark, out, raised)
    staging = os.path.join(out, "staging_leads_normalized")
    # partitioned by studio and creation month: a run rewrites only the months its batch touches
    batch = (keep(ctx.leads).withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))
             .withColumn("created_month", F.date_format("created_at", "yyyy-MM")))
    upsert(spark, staging, batch, ["studio_id", "lead_id", "source"], ["updated_at", "loaded_at"],
           ["studio_id", "created_month"])
    paths["staging_leads_normalized"] = staging
    return paths


GATE_EVENTS = "studio_id string, alert_id string, ts timestamp_ntz, kind string, who string"


def _keep_gates(spark: SparkSession, out: str, events: DataFrame) -> str:
    """Adds findings and acknowledgements to the table of gate events (each stands once, however
    often a run is repeated) and derives the gates of the studios concerned from it."""
    log, path = os.path.join(out, "ops_gate_events"), os.path.join(out, "ops_gates")
    columns = [c.split()[0] for c in GATE_EVENTS.split(", ")]
    upsert(spark, log, events, columns, [], ["studio_id"])
    studios = events.select("studio_id").distinct().collect()  # of this run's gates
    known = spark.read.schema(GATE_EVENTS).parquet(log).filter(in_partitions(studios, ["studio_id"]))
    history = AL.gate_history(
        known.filter("kind = 'raised'").select("studio_id", "alert_id", F.col("ts").alias("raised_at")),
        known.filter("kind = 'ack'").select("studio_id", "alert_id", F.col("ts").alias("ack_at"), F.col("who").alias("ack_by")))
    replace_keys(spark, path, history, ["studio_id"], ["studio_id"])
    return path


def acknowledge(spark: SparkSession, out: str, acks: DataFrame) -> None:
    """A-19: apply acknowledgements (studio_id, alert_id, ack_by, ack_at) to the gates; a
    resolved studio is processed again by the next run, and the gate keeps when it was
    resolved and by whom when a later run opens it again."""
    if _exists(spark, os.path.join(out, "ops_gate_events")):
        _keep_gates(spark, out, acks.select("studio_id", "alert_id", F.col("ack_at").alias("ts"), F.lit("ack").alias("kind"),
                                            F.coalesce("ack_by", F.lit("")).alias("who")))


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--as-of", default=fx.AS_OF_STAR)
    a = ap.parse_args()
    spark = SparkSession.builder.getOrCreate()
    for name, path in run_all(spark, a.sf_dir, a.out, a.as_of).items():
        print(name, path)


if __name__ == "__main__":
    main()
