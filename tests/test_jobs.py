"""The scheduled run: tables written, idempotent, gated studios skipped next time."""

import os

from leadlens.jobs import run_all
from tests.conftest import SF_SMALL


def _snapshot(spark, paths):
    out = {}
    for name, p in paths.items():
        df = spark.read.parquet(p)
        out[name] = sorted((tuple(r) for r in df.drop(*[c for c in df.columns if c == "loaded_at"]).collect()),
                           key=repr)
    return out


def test_run_all_idempotent_and_gated(spark, tmp_dir):
    out = os.path.join(tmp_dir, "warehouse")
    paths = run_all(spark, SF_SMALL, out)
    first = _snapshot(spark, paths)
    assert first["metrics_daily_summary"] and first["metrics_historical_funnel"]
    gated = {r[0] for r in first["ops_gates"]}
    # second run: gated studios are skipped, their partitions stay as they were
    paths2 = run_all(spark, SF_SMALL, out)
    second = _snapshot(spark, paths2)
    assert second == first
    studios_run = {r.studio_id for r in spark.read.parquet(paths2["metrics_channel_roi"]).select("studio_id").distinct().collect()}
    assert gated.isdisjoint({"studio_4"})  # inactive studio never runs
    assert "studio_4" not in studios_run


def test_acknowledged_gate_reopens_studio(spark, tmp_dir):
    import datetime as dt
    from leadlens.jobs import acknowledge
    out = os.path.join(tmp_dir, "wh2")
    paths = run_all(spark, SF_SMALL, out)
    gates = spark.read.parquet(paths["ops_gates"])
    opened = [r.studio_id for r in gates.filter("status = 'open'").collect()]
    if not opened:
        return  # no gate at this scale: nothing to acknowledge
    acks = spark.createDataFrame([(s, "A04", "ops", dt.datetime(2001, 8, 2)) for s in opened],
                                 "studio_id string, alert_id string, ack_by string, ack_at timestamp_ntz")
    acknowledge(spark, out, acks)
    g = {r.studio_id: r.status for r in spark.read.parquet(paths["ops_gates"]).collect()}
    assert all(g[s] == "resolved" for s in opened)
    from leadlens.jobs import _runnable
    from leadlens.registry import Ctx
    runnable = {r.studio_id for r in _runnable(spark, Ctx(spark, SF_SMALL), out).collect()}
    assert set(opened) <= runnable


def test_gate_life_cycle(spark, tmp_dir):
    """Three runs and two acknowledgements: opened, resolved, opened again, resolved; each keeps its own end."""
    import datetime as dt
    from leadlens.jobs import _keep_gates, acknowledge
    day = lambda n: dt.datetime(2024, 1, n)
    run = lambda *rows: _keep_gates(spark, tmp_dir, spark.createDataFrame(
        [(s, "A04", day(d), "raised", "") for s, d in rows], "studio_id string, alert_id string, ts timestamp_ntz, kind string, who string"))
    ack = lambda *rows: acknowledge(spark, tmp_dir, spark.createDataFrame(
        [(s, "A04", who, day(d)) for s, who, d in rows], "studio_id string, alert_id string, ack_by string, ack_at timestamp_ntz"))
    gates = lambda: sorted((r.studio_id, r.episode, r.status, r.opened_at.day, r.resolved_at and r.resolved_at.day, r.ack_by)
                           for r in spark.read.parquet(path).collect())
    path = run(("s1", 1), ("s2", 1))
    run(("s1", 2), ("s1", 1))  # still open: nothing new
    assert gates() == [("s1", 1, "open", 1, None, None), ("s2", 1, "open", 1, None, None)]
    ack(("s1", "ann", 3), ("s1", "bob", 4), ("s3", "eve", 1))  # the second finds nothing open, the third no gate
    run(("s1", 5))
    want = [("s1", 1, "resolved", 1, 3, "ann"), ("s1", 2, "open", 5, None, None), ("s2", 1, "open", 1, None, None)]
    assert gates() == want
    ack(("s1", "bob", 6))
    ack(("s1", "bob", 6))
    assert gates() == [want[0], ("s1", 2, "resolved", 5, 6, "bob"), want[2]]
