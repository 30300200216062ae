"""Staging tables: prepared inputs written once per run and read by every step.

The pipeline's normalised leads and bookings, the lead<->booking match, the
lead events and the SCD2 snapshots are the staging layer.  Each is written
as Parquet under the cluster's shared checkpoint folder (``spark.checkpoint.dir``)
the first time a step needs it and read back afterwards.  This cuts the
lineage: a step that uses a staging table in two branches reads files
instead of recomputing joins, dedup and as-of matching for each branch.
On executor loss the written files survive.

Staging jobs start with at least ``PARTS`` shuffle partitions, which adaptive execution
joins again where they are small: with a session's few partitions their sorts (joins,
deduplication, windows) would outgrow a task's memory and spill.

Set ``leadlens.staging.enabled=false`` in the session to plan everything
from the raw tables instead.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from leadlens.session import ensure_checkpoint_dir

_LOCK = threading.Lock()
_KEY_LOCKS: dict[tuple[str, str, str], threading.RLock] = {}
_STAGED: dict[tuple[str, str, str], str] = {}
_RUN = uuid.uuid4().hex
PARTS = 1024
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# session -> (jobs that run, the session's own value)
_WIDE: dict[int, tuple[int, str | None]] = {}


def enabled(spark: SparkSession) -> bool:
    return spark.conf.get("leadlens.staging.enabled", "true").lower() != "false"


@contextmanager
def wide_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs in here start with ``PARTS`` shuffle partitions or the session's own number, if greater.
    Several threads may be in here; the session's value comes back with the last one."""
    with _LOCK:
        jobs, own = _WIDE.get(id(spark), (0, spark.conf.get(_INITIAL, None)))
        _WIDE[id(spark)] = (jobs + 1, own)
        if not jobs:
            spark.conf.set(_INITIAL, str(max(PARTS, int(own or spark.conf.get("spark.sql.shuffle.partitions")))))
    try:
        yield
    finally:
        with _LOCK:
            jobs, own = _WIDE.pop(id(spark))
            if jobs > 1:
                _WIDE[id(spark)] = (jobs - 1, own)
            elif own is None:
                spark.conf.unset(_INITIAL)
            else:
                spark.conf.set(_INITIAL, own)


def staged(spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The staging table ``name`` derived from ``source`` (written once per application)."""
    if not enabled(spark):
        return build()
    key = (spark.sparkContext.applicationId, source, name)
    with _LOCK:  # one lock per table: different tables can be staged by concurrent jobs
        lock = _KEY_LOCKS.setdefault(key, threading.RLock())
    with lock:
        path = _STAGED.get(key)
        if path is None:
            base = ensure_checkpoint_dir(spark).rstrip("/")
            path = f"{base}/leadlens-staging/{_RUN}/{abs(hash(source)):x}/{name}"
            df = build()
            with wide_shuffles(spark):
                df.write.mode("overwrite").option("compression", "zstd").parquet(path)
            with _LOCK:
                _STAGED[key] = path
    return spark.read.parquet(path)


def stage_all(ctx, names_in_waves: list[list[str]]) -> None:
    """Stage tables wave by wave; the tables of one wave are independent and are
    written by concurrent Spark jobs (threads submitting to the same session)."""
    from concurrent.futures import ThreadPoolExecutor

    for wave in names_in_waves:
        with ThreadPoolExecutor(max_workers=len(wave)) as pool:
            list(pool.map(lambda n: getattr(ctx, n), wave))
