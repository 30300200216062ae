"""Sinks: idempotent upsert on Parquet (S-08), metric writes (S-13), key replacement.

Parquet has no MERGE.  An upsert reads only the target partitions the batch
touches, unions them with the batch, keeps the latest row per key in a total
order (an aggregate, see ``latest_per_key``), writes the result to a staging
folder next to the target and then overwrites exactly those partitions
(dynamic partition overwrite).  Running the same batch twice leaves the same
table as running it once.

* Touched partitions are those the batch writes to *and* those its keys lie in now.  The
  latter come from a locator table next to the target (key -> partition, dealt to
  ``LOCATOR_BUCKETS`` folders by key), so a key whose partition value changes is taken out of
  its old partition.  Keys that contain the partition columns need no locator.
* Only the list of touched partitions, whose number is that of folders, comes to the driver;
  it becomes a predicate of literals, so that the scan prunes folders when it is planned.
* The locator is appended to before the target is written and never rewritten by an upsert: at
  any time it holds every partition a key may lie in.  A row of it that is out of date costs a
  read; ``compact_locator`` builds it anew.
* A partition that loses its last row is deleted, after the others are written.  A run that was
  broken off is completed by running it again.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadlens.operators.dedupe import latest_per_key

LOCATOR_BUCKETS = 64
#: touched partitions that are listed one by one; beyond, the values of each column are
MAX_LISTED = 2000


def _path(spark: SparkSession, path: str, uri: bool = False):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path)) if uri else jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str, uri: bool = False) -> None:
    p, fs = _path(spark, path, uri)
    fs.delete(p, True)


@contextmanager
def _staging(spark: SparkSession, target_path: str):
    """A folder next to the target that goes when the write is over or has failed."""
    path = f"{target_path}__staging/{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        _delete(spark, path)


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def in_partitions(parts: list, cols: list[str]) -> Column:
    """Predicate of literals for the partitions ``parts`` (rows of ``cols``, nulls allowed): a
    filter with it prunes folders at planning time, which a join with ``parts`` does not."""
    def one_of(col: str, values: set) -> Column:
        known = [v for v in values if v is not None]
        hit = F.col(col).isin(known) if known else F.lit(False)
        return hit | F.col(col).isNull() if None in values else hit

    if len(parts) > MAX_LISTED:
        out = F.lit(True)
        for i, c in enumerate(cols):
            out = out & one_of(c, {p[i] for p in parts})
        return out
    groups = defaultdict(set)
    for p in parts:
        groups[tuple(p)[:-1]].add(p[len(cols) - 1])
    out = F.lit(False)
    for head, last in groups.items():
        hit = one_of(cols[-1], last)
        for c, v in zip(cols, head):
            hit = (F.col(c).isNull() if v is None else F.col(c) == F.lit(v)) & hit
        out = out | hit
    return out


def _same(a: str, b: str, cols: list[str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def _with_bucket(df: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    return df.select(*keys, *[c for c in cols if c not in keys],
                     F.pmod(F.xxhash64(*keys), F.lit(LOCATOR_BUCKETS)).cast("int").alias("_kb"))


def compact_locator(spark: SparkSession, target_path: str, keys: list[str], partition_cols: list[str],
                    schema: StructType | None = None) -> None:
    """Writes the locator of a table anew from its rows."""
    read = spark.read.schema(schema) if schema else spark.read
    rows = _with_bucket(read.parquet(target_path), keys, partition_cols).distinct()
    rows.write.mode("overwrite").partitionBy("_kb").parquet(f"{target_path}__locator")


def _located(spark: SparkSession, target_path: str, batch: DataFrame, keys: list[str], partition_cols: list[str]):
    """(partitions that the batch's keys may lie in, locator rows that the batch adds)."""
    path, pairs = f"{target_path}__locator", _with_bucket(batch, keys, partition_cols).distinct()
    if not _exists(spark, path):
        if not _exists(spark, target_path):
            return None, pairs
        compact_locator(spark, target_path, keys, partition_cols, batch.schema)
    buckets = [r._kb for r in pairs.select("_kb").distinct().collect()]  # LOCATOR_BUCKETS at most
    known = spark.read.schema(pairs.schema).parquet(path).filter(F.col("_kb").isin(buckets)).alias("k")
    old = known.join(pairs.select(*keys).distinct().alias("b"), _same("k", "b", keys), "left_semi")
    cols = pairs.columns
    added = pairs.alias("b").join(known, _same("b", "k", cols), "left_anti")
    return old.select(*partition_cols), added


def upsert(spark: SparkSession, target_path: str, batch: DataFrame, keys: list[str],
           order_cols: list[str], partition_cols: list[str]) -> None:
    """INSERT .. ON CONFLICT (keys) DO UPDATE, for a partitioned Parquet table.

    ``order_cols`` decide which row wins (greatest first, then all other
    columns); the batch must carry the partition columns.  The winner's partition
    value decides where the key lies; an older row that loses moves nothing.
    """
    with _staging(spark, target_path) as staging:
        batch = _stored(batch, f"{staging}/batch")
        touched = batch.select(*partition_cols)
        if not set(partition_cols) <= set(keys):
            old, added = _located(spark, target_path, batch, keys, partition_cols)
            touched = touched if old is None else touched.unionByName(old)
            _stored(added, f"{staging}/located").write.mode("append").partitionBy("_kb").parquet(
                f"{target_path}__locator")
        _replace(spark, target_path, touched, batch.schema, partition_cols, staging, lambda current: latest_per_key(
            batch if current is None else current.unionByName(batch), keys, order_cols))


def replace_keys(spark: SparkSession, target_path: str, fresh: DataFrame, key_cols: list[str],
                 partition_cols: list[str]) -> None:
    """Replace every row of the keys present in ``fresh`` (delete + insert per key).  A key's
    partition values must follow from the key."""
    with _staging(spark, target_path) as staging:
        fresh = _stored(fresh, f"{staging}/batch")

        def merged(current: DataFrame | None) -> DataFrame:
            if current is None:
                return fresh
            gone = fresh.select(*key_cols).distinct().alias("g")
            return current.alias("c").join(gone, _same("c", "g", key_cols), "left_anti").unionByName(fresh)

        _replace(spark, target_path, fresh.select(*partition_cols), fresh.schema, partition_cols, staging, merged)


def _replace(spark: SparkSession, target_path: str, touched: DataFrame, schema: StructType,
             partition_cols: list[str], staging: str, merge) -> None:
    """Puts ``merge(rows of the touched partitions)`` in their place."""
    current, had = None, None
    if _exists(spark, target_path):
        # types of partition columns are the batch's: folder names alone would be guessed
        current = spark.read.schema(schema).parquet(target_path).filter(
            in_partitions(touched.distinct().collect(), partition_cols))
        had = current.select(*partition_cols, F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias(
            "_folder")).distinct()
        current = current.select(*schema.names)
    out = _stored(merge(current), f"{staging}/merged")
    emptied = []
    if had is not None:
        emptied = [r._folder for r in had.alias("h").join(
            out.select(*partition_cols).distinct().alias("o"), _same("h", "o", partition_cols), "left_anti").collect()]
    _overwrite_partitions(out, target_path, partition_cols)
    for folder in emptied:
        _delete(spark, folder, uri=True)


def write_metric(df: DataFrame, path: str, partition_cols: list[str], loaded_at: str,
                 covers: DataFrame | None = None) -> None:
    """S-13: replace the metric's partitions present in ``df`` and stamp ``loaded_at``.

    ``covers``: the partitions this run is answerable for (rows of ``partition_cols``); those
    it has no rows for any more are emptied, all others stay as they are.
    """
    spark = df.sparkSession
    out = df.withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz"))
    if covers is None:
        _overwrite_partitions(out, path, partition_cols)
        return
    with _staging(spark, path) as staging:
        out = _stored(out, f"{staging}/metric")
        touched = covers.select(*partition_cols).unionByName(out.select(*partition_cols))
        _replace(spark, path, touched, out.schema, partition_cols, staging, lambda current: out)
