"""Helpers shared by the operators: table reads, tokens, checkpoints, row keys."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel  # noqa: F401  (re-exported for callers that cache narrow tables)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.session import ensure_checkpoint_dir

#: words between ASCII white space, as a Java, RE2 and Python pattern
SPACE_WORD = r"[^\x20\x09-\x0D]+"
SPACE_WORD_RE = re.compile(SPACE_WORD)
#: ASCII capitals and their small letters; other letters stay as they are
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = {ord(a): b for a, b in zip(UPPER, LOWER)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def space_words(text: Column) -> Column:
    """Words of a text as an array; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SPACE_WORD), F.lit(0))


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: a lambda variable keeps the optimizer
    from copying a long expression into every place that uses it."""
    return F.transform(F.array(value), body)[0]


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs in here; the caller's come back after them."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_freed(spark: SparkSession):
    """Jobs in here give their shuffle files back when they end.  Otherwise these stay on the executors'
    disks until the driver's garbage collection comes upon them, though a table that is written needs
    them no more."""
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def saved(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: cut from its lineage,
    compressed, and read again with column pruning; ``by``: a folder for each value."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/leadlens-{name}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that each node of (a, b) edges can reach.

    Large-star and small-star steps on the edge table, each cut off by a checkpoint, until
    no edge changes; every step is a join and a grouping, nothing is collected but a count.
    A node with many edges is split: its smallest neighbour is a partial minimum.
    """
    both = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, before = saved(both), None
    while True:
        # large star: neighbours above a node move to its smallest neighbour
        near = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        e = near.filter(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = e.unionByName(low.select("a", F.col("m").alias("b")).filter(F.col("a") != F.col("b"))).distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        e = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter(F.col("a") != F.col("b"))
        e = saved(e.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        state = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    nodes = e.groupBy("a").agg(F.min("b").alias("comp")).withColumnRenamed("a", "node")
    return nodes.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def blocks_for(rows: int, per_block: int) -> int:
    return max(1, -(-rows // per_block))
