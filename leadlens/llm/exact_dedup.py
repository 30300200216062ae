"""Exact dedup: an extendible-hash index on shared files (operator 13).

The index is a folder of bucket files in the shared checkpoint folder, one Parquet folder
``bucket=b<bits>`` a bucket; a bucket owns the 64-bit keys that begin with its bits.

* Directory: distinct keys are counted by their first ``MAX_BITS`` bits.  A bucket with more
  than ``capacity`` keys splits on its next bit, and the directory doubles when the split
  bucket was as deep as the directory: all its ``2 ** depth`` slots then stand twice, split
  ones with a bucket each.  Counts by prefix decide every split of a batch in one pass.
* Map side: copies inside a window of a scan task are collapsed by their bytes to (key, text,
  largest id, rows), so a text that a third of all rows share is a row a window.
* Owner tasks: each bucket's rows go to the task that owns its key range, sorted by key.  The
  task streams over them and keeps the chain of the current key only: a text equal in bytes to
  one of the chain adds to it, another one (a collision) is chained behind.
* A document finds its entry by key and SHA-256; that two texts of a chain never share the
  SHA-256 is checked by the owner.

A second batch is added by passing the index before: its entries meet the new texts in their
owners, and a new generation is written; the old one stays readable.

Cases: a null text counts as empty, and is a text like any other; of rows that agree in id and
normalised text exactly one is kept; a null id is smaller than any other and stays only if its
group has no other id; an empty table gives an empty result and an index of one bucket; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlens.llm.common import LOWER, UPPER, ascii_lower, table, written

#: distinct keys that a bucket holds before it splits
CAPACITY = 4096
#: a bucket is not split below so many bits (a million buckets); deeper ones only grow
MAX_BITS = 20
#: bytes of text that a scan task holds to collapse copies
WINDOW = 32 << 20

ENTRY = ("bucket string, key bigint, chain int, sha256 binary, n_bytes bigint, text string, "
         "keep_id bigint, group_size bigint")


class Index(NamedTuple):
    directory: DataFrame  # slot, bucket, depth: 2 ** depth_of_directory rows
    entries: DataFrame    # ENTRY
    depth: int


def text_key(normal: Column) -> Column:
    return F.xxhash64(normal)


def _prefix(key: Column, bits: int) -> Column:
    """The first ``bits`` bits of a key as a number (none: 0)."""
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("bigint")


def directory_of(keys: DataFrame, capacity: int, max_bits: int = MAX_BITS) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) and the directory's depth for distinct ``keys``.

    A prefix with more than ``capacity`` keys is full; the buckets are the children of full
    prefixes that are not full themselves (or the root), all found from one table of counts.
    """
    spark = keys.sparkSession
    cells = keys.groupBy(_prefix(F.col("key"), max_bits).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    full = written(cells.select("n", "cell", F.explode(F.sequence(F.lit(0), F.lit(max_bits - 1))).alias("depth"))
                   .groupBy("depth", F.expr(f"shiftright(cell, {max_bits} - depth)").alias("prefix"))
                   .agg(F.sum("n").alias("n")).filter(F.col("n") > capacity).select("depth", "prefix"), "dedup-full")
    deepest = full.agg(F.max("depth")).first()[0]
    if deepest is None:
        return spark.range(1).select(F.col("id").alias("slot"), F.lit("b").alias("bucket"), F.lit(0).alias("depth")), 0
    g = deepest + 1
    leaves = full.select((F.col("depth") + 1).alias("depth"), F.explode(F.array(
        F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix")).join(full, ["depth", "prefix"], "left_anti")
    first = F.expr(f"shiftleft(prefix, {g} - depth)")
    slots = leaves.select(
        F.concat(F.lit("b"), F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0"))).alias("bucket"), "depth",
        F.explode(F.sequence(first, first + F.expr(f"shiftleft(1L, {g} - depth)") - 1)).alias("slot"))
    return written(slots.select("slot", "bucket", "depth"), "dedup-directory"), g


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def window(held):
        got = pa.Table.from_batches(held).group_by(["key", "text"], use_threads=False).aggregate(
            [("id", "max"), ([], "count_all")])
        return pa.table({"key": got["key"], "text": got["text"], "keep_id": got["id_max"],
                         "group_size": got["count_all"]}).to_batches(max_chunksize=2000)

    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= WINDOW:
            yield from window(held)
            held, size = [], 0
    if held:
        yield from window(held)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole buckets, sorted by bucket and key -> entries."""
    schema = pa.schema([("bucket", pa.string()), ("key", pa.int64()), ("chain", pa.int32()),
                        ("sha256", pa.binary()), ("n_bytes", pa.int64()), ("text", pa.string()),
                        ("keep_id", pa.int64()), ("group_size", pa.int64())])
    out, size = [], 0

    def entries(at, chain):
        if len({d for *_, d in chain}) < len(chain):
            raise ValueError(f"two texts of key {at} share a SHA-256")
        return [(*at, i, d, len(text), text, top, n) for i, (text, top, n, d) in enumerate(chain)]

    def batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.binary()).cast(pa.string()) if f.name == "text" else pa.array(c, f.type)
             for c, f in zip(zip(*rows), schema)], schema=schema)

    at, chain = None, []
    for b in batches:
        texts = b.column("text").cast(pa.binary())
        for i, (bucket, key, top, n) in enumerate(zip(*(b.column(c).to_pylist() for c in (
                "bucket", "key", "keep_id", "group_size")))):
            text = texts[i].as_py()
            if at != (bucket, key):
                done = entries(at, chain)
                out += done
                size += sum(x[4] for x in done)
                at, chain = (bucket, key), []
                if size >= WINDOW // 4 or len(out) >= 5000:
                    yield batch(out)
                    out, size = [], 0
            for e in chain:
                if e[0] == text:
                    e[1], e[2] = max((x for x in (e[1], top) if x is not None), default=None), e[2] + n
                    break
            else:
                chain.append([text, top, n, hashlib.sha256(text).digest()])
    out += entries(at, chain)
    if out:
        yield batch(out)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", before: Index | None = None,
                capacity: int = CAPACITY, key: Callable[[Column], Column] = text_key,
                max_bits: int = MAX_BITS) -> tuple[Index, DataFrame]:
    """The index with ``docs`` in it, and a row (id, rid, key, sha256) for each of them."""
    normal = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    given = docs.select(F.col(id_col).cast("bigint").alias("id"), normal.alias("text"))
    rows = written(given.select("id", F.monotonically_increasing_id().alias("rid"),
                                key(F.col("text")).cast("bigint").alias("key"),
                                F.unhex(F.sha2("text", 256)).alias("sha256")), "dedup-rows")
    keys = rows.select("key")
    texts = given.select("id", key(F.col("text")).cast("bigint").alias("key"), "text").mapInArrow(
        _collapse, "key bigint, text string, keep_id bigint, group_size bigint")
    if before is not None:
        keys = keys.unionByName(before.entries.select("key"))
        texts = texts.unionByName(before.entries.select("key", "text", "keep_id", "group_size"))
    directory, g = directory_of(keys.distinct(), capacity, max_bits)
    owned = (texts.withColumn("slot", _prefix(F.col("key"), g)).join(directory.select("slot", "bucket"), "slot")
             .repartition("bucket").sortWithinPartitions("bucket", "key")
             .select("bucket", "key", "text", "keep_id", "group_size"))
    entries = written(owned.mapInArrow(_own, ENTRY), "dedup-index", ["bucket"])
    return Index(directory, entries, g), rows


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", before: Index | None = None,
                **options) -> DataFrame:
    """A row per document: doc_id, keep_id, group_size, kept, text_sha256, chain (place in its
    key's chain).  With ``before``, groups span that index and the documents."""
    index, rows = build_index(docs, id_col, text_col, before, **options)
    found = rows.join(index.entries.select("key", "sha256", "chain", "keep_id", "group_size"), ["key", "sha256"])
    # rows that repeat id and text: the first stays; nearly always an empty table
    again = rows.groupBy("id", "key", "sha256").agg(F.min("rid").alias("first"), F.count(F.lit(1)).alias("n")).filter(
        "n > 1").select("first", "key", "sha256", F.col("id").alias("_id"))
    found = found.alias("f").join(again.alias("a"), (F.col("f.key") == F.col("a.key")) & (
        F.col("f.sha256") == F.col("a.sha256")) & F.col("f.id").eqNullSafe(F.col("a._id")), "left")
    return found.select(
        F.col("f.id").alias("doc_id"), "f.keep_id", "f.group_size",
        (F.col("f.id").eqNullSafe(F.col("f.keep_id"))
         & (F.col("a.first").isNull() | (F.col("f.rid") == F.col("a.first")))).alias("kept"),
        F.lower(F.hex("f.sha256")).alias("text_sha256"), "f.chain")


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op13_exact_dedup": op13_exact_dedup}

ORACLE = {"op13_exact_dedup": f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256, 0 AS chain
FROM d WINDOW w AS (PARTITION BY t)"""}
