"""Load manifest (S-11): which load of a source a run reads, and the last complete one if today's is missing.

Loads are landed under ``root`` in folders (source, studio_id, load_id).  A load counts only once
its row is in the manifest, which is written after the data: a load that was broken off is
never read.  A repeated load of the same id replaces its folder and adds a manifest row; the
latest row of an id counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from leadlens.operators.dedupe import latest_per_key
from leadlens.sources.landed import active_studios
from leadlens.sources.sinks import _overwrite_partitions, in_partitions

PARTS = ["source", "studio_id", "load_id"]
MANIFEST = "source string, studio_id string, load_id string, rows bigint, loaded_at timestamp_ntz"


def land(spark: SparkSession, root: str, df: DataFrame, source: str, load_id: str, loaded_at: str) -> None:
    """Writes one load of a source (rows of any studios) and records it, studio by studio."""
    data = df.withColumns({"source": F.lit(source), "load_id": F.lit(load_id)})
    _overwrite_partitions(data, f"{root}/data", PARTS)
    written = spark.read.schema(data.schema).parquet(f"{root}/data").filter(
        (F.col("source") == source) & (F.col("load_id") == load_id))
    written.join(df.select("studio_id").distinct(), "studio_id", "left_semi").groupBy(*PARTS).agg(
        F.count(F.lit(1)).alias("rows")).withColumn("loaded_at", F.lit(loaded_at).cast("timestamp_ntz")).write.mode(
        "append").parquet(f"{root}/manifest")


def choose_loads(manifest: DataFrame, studios: DataFrame, sources: list[str], as_of: str) -> DataFrame:
    """A row per active studio and source: the latest load up to the day ``as_of``, with
    ``is_stale`` if it is not of that day, or nulls and ``is_missing`` if there is none.

    All rows of a load count, whatever their phones.  ``manifest``: MANIFEST.
    """
    day = F.lit(as_of).cast("date")
    known = latest_per_key(manifest.select(*PARTS, "rows", "loaded_at"), PARTS, ["loaded_at"])
    last = known.filter((F.to_date("loaded_at") <= day) & (F.col("rows") > 0)).groupBy("studio_id", "source").agg(
        F.max(F.struct("loaded_at", "load_id", "rows")).alias("l"))
    grid = active_studios(studios).select("studio_id", F.explode(F.array(*[F.lit(s) for s in sources])).alias("source"))
    return grid.join(last, ["studio_id", "source"], "left").select(
        "studio_id", "source", "l.load_id", "l.rows", "l.loaded_at",
        F.coalesce(F.to_date("l.loaded_at") < day, F.lit(False)).alias("is_stale"), F.col("l").isNull().alias("is_missing"))


def read_loads(spark: SparkSession, root: str, schema: StructType, chosen: DataFrame) -> DataFrame:
    """The rows of the chosen loads.  Their list (studios x sources) becomes a predicate on the
    folders, so nothing else is read; ``is_stale`` marks rows of an earlier day's load."""
    parts = chosen.filter("NOT is_missing").select(*PARTS).collect()
    data = spark.read.schema(schema).parquet(f"{root}/data").filter(in_partitions(parts, PARTS))
    return data.join(chosen.select(*PARTS, "is_stale"), PARTS)
