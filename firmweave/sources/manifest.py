"""Shard manifest and the check of what has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmweave.functions.text import strip

# A landed file larger than this counts as whole.
WHOLE_BYTES = 1_000_000


def read_shard_paths(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """Non-blank, stripped lines as (position, shard_path); ``first`` keeps the first lines only.

    The manifest is one small text file; it is read whole, so that positions are line numbers.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("line", "raw"))
    present = lines.select("line", strip(F.col("raw")).alias("shard_path")).filter(F.col("shard_path") != "")
    if first:
        present = present.orderBy("line").limit(first)
    return present.select(F.col("line").cast("bigint").alias("position"), "shard_path")


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and length of every file below the folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length")


def reconcile(manifest: DataFrame, files: DataFrame, whole_bytes: int = WHOLE_BYTES) -> DataFrame:
    """Each shard with its length and status: landed, too_small or missing.

    Files keep the shard's path below the landing folder, so the last two path parts
    narrow the join and the full shard path decides.
    """

    def tail(path):
        return F.concat_ws("/", F.slice(F.split(path, "/"), -2, 2))

    shards = manifest.withColumn("_tail", F.when(F.col("shard_path").contains("/"), tail(F.col("shard_path"))).otherwise(F.col("shard_path")))
    found = files.select(
        F.explode(F.array_distinct(F.array(tail(F.col("path")), F.element_at(F.split("path", "/"), -1)))).alias("_tail"),
        "path",
        "length",
    )
    hit = (shards["_tail"] == found["_tail"]) & found["path"].endswith(F.concat(F.lit("/"), shards["shard_path"]))
    joined = shards.join(found, hit, "left").groupBy("position", "shard_path").agg(F.max("length").alias("length"))
    status = (
        F.when(F.col("length") > whole_bytes, F.lit("landed"))
        .when(F.col("length") > 0, F.lit("too_small"))
        .otherwise(F.lit("missing"))
    )
    return joined.withColumn("status", status)


def landing_summary(reconciled: DataFrame) -> DataFrame:
    return reconciled.groupBy("status").agg(F.count(F.lit(1)).alias("shards")).orderBy("status")
