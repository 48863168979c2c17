"""Session settings and lineage cuts shared by every job."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at cluster scale; all can be overridden by the caller.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "firmweave", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the settings above plus ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session (tests) may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its executor.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="firmweave-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Used where one result feeds several later plans, so that it is computed once
    and survives the loss of executors.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join by shuffle, never sent whole through the driver to every task.

    Spark guesses sizes from those of files: rows of few columns that compress well, or are exploded later, are
    many times larger than it thinks.
    """
    return df.hint("merge")
