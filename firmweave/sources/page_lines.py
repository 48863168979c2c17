"""Page rows as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave import schemas
from firmweave.sources.register_xml import load_order

_BROKEN = "_corrupt_record"


def write_page_lines(rows: DataFrame, path: str) -> None:
    """One object a line with every key present, NULL or not; UTF-8 is not escaped."""
    rows.select(*schemas.PAGE_ROW.names).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _lenient(reader):
    schema = T.StructType([*schemas.PAGE_ROW.fields, T.StructField(_BROKEN, T.StringType())])
    return reader.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BROKEN)


def read_page_lines(spark: SparkSession, path: str) -> DataFrame:
    """Page rows with ``load_order``; a broken line is a row whose ``broken`` text is set.

    Missing keys are NULL, unknown keys are ignored, blank lines are skipped.
    """
    lines = _lenient(spark.read).json(path)
    return lines.select(*schemas.PAGE_ROW.names, F.col(_BROKEN).alias("broken"), load_order().alias("load_order"))


def stream_page_lines(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    """The same rows as a stream of new files, with ``file`` and ``block`` in place of ``load_order``."""
    lines = _lenient(spark.readStream).option("maxFilesPerTrigger", files_per_batch).json(path)
    return lines.select(
        *schemas.PAGE_ROW.names,
        F.col(_BROKEN).alias("broken"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def good_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("broken").isNull()).drop("broken")


def line_counters(lines: DataFrame) -> DataFrame:
    """Lines that load (they have a url) and lines in error."""
    broken = F.col("broken").isNotNull()
    return lines.agg(
        F.count_if(~broken & (F.coalesce(F.col("url"), F.lit("")) != "")).alias("loaded"),
        F.count_if(broken).alias("errors"),
    )
