"""Register dumps in XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmweave import schemas


_TAG = "ABR"
_OPTIONS = {"rowTag": _TAG, "ignoreSurroundingSpaces": "false"}


def read_register(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """One row per register element of the ``*.xml`` files in a folder (or of one file).

    UTF-8 files are read as text that is split at the end tags, then element by element, so a large file is
    read by many tasks. Files in another ``encoding`` go through the XML reader, one task a file. Adds
    ``file`` and ``load_order``; spaces are kept as they are in the file.
    """
    if encoding.upper().replace("_", "-") not in ("UTF-8", "UTF8", "US-ASCII", "ASCII"):
        reader = spark.read.format("xml").options(**_OPTIONS, encoding=encoding, pathGlobFilter="*.xml")
        elements = reader.schema(schemas.REGISTER_XML).load(path)
        return elements.select("*", F.col("_metadata.file_path").alias("file"), load_order().alias("load_order"))
    pieces = spark.read.option("lineSep", f"</{_TAG}>").option("pathGlobFilter", "*.xml").text(path)
    # Each piece ends where an element ends; what stands before its start tag is the head of the file or space.
    body = F.substring_index("value", f"<{_TAG}", -1)
    found = pieces.where(F.col("value").contains(f"<{_TAG}")).select(
        F.concat(F.lit(f"<{_TAG}"), body, F.lit(f"</{_TAG}>")).alias("element"),
        F.col("_metadata.file_path").alias("file"),
        load_order().alias("load_order"),
    )
    found = found.where(F.col("element").rlike(rf"^<{_TAG}[\s>]"))
    read = found.select(F.from_xml("element", schemas.REGISTER_XML.simpleString(), _OPTIONS).alias("e"), "file", "load_order")
    return read.select("e.*", "file", "load_order")


def load_order() -> Column:
    """Order in which a loader that goes file by file would meet the rows."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
