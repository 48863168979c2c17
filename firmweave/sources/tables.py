"""Tables of the integration as Parquet folders.

Register and crawl are keyed tables, of which a load rewrites the buckets it touches; matches are a log that is only added to; companies
are one folder per version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from firmweave import schemas
from firmweave.sources.keyed import Files, KeyedTable, PairLog

TABLES: dict[str, T.StructType] = {
    "registry": schemas.REGISTRY,
    "crawl": schemas.CRAWL,
    "matches": schemas.MATCHES,
    "companies": schemas.COMPANIES,
}


_VERSION = "version="
_DONE = "_SUCCESS"


def table_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions of a table that were written to the end."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in files.listStatus(folder)]
    numbers = [int(name.removeprefix(_VERSION)) for name in names if name.startswith(_VERSION)]
    return sorted(n for n in numbers if files.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{_VERSION}{n}/{_DONE}")))


def stored(spark: SparkSession, root: str, name: str) -> KeyedTable | PairLog | None:
    """The store of a table that loads change in part."""
    path, schema = f"{root}/{name}", TABLES[name]
    if name == "registry":
        return KeyedTable(spark, path, schema, ["abn"])
    if name == "crawl":
        return KeyedTable(spark, path, schema, ["website_url"], counter="id")
    return PairLog(spark, path, schema, ["cc_id", "abn"], "match_id") if name == "matches" else None


def has_table(spark: SparkSession, root: str, name: str) -> bool:
    """Whether some version of a table was written to the end."""
    kept = stored(spark, root, name)
    return bool(kept.versions.numbers() if kept else table_versions(spark, f"{root}/{name}"))


def _view(table: DataFrame, name: str) -> DataFrame:
    table.createOrReplaceTempView(name)
    return table


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Latest version of a table under ``root``, empty when there is none; also a view of that name."""
    kept = stored(spark, root, name)
    if kept:
        return _view(kept.read(), name)
    path, schema = f"{root}/{name}", TABLES[name]
    versions = table_versions(spark, path)
    table = spark.read.schema(schema).parquet(f"{path}/{_VERSION}{versions[-1]}") if versions else spark.createDataFrame([], schema)
    return _view(table, name)


def write_table(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write all of the next version of a table and read it back.

    The new rows may come from the version before, and results that are still to be
    computed may read it, so it stays until ``expire_table``.
    """
    spark, path = df.sparkSession, f"{root}/{name}"
    kept = stored(spark, root, name)
    if kept:
        return _view(kept.replace(df.select(*TABLES[name].names)), name)
    number = (table_versions(spark, path) or [0])[-1] + 1
    df.select(*TABLES[name].names).write.mode("overwrite").parquet(f"{path}/{_VERSION}{number}")
    return read_table(spark, root, name)


def upsert_table(spark: SparkSession, root: str, name: str, fresh: DataFrame, merge: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """The next version of a keyed table (registry, crawl): only the buckets of ``fresh``'s keys are read and written."""
    return _view(stored(spark, root, name).upsert(fresh, merge), name)


def append_table(spark: SparkSession, root: str, new: DataFrame, now: Column) -> DataFrame:
    """Add new matches to the log, numbered on in order of (cc_id, abn); pairs that are there already stay as they are."""
    return _view(stored(spark, root, "matches").append(new, ["cc_id", "abn"], {"created_at": now}), "matches")


def expire_table(spark: SparkSession, root: str, name: str, keep: int = 2) -> None:
    """Remove all but the last ``keep`` versions. Results that read older ones must be done."""
    kept = stored(spark, root, name)
    if kept:
        kept.expire(keep)
        return
    path = f"{root}/{name}"
    for number in table_versions(spark, path)[: -max(1, keep)]:
        Files(spark, path).remove(f"{_VERSION}{number}")
