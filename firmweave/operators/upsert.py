"""Staging-table upserts, written as joins (no table format with MERGE is assumed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmweave.operators.numbering import dense_ids
from firmweave.schemas import CRAWL, REGISTRY
from firmweave.session import cut_lineage

CRAWL_REFRESHED = ["scraped_company_name", "scraped_industry", "scraped_abn", "html_content_snippet"]


def latest_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The row with the greatest ``order`` for each key.

    An aggregate, not a window: copies of one key shrink to one row per task
    before the shuffle, however many there are.
    """
    rest = [name for name in df.columns if name != key]
    last = F.max_by(F.struct(*rest), order)
    return df.groupBy(key).agg(last.alias("_last")).select(
        *[F.col(key) if name == key else F.col(f"_last.{name}").alias(name) for name in df.columns]
    )


def latest_registry(incoming: DataFrame, order: Column) -> DataFrame:
    """The last of several incoming register rows of an abn."""
    columns = [name for name in REGISTRY.names if name not in ("abn", "loaded_at")]
    return latest_per_key(incoming.select("abn", *columns, order.alias("_order")), "abn", F.col("_order")).drop("_order")


def merge_registry(current: DataFrame, fresh: DataFrame, now: Column) -> DataFrame:
    """``current`` with ``fresh`` rows (one an abn) in place of its own."""
    columns = [name for name in REGISTRY.names if name not in ("abn", "loaded_at")]
    new = fresh.select("abn", F.struct(*columns).alias("_new"))
    old = current.select("abn", F.struct(*columns).alias("_old"), F.col("loaded_at"))
    merged = old.join(new, "abn", "full_outer").withColumn("_row", F.coalesce("_new", "_old"))
    loaded = F.when(F.col("_new").isNotNull(), now).otherwise(F.col("loaded_at"))
    return merged.select("abn", "_row.*", loaded.alias("loaded_at")).select(*REGISTRY.names)


def upsert_registry(current: DataFrame, incoming: DataFrame, order: Column, now: Column) -> DataFrame:
    """Register rows by abn: a new row replaces the old one whole; the last of several wins."""
    return merge_registry(current, latest_registry(incoming, order), now)


def latest_crawl(incoming: DataFrame, order: Column) -> DataFrame:
    """The last of several incoming rows of an address, written once: reading and parsing pages is the costly part."""
    shaped = incoming.select("website_url", *CRAWL_REFRESHED, order.alias("_order"))
    return cut_lineage(latest_per_key(shaped, "website_url", F.col("_order")).drop("_order"))


def merge_crawl(current: DataFrame, fresh: DataFrame, now: Column, highest: Column) -> DataFrame:
    """``current`` refreshed by ``fresh`` rows (one an address); new sites get the ids after ``highest``, in order of their address."""
    updates = fresh.select("website_url", F.struct(*CRAWL_REFRESHED).alias("_new"))
    joined = current.join(updates, "website_url", "left")
    hit = F.col("_new").isNotNull()
    known = joined.select(
        "id",
        "website_url",
        *[F.when(hit, F.col(f"_new.{name}")).otherwise(F.col(name)).alias(name) for name in CRAWL_REFRESHED],
        "warc_file_path",
        F.when(hit, now).otherwise(F.col("loaded_at")).alias("loaded_at"),
    )
    unseen = fresh.join(current.select("website_url"), "website_url", "left_anti")
    new = dense_ids(unseen, [F.col("website_url")], "id").withColumns(
        {"id": F.col("id") + highest, "warc_file_path": F.lit(None).cast("string"), "loaded_at": now}
    )
    return known.select(*CRAWL.names).unionByName(new.select(*CRAWL.names))


def upsert_crawl(current: DataFrame, incoming: DataFrame, order: Column, now: Column) -> DataFrame:
    """Crawl rows by website_url: listed columns refreshed, id and warc_file_path kept.

    New sites get the ids after the highest present one, in order of their address.
    """
    # The ids of new rows start after one aggregate value, read as a scalar subquery.
    highest = current.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).scalar()
    return merge_crawl(current, latest_crawl(incoming, order), now, highest)
