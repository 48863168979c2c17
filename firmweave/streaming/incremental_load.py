"""Loading page-line files as they land: the crawl upsert, one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from firmweave.operators import load, upsert
from firmweave.sources import page_lines, tables


def upsert_batch(root: str):
    """Function for ``foreachBatch``; a batch that is run again gives the same rows. Only buckets with a batch's sites are rewritten."""

    def run(batch: DataFrame, batch_id: int) -> None:
        ordered = batch.withColumn(
            "load_order", F.struct("file", "block", F.monotonically_increasing_id().alias("row"))
        )
        rows = load.crawl_rows(page_lines.good_lines(ordered), keep=("load_order",))
        fresh = upsert.latest_crawl(rows, F.col("load_order"))
        now = F.current_timestamp()
        tables.upsert_table(batch.sparkSession, root, "crawl", fresh, lambda current, highest: upsert.merge_crawl(current, fresh, now, F.lit(highest)))

    return run


def load_new_lines(
    spark: SparkSession, lines_path: str, root: str, progress_path: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Upsert every page-line file not loaded before, then stop.

    ``progress_path`` keeps which files are done, so a later call takes new files only.
    """
    lines = page_lines.stream_page_lines(spark, lines_path, files_per_batch)
    return (
        lines.writeStream.foreachBatch(upsert_batch(root))
        .option("checkpointLocation", progress_path)
        .trigger(availableNow=True)
        .start()
    )
