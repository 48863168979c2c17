"""Dense row numbers in a global order without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmweave.session import cut_lineage

_ROW_BITS = (1 << 33) - 1


def dense_ids(df: DataFrame, order: list[Column], name: str, start: Column | int = 1) -> DataFrame:
    """Number rows ``start``, ``start + 1``, … in ``order``.

    Rows are range-partitioned and sorted within partitions, then written to the
    checkpoint folder: sampling the ranges twice could give two different
    layouts, and both the counts and the numbers must see the same one. Only
    one row per partition goes through the offset window.
    ``order`` should be total, so that the numbers are repeatable.
    """
    laid_out = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    )
    laid_out = cut_lineage(laid_out)
    sizes = laid_out.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    first = F.lit(start) if isinstance(start, int) else start
    numbered = laid_out.join(F.broadcast(offsets), "_part")
    number = (first + F.col("_before") + F.col("_row")).cast("bigint")
    return numbered.select(number.alias(name), *df.columns)
