"""Connected components of a graph of any size, as joins and minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmweave.llm.tables import settle


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for all nodes of ``edges`` (``a``, ``b``: bigint).

    Each round a node takes the smallest label among its own and its neighbours', then the label of that label, so paths
    shorten as they are walked. Labels are aggregated before they are shuffled, hubs are split by skew joins, and each round is
    a table in the shared folder.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = settle(both.where("a <> b").distinct(), "edges")
    labels = settle(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        own = labels.join(near, F.col("node") == F.col("a"), "left")
        own = own.select("node", F.col("root").alias("before"), F.least("root", F.coalesce("near", "root")).alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("root").alias("further"))
        step = own.join(jump, "label", "left")
        step = settle(step.select("node", "before", F.least("label", F.coalesce("further", "label")).alias("root")), "labels")
        labels = step.select("node", "root")
        if step.where("before <> root").isEmpty():
            return labels
