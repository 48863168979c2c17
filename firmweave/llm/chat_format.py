"""Chat formatting with cumulative snapshots collapsed: a conversation that a longer one begins with is not rendered.

Rolling turn-prefix hashes are running sums of hashes of (position, turn), so a prefix hash of a very long conversation comes
from partial sums of range-sorted parts and no task gets a whole conversation before rendering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmweave.llm.tables import settle

_PREFIX = ["k", "s", "t"]


def _turn_hash(salt: int) -> Column:
    # xxhash64 passes over nulls, so they get a value of their own.
    parts = [F.col(c).isNull() for c in ("role", "text")] + [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")]
    return F.xxhash64(F.lit(salt), *parts)


def _laid(turns: DataFrame) -> DataFrame:
    """Different turns in order of (conversation, turn, role, text), with the sorted part and place each has."""
    rows = turns.select("conv_id", "turn", "role", "text").where(F.col("conv_id").isNotNull()).distinct()
    rows = rows.withColumn("h", _turn_hash(1)).withColumn("g", _turn_hash(2))
    bounds, order = ["conv_id", "turn", "role", "h"], ["conv_id", "turn", "role", "text"]
    # Rows that tie in the bounds fall into one part, where the text decides.
    laid = rows.repartitionByRange(*bounds).sortWithinPartitions(*order)
    laid = laid.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id())
    return settle(laid, "turns")


def _carried(rows: DataFrame, value: str) -> DataFrame:
    """Sum of ``value`` of a conversation in the parts before each: one row for each conversation and part."""
    sums = rows.groupBy("conv_id", "part").agg(F.sum(value).alias("own"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast(sums.schema["own"].dataType)
    return sums.select("conv_id", "part", F.coalesce(F.sum("own").over(before), zero).alias("before"))


def prefix_hashes(laid: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``row``, ``k`` (number of turns so far) and ``s``, ``t`` (two hashes of the turns so far)."""
    local = Window.partitionBy("conv_id", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    counted = laid.select("conv_id", "part", "row", "h", "g", F.lit(1).cast("bigint").alias("one"))
    places = counted.join(_carried(counted, "one"), ["conv_id", "part"])
    places = places.withColumn("k", (F.sum("one").over(local) + F.col("before")).cast("bigint")).drop("before", "one")
    wide = "decimal(30,0)"
    terms = settle(
        places.select(
            "conv_id", "part", "row", "k", F.xxhash64("k", "h").cast(wide).alias("x"), F.xxhash64("k", "g").cast(wide).alias("y")
        ),
        "terms",
    )
    out = terms
    for term, name in (("x", "s"), ("y", "t")):
        out = out.join(_carried(terms, term), ["conv_id", "part"])
        out = out.withColumn(name, (F.sum(term).over(local) + F.col("before")).cast("decimal(38,0)")).drop("before", term)
    return out


def maximal_conversations(laid: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns`` and ``n_copies`` of conversations that no longer one begins with; of equal ones the smallest id."""
    prefixes = settle(prefix_hashes(laid), "prefixes")
    finals = prefixes.groupBy("conv_id").agg(F.max_by(F.struct(*_PREFIX), "k").alias("last"))
    classes = finals.groupBy("last").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies")).select("last.*", "conv_id", "n_copies")
    # Every conversation that has a prefix gives it one row: more rows than conversations that end there mean a longer one.
    seen = prefixes.groupBy(*_PREFIX).agg(F.count(F.lit(1)).alias("n_seen"))
    same = [classes[c] == seen[c] for c in _PREFIX]
    kept = classes.join(seen, [*same, seen["n_seen"] > classes["n_copies"]], "left_anti")
    return kept.select("conv_id", F.col("k").alias("n_turns"), "n_copies")


def render_conversations(turns: DataFrame, head: str = "<|{role}|>\n", tail: str = "\n<|end|>\n") -> DataFrame:
    """Maximal conversations of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``), one rendered row each.

    Returns ``conv_id``, ``n_turns``, ``n_copies`` (equal conversations, itself included) and ``rendered``: of each turn ``head``, the
    text and ``tail``, in order of (turn, role, text), nulls first. A repeated row counts once; turns with one number are all kept.
    Null roles and texts render as empty but equal only nulls. Rows without ``conv_id`` belong to no conversation and are left out. Other
    columns are not read. An empty table gives an empty result.
    """
    laid = _laid(turns)
    kept = maximal_conversations(laid)
    before, after = head.split("{role}")
    text = F.concat(F.lit(before), F.coalesce("role", F.lit("")), F.lit(after), F.coalesce("text", F.lit("")), F.lit(tail))
    chosen = laid.join(kept, "conv_id").select("conv_id", "n_turns", "n_copies", F.struct("part", "row", text.alias("out")).alias("turn"))
    grouped = chosen.groupBy("conv_id", "n_turns", "n_copies").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return grouped.select("conv_id", "n_turns", "n_copies", F.array_join(F.col("turns.out"), "").alias("rendered"))
