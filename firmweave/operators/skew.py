"""Equi-join that spreads hot keys over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
NULL_SALTS = 4096

SALT = "_salt"
FAN = "_fan"


def hot_keys(counts: DataFrame, key: str, rows: str = "rows", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows and the number of tasks each needs.

    At most (all rows / rows_per_task) keys can pass, which bounds the result:
    50,000 keys for 50 billion rows. That is why it may be broadcast.
    """
    return counts.filter(F.col(rows) > rows_per_task).select(
        key, F.ceil(F.col(rows) / F.lit(rows_per_task)).cast("int").alias(FAN)
    )


def count_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows per key; partial sums are built before the shuffle, so hot keys are cheap here."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def salted(df: DataFrame, key: str, hot: DataFrame, spread_by: list[Column]) -> DataFrame:
    """Give each row of a hot key one of the key's salts, by a hash of ``spread_by``.

    A hash, not a random number: a task that runs again gives the same salts.
    Rows without a key match nothing, so any salt will do to spread them.
    """
    marked = df.join(F.broadcast(hot), key, "left")
    fan = F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(F.coalesce(F.col(FAN), F.lit(1)))
    return marked.withColumn(SALT, F.pmod(F.xxhash64(*spread_by), fan).cast("int")).drop(FAN)


def replicated(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Repeat each row of a hot key once for each of its salts; keeps the fan-out."""
    marked = df.join(F.broadcast(hot), key, "left").withColumn(FAN, F.coalesce(F.col(FAN), F.lit(1)))
    return marked.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col(FAN) - 1)))


def spread_join(
    facts: DataFrame,
    parent: DataFrame,
    key: str,
    spread_by: list[Column],
    how: str = "inner",
    counts: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join many ``facts`` to a ``parent`` that holds each key once.

    One key may hold a large share of the facts: its rows are salted and the one
    parent row is repeated, so no task gets the whole key. ``how`` is inner, left,
    left_semi or left_anti; each fact row has one salt, so it is seen once.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join does not support {how}")
    counts = count_keys(facts, key) if counts is None else counts
    hot = hot_keys(counts, key, rows_per_task=rows_per_task)
    if how in ("inner", "left_semi"):
        facts = facts.filter(F.col(key).isNotNull())
    left = salted(facts, key, hot, spread_by)
    right = replicated(parent, key, hot).drop(FAN)
    return left.join(right, [key, SALT], how).drop(SALT)
