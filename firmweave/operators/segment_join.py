"""Pairs of names within an edit distance, found through shared segments (Pass-Join) in place of shared grams.

A pair of similarity f or more is within ``tau = floor((1 - f) * longer length)`` edits. Cut the register's name into
tau + 1 segments: tau edits leave at least one as it is, so the site's name holds it. Segments are as even as can be,
so they are about 1 / (1 - f) characters long whatever the length of the name, and few names share one.

Where a segment may begin in the site's name follows from the edits that can lie on either side of it: with the i-th segment as the
first that is left as it is, at most i - 1 edits come before it, and as the last one, at most tau + 1 - i after it. One of the segments
meets both, so only places that do are asked for.

The key of a segment is a hash of its text, its number and the two numbers that fix the cut (length and tau). Different keys
that collide cost a distance, not a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmweave.functions.similarity import EPSILON, count_masks

# Below this floor segments are three characters or fewer and may stand in many more places, so grams in prefixes serve
# better; at 0.5 and below a name would need more segments than it has characters.
LEAST_FLOOR = 0.7


def _edits(longer: Column, floor: float) -> Column:
    return F.floor(longer * F.lit(1.0 - floor) + F.lit(EPSILON)).cast("int")


def _key(length: Column, tau: Column, number: Column, text: Column) -> Column:
    return F.xxhash64(length, tau, number, text)


def _begin(length: Column, tau: Column, number: Column) -> tuple[Column, Column]:
    """Where segment ``number`` (from 1) of a name begins (from 1), and its length; longer segments come last."""
    size = F.floor(length / (tau + 1)).cast("int")
    short = tau + 1 - length % (tau + 1)
    return 1 + (number - 1) * size + F.greatest(F.lit(0), number - 1 - short), size + (number > short).cast("int")


def _measured(names: DataFrame, low: Column) -> DataFrame:
    masks, over = count_masks("name")
    return names.select("name", low.cast("double").alias("low"), F.length("name").alias("len")).withColumns(masks).withColumn("over", over)


def segment_rows(names: DataFrame, floor: float) -> DataFrame:
    """``token`` and the measured ``name``: segments of register names, for each number of edits that a partner's length can allow."""
    measured = _measured(names, F.lit(floor)).drop("low")
    held, length = measured.columns, F.col("len")
    longest = F.floor(length / F.lit(floor) + F.lit(EPSILON)).cast("int")
    allowed = measured.select(*held, F.explode(F.sequence(_edits(length, floor), _edits(longest, floor))).alias("tau"))
    cut = allowed.select(*held, "tau", F.explode(F.sequence(F.lit(1), F.col("tau") + 1)).alias("number"))
    begin, size = _begin(F.col("len"), F.col("tau"), F.col("number"))
    return cut.select(_key(F.col("len"), F.col("tau"), F.col("number"), F.substring("name", begin, size)).alias("token"), *held)


def probe_rows(names: DataFrame, floor: float) -> DataFrame:
    """``token`` and the measured ``name`` with its ``low``: the places of site names that a segment of a partner may take, once each."""
    measured = _measured(names, F.col("low") if "low" in names.columns else F.lit(floor))
    held, length = measured.columns, F.col("len")
    shortest = F.ceil(length * F.lit(floor) - F.lit(EPSILON)).cast("int")
    longest = F.floor(length / F.lit(floor) + F.lit(EPSILON)).cast("int")
    sized = measured.select(*held, F.explode(F.sequence(shortest, longest)).alias("other"))
    sized = sized.withColumn("tau", _edits(F.greatest("len", "other"), floor))

    def places(number: Column) -> Column:
        tau, ahead = F.col("tau"), length - F.col("other")
        begin, size = _begin(F.col("other"), tau, number)
        first = F.greatest(F.lit(1), begin - (number - 1), begin + ahead - (tau + 1 - number))
        last = F.least(length - size + 1, begin + (number - 1), begin + ahead + (tau + 1 - number))
        found = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.transform(found, lambda p: _key(F.col("other"), tau, number, F.substring(F.col("name"), p, size)))

    tokens = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.col("tau") + 1), places)))
    return sized.select(*held, F.explode(tokens).alias("token"))


def within_floor(left: str, right: str) -> Column:
    """Whether two names reach the floor of the left one; the distance is not followed beyond what that floor allows."""
    longer = f"greatest({left}.len, {right}.len)"
    edits = f"cast(floor({longer} * (1 - {left}.low) + {EPSILON}) as int)"
    return F.expr(f"levenshtein({left}.name, {right}.name, {edits}) >= 0")
