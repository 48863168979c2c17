"""Confidence and reasoning of matches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmweave.schemas import CONFIDENCE

# Fixed values of the matching tiers.
FUZZY_THRESHOLD = 0.85
DIRECT_CONFIDENCE = 0.95
FUZZY_BASE_CONFIDENCE = 0.75
STATE_BONUS = 0.10
CONFIDENCE_CAP = 0.95


def raw_confidence(similarity: Column, threshold: float = FUZZY_THRESHOLD) -> Column:
    return F.lit(FUZZY_BASE_CONFIDENCE) + (similarity - F.lit(threshold)) * F.lit(0.5)


def hundredths(value: Column) -> Column:
    """Value in hundredths, rounded half to even by its exact binary value (as Python rounds).

    A double from 1/128 up is a whole multiple of 2^-60, so the rounding is done on integers.
    """
    units = (value * F.lit(float(1 << 60))).cast("bigint").cast("decimal(19,0)")
    shifted = units * F.lit(200) + F.lit(1 << 60)
    whole = F.call_function("div", shifted, F.lit(1 << 61))
    tie = (shifted % F.lit(1 << 61)) == 0
    return F.when(tie & (whole % 2 == 1), whole - 1).otherwise(whole)


def two_places(value: Column) -> Column:
    return (hundredths(value) / F.lit(100)).cast(CONFIDENCE)


def two_decimals(value: Column) -> Column:
    """A score printed to two decimals."""
    count = hundredths(value)
    return F.concat(
        F.call_function("div", count, F.lit(100)).cast("string"), F.lit("."), F.lpad((count % 100).cast("string"), 2, "0")
    )


def fuzzy_confidence(
    similarity: Column, threshold: float = FUZZY_THRESHOLD, state_agrees: Column | None = None
) -> Column:
    """Confidence of a name match, with the bonus where the states are known to agree."""
    value = raw_confidence(similarity, threshold)
    if state_agrees is not None:
        value = value + F.when(state_agrees, F.lit(STATE_BONUS)).otherwise(F.lit(0.0))
    return two_places(F.least(value, F.lit(CONFIDENCE_CAP)))


def direct_reasoning(abn: Column) -> Column:
    return F.concat(F.lit("Direct ABN match: "), abn, F.lit(" found on website matches ABR record"))


def fuzzy_reasoning(shown: Column, site_name: Column, entity_name: Column) -> Column:
    return F.concat(
        F.lit("Fuzzy name match (similarity: "), shown, F.lit(") between '"),
        site_name, F.lit("' and '"), entity_name, F.lit("'"),
    )


def assisted_reasoning(reasoning: Column) -> Column:
    return F.concat(F.lit("LLM match: "), reasoning)
