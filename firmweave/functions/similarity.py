"""Name similarity: the exact ratio, and cheap bounds that Spark can evaluate."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.functions.matching_blocks import ratios

# Symbols that get a counter of their own in the bit masks: 6 bits each, 10 to a long.
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 "
_BITS = 6
_PER_LONG = 10

EPSILON = 1e-9


def _ratio_udf():
    def whole_batch(left: pd.Series, right: pd.Series) -> pd.Series:
        null = (left.isna() | right.isna()).to_numpy()
        out = ratios(left.fillna("").tolist(), right.fillna("").tolist())
        return pd.Series(out).mask(null)

    # Not deterministic in Spark's terms: otherwise a filter on the ratio is evaluated early,
    # on pairs that are not distinct yet, and once more for the column.
    return F.pandas_udf(whole_batch, T.DoubleType()).asNondeterministic()


def ratio(site_name: Column, register_name: Column) -> Column:
    """Matching-blocks ratio 2M/T of two normalised names; 0 when either is empty.

    The ratio is not symmetric: the site's name comes first.
    """
    return F.when((site_name == "") | (register_name == ""), F.lit(0.0)).otherwise(
        _ratio_udf()(site_name, register_name)
    )


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 0 when either is empty."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).otherwise(
        F.lit(1.0) - F.levenshtein(a, b) / longer
    )


def count_masks(name: str) -> tuple[dict[str, Column], Column]:
    """Character counts of column ``name`` as four longs, and the number of characters left out.

    A character seen n times sets its n lowest bits, so the characters two names
    share are the bits common to both. Counts above six and other characters are
    left out of the masks; counting them as shared can only raise the bound. The second
    expression reads the masks as columns.
    """
    masks, held = {}, []
    for start in range(0, len(SYMBOLS), _PER_LONG):
        packed = []
        for slot, symbol in enumerate(SYMBOLS[start : start + _PER_LONG]):
            seen = f"least(length({name}) - length(replace({name}, '{symbol}', '')), {_BITS})"
            packed.append(f"shiftleft(shiftleft(1L, {seen}) - 1L, {slot * _BITS})")
        masks[f"m{start // _PER_LONG}"] = F.expr(" + ".join(packed))
        held += [f"bit_count(m{start // _PER_LONG})"]
    return masks, F.expr(f"length({name}) - ({' + '.join(held)})")


MASKS = [f"m{i}" for i in range((len(SYMBOLS) + _PER_LONG - 1) // _PER_LONG)]


def shared_characters(left: str, right: str) -> Column:
    """Upper bound of the characters two mask sets (aliases) have in common."""
    total = F.least(F.col(f"{left}.over"), F.col(f"{right}.over"))
    for mask in MASKS:
        total = total + F.bit_count(F.col(f"{left}.{mask}").bitwiseAND(F.col(f"{right}.{mask}")))
    return total
