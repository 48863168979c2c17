"""Company-name normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmweave.functions.text import SPACE, strip

# Legal endings, each tried once in this order.
SUFFIXES = [
    "PTY LTD", "PTY. LTD.", "PTY LIMITED",
    "LIMITED", "LTD", "LTD.",
    "INCORPORATED", "INC", "INC.",
    "PROPRIETARY", "PROPRIETARY LIMITED",
    "CORPORATION", "CORP", "CORP.",
    "COMPANY", "CO", "CO.",
    "& CO", "&CO",
]


def normalize_name(name: Column) -> Column:
    """Upper case, legal endings dropped, punctuation to spaces, spaces collapsed.

    Endings go without a word boundary (COSTCO becomes COST), as the matching
    rules were tuned that way.
    Each step reads its input once, so the expression stays linear in size.
    """
    out = strip(F.upper(name))
    for suffix in SUFFIXES:
        out = F.regexp_replace(out, rf"(?U)[{SPACE}]*{re.escape(suffix)}\z", "")
    out = F.regexp_replace(out, r"[^\p{L}\p{N}]+", " ")
    return F.coalesce(F.trim(out), F.lit(""))
