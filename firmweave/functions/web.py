"""Scalars on web addresses and business numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmweave.functions.text import SPACE, blank_to_null

# The country ending and the second-level markers.
COUNTRY_SUFFIX = ".au"
COUNTRY_MARKERS = [".com.au", ".gov.au", ".org.au", ".edu.au"]

# Every address that ``is_australian_domain`` takes holds this, so records without it need not be decoded.
COUNTRY_PART = COUNTRY_SUFFIX

# The labels of a business number, in order of priority.
ABN_LABELS = ["ABN", "Australian Business Number", r"A\.?B\.?N\.?"]

_ELEVEN_DIGITS = rf"(\d{{2}}[{SPACE}]?\d{{3}}[{SPACE}]?\d{{3}}[{SPACE}]?\d{{3}})"


def canonical_domain(url: Column) -> Column:
    """Lower-case network location without a leading ``www.`` and outer dots.

    A port and user part stay. Anything without a location gives an empty string.
    """
    location = F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    bare = F.regexp_replace(F.lower(location), r"^www\.", "")
    return F.coalesce(F.regexp_replace(bare, r"^\.+|\.+\z", ""), F.lit(""))


def domain_in_country(
    domain: Column, suffix: str = COUNTRY_SUFFIX, markers: list[str] | None = None
) -> Column:
    """True when the domain ends with ``suffix`` or holds one of ``markers``."""
    test = domain.endswith(suffix)
    for marker in COUNTRY_MARKERS if markers is None else markers:
        test = test | domain.contains(marker)
    return F.coalesce(test, F.lit(False))


def is_australian_domain(domain: Column) -> Column:
    return domain_in_country(domain)


def normalize_abn(text: Column) -> Column:
    """The eleven digits of a business number, or NULL."""
    digits = F.regexp_replace(text, r"(?U)\D", "")
    return F.when(F.length(digits) == 11, digits)


def extract_abn(text: Column) -> Column:
    """First labelled business number; an earlier label in the list wins."""
    hits = [
        blank_to_null(F.regexp_extract(text, rf"(?iU){label}[:{SPACE}]+{_ELEVEN_DIGITS}", 1))
        for label in ABN_LABELS
    ]
    # Every hit holds exactly eleven digits, so only the spaces have to go.
    return F.regexp_replace(F.coalesce(*hits), r"(?U)\D", "")
