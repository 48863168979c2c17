"""Lenient date parsing for register attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmweave.functions.text import strip

# Shapes accepted; each gives year, month and day (or a week date).
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d{1,6})?"
_LOOSE = rf"^(\d{{4}}-\d{{1,2}}-\d{{1,2}})(?:[T ]{_CLOCK})?$"
_LEADING = r"^(\d{4}-\d{2}-\d{2})"
_ZONE = r"(?:Z|[+\-]\d{2}(?::?\d{2})?)?"
_COMPACT = rf"^(\d{{8}})(?:.\d{{2}}(?::?\d{{2}}(?::?\d{{2}}(?:[.,]\d+)?)?)?{_ZONE})?$"
_WEEK = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?(?:T.*)?$"


def _week_date(text: Column) -> Column:
    year = F.regexp_extract(text, _WEEK, 1).try_cast("int")
    week = F.regexp_extract(text, _WEEK, 2).try_cast("int")
    day = F.coalesce(F.regexp_extract(text, _WEEK, 3).try_cast("int"), F.lit(1))
    first_monday = F.trunc(F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-01-04")).try_cast("date"), "week")
    found = F.date_add(first_monday, (week - 1) * 7 + day - 1)
    return F.when(F.weekofyear(found) == week, found)


def parse_date(raw: Column) -> Column:
    """Date from the usual stamps, compact and week dates, else a leading YYYY-MM-DD."""
    text = strip(raw)
    loose = F.try_to_timestamp(F.regexp_extract(text, _LOOSE, 1), F.lit("yyyy-M-d"))
    leading = F.try_to_timestamp(F.regexp_extract(text, _LEADING, 1), F.lit("yyyy-MM-dd"))
    compact = F.try_to_timestamp(F.regexp_extract(text, _COMPACT, 1), F.lit("yyyyMMdd"))
    found = (
        F.when(text.rlike(_LOOSE), loose)
        .when(text.rlike(_LEADING), leading)
        .when(text.rlike(_COMPACT), compact)
        .cast("date")
    )
    return F.when(~text.startswith("0000"), F.when(text.rlike(_WEEK), _week_date(text)).otherwise(found))
