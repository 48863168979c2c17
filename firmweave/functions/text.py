"""Text helpers: stripping as Python does it, and HTML entity decoding."""

from __future__ import annotations

import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's idea of white space inside a character class (use with the U flag).
SPACE = r"\s\x1c-\x1f"

_EDGES = rf"(?U)\A[{SPACE}]+|[{SPACE}]+\z"
# Names that HTML also reads without a semicolon, longest first.
_BARE = "|".join(sorted((name for name in html.entities.html5 if not name.endswith(";")), key=lambda name: (-len(name), name)))
_ENTITY = rf"(&(?:#[0-9]{{1,7}};?|#[xX][0-9a-fA-F]{{1,6}};?|[A-Za-z][A-Za-z0-9]{{1,31}};|(?:{_BARE})))"


def strip(col: Column) -> Column:
    """Drop white space of any kind at both ends."""
    return F.regexp_replace(col, _EDGES, "")


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def stripped_or_null(col: Column) -> Column:
    return blank_to_null(strip(col))


def _windows_text() -> Column:
    """Numbers 128 to 159 as HTML reads them: characters of Windows-1252."""
    table = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _code_point_text(code: Column) -> Column:
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    text = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    windows = F.when(code.between(0x80, 0x9F), F.try_element_at(_windows_text(), code.cast("string")))
    return F.coalesce(windows, F.when(valid, text).otherwise(F.lit("�")))


def _entity_names() -> Column:
    """Entity name, with its semicolon if it has one, -> text, as a map that the optimizer folds to one literal."""
    return F.from_json(F.lit(json.dumps(html.entities.html5)), "map<string,string>")


def _bare_names() -> Column:
    table = {name: text for name, text in html.entities.html5.items() if not name.endswith(";")}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _decode_entity(entity: Column) -> Column:
    body = F.regexp_replace(entity, "[&;]", "")
    hexadecimal = F.conv(F.substring(body, 3, 8), 16, 10).cast("bigint")
    name = F.substring(entity, 2, 33)
    # An unknown name that begins with one that needs no semicolon: that one is read.
    start = F.regexp_extract(name, rf"^({_BARE})", 1)
    opened = F.concat(F.try_element_at(_bare_names(), start), F.substr(name, F.length(start) + 1))
    decimal = F.regexp_extract(body, r"^#([0-9]+)$", 1).try_cast("bigint")
    return (
        F.when(body.rlike("^#[xX]"), _code_point_text(hexadecimal))
        .when(body.startswith("#"), _code_point_text(decimal))
        .otherwise(F.coalesce(F.try_element_at(_entity_names(), name), opened, entity))
    )


def unescape(col: Column) -> Column:
    """Replace HTML entities by their characters; unknown ones stay."""
    parts = F.split(col, _ENTITY, -1)
    found = F.transform(F.regexp_extract_all(col, F.lit(_ENTITY), F.lit(1)), _decode_entity)
    joined = F.array_join(F.zip_with(parts, found, lambda p, e: F.concat(p, F.coalesce(e, F.lit("")))), "")
    return F.when(col.contains("&"), joined).otherwise(col)
