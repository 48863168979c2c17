"""Facts from page HTML, as built-in expressions.

Some of these read their input more than once. ``operators.extract`` therefore
builds them in stages, so that a long regular expression runs once a page.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmweave.functions.text import blank_to_null, strip, unescape

# Stands where markup was cut out, so that text nodes can be told apart.
CUT = "\u0001"

_COMMENT = r"<!--.*?-->"
# The rest of a tag; a quoted value may hold ">". Without closing quotes it ends at the next ">".
_REST_OF_TAG = r"(?:(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)"
_TAG = rf"<[a-zA-Z/!?]{_REST_OF_TAG}"
# A name ends here; "-" goes on, as in custom elements.
_END_OF_NAME = r"(?=[\s/>])"
_META = rf"(?is)(<meta{_END_OF_NAME}{_REST_OF_TAG})"
_META_IS_DESCRIPTION = r"(?is)[\s\"']name\s*=\s*(?:\"(?-i:description)\"|'(?-i:description)'|(?-i:description)[\s/>])"
_CONTENT = r"(?is)[\s\"']content\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
_TITLE = rf"(?is)<title{_END_OF_NAME}{_REST_OF_TAG}(.*?)</title\s*>"
_H1 = rf"(?is)<h1{_END_OF_NAME}{_REST_OF_TAG}(.*?)</h1\s*>"
_JSON_LD = rf"(?is)<script{_END_OF_NAME}[^>]*\btype\s*=\s*[\"']?application/ld\+json[\"']?[^>]*>(.*?)</script\s*>"


def _elements(names: list[str]) -> str:
    # Raw-text elements run to the end of the page if they are not closed; others without an end stay.
    ends = {name: r"|\z" if name in ("script", "style") else "" for name in names}
    return "|".join(rf"<{name}{_END_OF_NAME}[^>]*>.*?(?:</{name}\s*>{end})" for name, end in ends.items())


def _without(markup: Column, names: list[str]) -> Column:
    return F.regexp_replace(markup, rf"(?is){_COMMENT}|{_elements(names)}", CUT)


def visible_markup(html: Column) -> Column:
    """Markup without comments and without script, style and template elements."""
    return _without(html, ["script", "style", "template"])


def prompt_markup(html: Column) -> Column:
    """Markup without the parts that carry no page content."""
    return _without(html, ["script", "style", "nav", "footer", "header"])


def cut_tags(markup: Column) -> Column:
    """Text nodes of the markup with ``CUT`` between nodes, entities still encoded."""
    return F.regexp_replace(markup, _TAG, CUT)


def joined_text(cut: Column) -> Column:
    """All text nodes joined with nothing in between."""
    return unescape(F.replace(cut, F.lit(CUT), F.lit("")))


def spaced_text(cut: Column) -> Column:
    """Stripped, non-empty text nodes joined by a space."""
    nodes = F.transform(F.split(cut, CUT), lambda node: strip(unescape(node)))
    return F.array_join(F.filter(nodes, lambda node: node != ""), " ")


def title_markup(visible: Column) -> Column:
    return F.regexp_extract(visible, _TITLE, 1)


def title(inner: Column) -> Column:
    """Title text when the title holds one plain string, stripped; else an empty string."""
    plain = ~inner.rlike("<[a-zA-Z/!?]") & ~inner.contains(CUT)
    return F.when(plain, strip(unescape(inner))).otherwise(F.lit(""))


def description_tag(visible: Column) -> Column:
    """First meta tag named description."""
    tags = F.filter(
        F.regexp_extract_all(visible, F.lit(_META), F.lit(1)), lambda tag: tag.rlike(_META_IS_DESCRIPTION)
    )
    return F.get(tags, 0)


def meta_description(tag: Column) -> Column:
    value = F.concat(*[F.regexp_extract(tag, _CONTENT, group) for group in (1, 2, 3)])
    return F.coalesce(strip(unescape(value)), F.lit(""))


def first_heading(visible: Column) -> Column:
    """Text nodes of the first h1, each stripped, joined with nothing in between."""
    cut = cut_tags(F.regexp_extract(visible, _H1, 1))
    return F.array_join(F.transform(F.split(cut, CUT), lambda node: strip(unescape(node))), "")


def json_ld_blocks(html: Column) -> Column:
    """JSON-LD texts in page order; what is commented out is not read, comments within scripts are theirs."""
    shown = F.regexp_replace(html, rf"(?is)(<script{_END_OF_NAME}[^>]*>.*?</script\s*>)|{_COMMENT}", "$1")
    return F.regexp_extract_all(shown, F.lit(_JSON_LD), F.lit(1))


# Schema.org types that name a company.
ORGANISATION_TYPES = ["Organization", "LocalBusiness", "Corporation", "WebSite"]
PUBLISHER_TYPES = ["Organization", "LocalBusiness", "Corporation"]

_STATE = "struct<name:string,industry:string,live:boolean>"


def _get(node: Column, key: str, kind: str = "string") -> Column:
    return F.try_variant_get(node, f'$["{key}"]', kind)


def _is_list(node: Column) -> Column:
    return F.coalesce(F.schema_of_variant(node).startswith("ARRAY"), F.lit(False))


def _is_object(node: Column) -> Column:
    return F.coalesce(F.schema_of_variant(node).startswith("OBJECT"), F.lit(False))


def _read(node: Column, key: str, before: Column) -> Column:
    """Value of ``key``; the earlier value when the key is missing; NULL for a JSON null."""
    return F.when(_get(node, key, "variant").isNull(), before).otherwise(_get(node, key))


def _nodes(block: Column) -> Column:
    graph = _get(block, "@graph", "variant")
    listed = F.when(_is_list(graph), _get(block, "@graph", "array<variant>")).otherwise(F.array(graph))
    return F.when(_is_object(block), F.concat(F.array(block), F.when(graph.isNull(), F.array().cast("array<variant>")).otherwise(listed)))


def _visit(state: Column, node: Column) -> Column:
    kind = _get(node, "@type", "variant")
    many = _is_list(kind)
    first = F.when(many, F.try_variant_get(kind, "$[0]", "string")).otherwise(_get(node, "@type"))
    # An empty type list ends this block; what was read before it stays.
    broken = many & F.try_variant_get(kind, "$[0]", "variant").isNull()
    is_org = F.coalesce(first.isin(ORGANISATION_TYPES), F.lit(False))
    name = F.when(is_org, _read(node, "name", state["name"])).otherwise(state["name"])
    industry = F.when(is_org, _read(node, "industry", state["industry"])).otherwise(state["industry"])
    publisher = _get(node, "publisher", "variant")
    fallback = (
        F.coalesce(name, F.lit("")) == ""
    ) & _is_object(publisher) & F.coalesce(_get(publisher, "@type").isin(PUBLISHER_TYPES), F.lit(False))
    name = F.when(fallback, _read(publisher, "name", name)).otherwise(name)
    next_state = F.struct(
        name.alias("name"), industry.alias("industry"), F.lit(True).alias("live")
    ).cast(_STATE)
    stopped = F.struct(
        state["name"].alias("name"), state["industry"].alias("industry"), F.lit(False).alias("live")
    ).cast(_STATE)
    usable = state["live"] & _is_object(node)
    return F.when(usable & broken, stopped).when(usable, next_state).otherwise(state)


def json_ld_facts(blocks: Column) -> Column:
    """Name and industry folded over all JSON-LD blocks in page order; later nodes win."""

    def one_block(state: Column, text: Column) -> Column:
        opened = F.struct(
            state["name"].alias("name"), state["industry"].alias("industry"), F.lit(True).alias("live")
        ).cast(_STATE)
        nodes = F.coalesce(_nodes(F.try_parse_json(text)), F.array().cast("array<variant>"))
        return F.aggregate(nodes, opened, _visit)

    start = F.struct(
        F.lit("").alias("name"), F.lit("").alias("industry"), F.lit(True).alias("live")
    ).cast(_STATE)
    return F.aggregate(blocks, start, one_block)


def company_name(json_ld_name: Column, heading: Column, page_title: Column) -> Column:
    """JSON-LD name, else the heading, else the title; empty when there is none."""
    named = F.coalesce(blank_to_null(json_ld_name), blank_to_null(heading), page_title)
    return F.coalesce(strip(named), F.lit(""))
