"""From archive records to page rows: narrow projections only, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmweave import schemas
from firmweave.functions import pages
from firmweave.functions.text import blank_to_null, strip
from firmweave.functions.web import canonical_domain, extract_abn, is_australian_domain


def keep_record_types(records: DataFrame) -> DataFrame:
    return records.filter(F.col("rec_type").isin("response", "conversion"))


def keep_country_pages(df: DataFrame, url: str = "url") -> DataFrame:
    """Rows that have an address within the country; adds ``domain``.

    Runs before any page work, so that other pages are never parsed.
    """
    present = df.filter(F.col(url).isNotNull() & (F.col(url) != ""))
    return present.withColumn("domain", canonical_domain(F.col(url))).filter(
        is_australian_domain(F.col("domain"))
    )


def with_page_fields(df: DataFrame, html: str = "html") -> DataFrame:
    """Add title, meta_description, h1, page_text and the JSON-LD name and industry.

    Written in stages: each heavy expression becomes a column that later stages
    read, so it runs once a page.
    """
    staged = df.withColumns(
        {
            "_visible": pages.visible_markup(F.col(html)),
            "_facts": pages.json_ld_facts(pages.json_ld_blocks(F.col(html))),
        }
    ).withColumns(
        {
            "_title": pages.title_markup(F.col("_visible")),
            "_tag": pages.description_tag(F.col("_visible")),
            "_cut": pages.cut_tags(F.col("_visible")),
            "h1": pages.first_heading(F.col("_visible")),
        }
    )
    return staged.withColumns(
        {
            "title": pages.title(F.col("_title")),
            "meta_description": pages.meta_description(F.col("_tag")),
            "page_text": pages.joined_text(F.col("_cut")),
            "json_ld_name": F.col("_facts.name"),
            "json_ld_industry": F.col("_facts.industry"),
        }
    ).drop("_visible", "_facts", "_title", "_tag", "_cut")


def page_rows(df: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row a page in the page-row layout, plus the columns named in ``keep``."""
    fields = with_page_fields(df, html)
    named = fields.withColumn(
        "schema_org_name", pages.company_name(F.col("json_ld_name"), F.col("h1"), F.col("title"))
    )
    return named.select(
        "domain",
        F.col(url).alias("url"),
        blank_to_null(F.col("schema_org_name")).alias("company_name"),
        blank_to_null(strip(F.col("json_ld_industry"))).alias("industry"),
        extract_abn(F.col("page_text")).alias("scraped_abn"),
        "title",
        "meta_description",
        "h1",
        "schema_org_name",
        F.lit("Schema").alias("source"),
        *keep,
    )


def with_prompt_text(
    df: DataFrame, html: str = "html", max_chars: int | None = None, only: Column | None = None
) -> DataFrame:
    """Add ``prompt_text``: page text without boilerplate, NULL where ``only`` fails.

    The whole text; a user whose model takes less may cut it at ``max_chars`` (marked by dots).
    """
    only = F.lit(True) if only is None else only
    staged = df.withColumn("_cut", F.when(only, pages.cut_tags(pages.prompt_markup(F.col(html)))))
    staged = staged.withColumn("_all", pages.spaced_text(F.col("_cut")))
    text = F.col("_all")
    if max_chars is not None:
        cut = F.concat(F.left(text, F.lit(max_chars)), F.lit("..."))
        text = F.when(F.length(text) > max_chars, cut).otherwise(text)
    return staged.withColumn("prompt_text", text).drop("_cut", "_all")


def extraction_prompt(url: Column, text: Column) -> Column:
    """The request for name and industry (fixed wording)."""
    return F.concat(
        F.lit(
            "You will receive website text. Output ONLY a JSON object with keys: "
            '"company_name" and "industry". If not a company page, set both to null.\n\nURL: '
        ),
        url,
        F.lit("\n\nTEXT:\n"),
        text,
        F.lit("\n\nJSON:"),
    )


def with_extraction_prompt(rows: DataFrame, html: str = "html") -> DataFrame:
    """Add ``prompt`` to rows without a name; NULL elsewhere."""
    staged = with_prompt_text(rows, html, only=F.col("company_name").isNull())
    return staged.withColumn("prompt", extraction_prompt(F.col("url"), F.col("prompt_text"))).drop("prompt_text")


def parse_extraction_answer(answer: Column) -> Column:
    """Struct (company_name, industry) from an answer that may carry a code fence."""
    found = F.regexp_extract(answer, r"(?s)(\{.*\})", 1)
    return F.from_json(found, "company_name string, industry string")


def apply_extraction_answer(rows: DataFrame, answer: str = "answer") -> DataFrame:
    """Let non-empty answer values override name and industry on rows that asked."""
    staged = rows.withColumn("_said", parse_extraction_answer(F.col(answer)))
    asked = F.col("company_name").isNull()
    name = blank_to_null(F.col("_said.company_name"))
    industry = blank_to_null(F.col("_said.industry"))
    return staged.withColumns(
        {
            "source": F.when(asked & name.isNotNull(), F.lit("LLM")).otherwise(F.col("source")),
            "industry": F.when(asked, F.coalesce(industry, F.col("industry"))).otherwise(F.col("industry")),
            "company_name": F.coalesce(F.col("company_name"), name),
        }
    ).drop("_said")


def extraction_counters(rows: DataFrame, asked: Column | None = None) -> DataFrame:
    """Pages kept, answers asked for, and how many rows carry a name or a number."""
    asked = F.col("company_name").isNull() if asked is None else asked
    return rows.agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(asked).alias("fallback_calls"),
        F.count_if(F.col("company_name").isNotNull()).alias("with_name"),
        F.count_if(F.col("scraped_abn").isNotNull()).alias("with_abn"),
    )


def extract_pages(records: DataFrame, max_records: int | None = None) -> DataFrame:
    """Archive records to page rows; ``max_records`` is the user's own cap, if any."""
    pages_in = keep_record_types(records).select(
        F.col("target_uri").alias("url"), F.col("payload").alias("html"), "file", "pos"
    )
    rows = page_rows(keep_country_pages(pages_in), keep=("file", "pos", "html"))
    return rows.orderBy("file", "pos").limit(max_records) if max_records else rows


def page_row_columns(df: DataFrame) -> DataFrame:
    return df.select(*schemas.PAGE_ROW.names)
