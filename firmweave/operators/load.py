"""From page rows and register elements to staging rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmweave.functions.dates import parse_date
from firmweave.functions.text import blank_to_null, stripped_or_null


def context_snippet(title: Column, h1: Column, description: Column) -> Column:
    """``Title: … | H1: … | Description: …`` of the non-empty parts, NULL when there are none."""
    parts = [("Title: ", title), ("H1: ", h1), ("Description: ", description)]
    labelled = [F.when(value != "", F.concat(F.lit(label), value)) for label, value in parts]
    return blank_to_null(F.concat_ws(" | ", *labelled))


def crawl_rows(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Page rows in the layout of the crawl staging table; rows without url go."""
    return pages.filter(F.col("url") != "").select(
        F.col("url").alias("website_url"),
        F.col("company_name").alias("scraped_company_name"),
        F.col("industry").alias("scraped_industry"),
        "scraped_abn",
        context_snippet(F.col("title"), F.col("h1"), F.col("meta_description")).alias("html_content_snippet"),
        F.lit(None).cast("string").alias("warc_file_path"),
        *keep,
    )


def first_present(*values: Column) -> Column:
    """First value that is neither NULL nor empty."""
    return F.coalesce(*[blank_to_null(value) for value in values])


def loaded_address(line_1: Column, line_2: Column) -> Column:
    """Non-blank address lines, stripped, joined by a space; NULL when there are none."""
    return blank_to_null(F.concat_ws(" ", stripped_or_null(line_1), stripped_or_null(line_2)))


def registry_rows(elements: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Register elements (see ``schemas.REGISTER_XML``) as staging rows; rows without abn go.

    The address is one whole block: the business address if there is one, else the legal one.
    """
    abn, entity = F.col("ABN"), F.col("MainEntity")
    staged = elements.select(
        abn["_VALUE"].alias("abn"),
        entity["NonIndividualName"]["NonIndividualNameText"].alias("entity_name"),
        F.col("EntityType")["EntityTypeInd"].alias("entity_type"),
        first_present(abn["_status"], abn["_ABNStatus"]).alias("entity_status"),
        F.coalesce(
            entity["BusinessAddress"]["AddressDetails"], entity["LegalAddress"]["AddressDetails"]
        ).alias("address"),
        parse_date(
            first_present(
                abn["_ABNStatusFromDate"], abn["_ABNStatusFrom"], abn["_ABNFromDate"], abn["_FromDate"]
            )
        ).alias("start_date"),
        *keep,
    ).filter(F.col("abn") != "")
    line_1, line_2 = F.col("address.AddressLine1"), F.col("address.AddressLine2")
    return staged.select(
        "abn",
        "entity_name",
        "entity_type",
        "entity_status",
        line_1.alias("address_line_1"),
        line_2.alias("address_line_2"),
        F.col("address.Postcode").alias("postcode"),
        F.col("address.State").alias("state"),
        loaded_address(line_1, line_2).alias("full_address"),
        "start_date",
        F.col("address").isNotNull().alias("has_address"),
        *keep,
    )


def register_counters(rows: DataFrame, by: str) -> DataFrame:
    """Records and addresses found, per file and overall (the row with NULL)."""
    counted = [F.count(F.lit(1)).alias("records"), F.count_if(F.col("has_address")).alias("addresses")]
    per_file = rows.groupBy(F.col(by).alias("file")).agg(*counted)
    return per_file.unionByName(
        per_file.agg(F.sum("records").alias("records"), F.sum("addresses").alias("addresses")).select(
            F.lit(None).cast("string").alias("file"),
            F.coalesce("records", F.lit(0)).alias("records"),
            F.coalesce("addresses", F.lit(0)).alias("addresses"),
        )
    )
