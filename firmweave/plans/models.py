"""Clean, enriched and unified tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmweave.operators.numbering import dense_ids
from firmweave.operators.skew import FAN, ROWS_PER_TASK, SALT, count_keys, hot_keys, replicated, salted, spread_join
from firmweave.schemas import COMPANIES, CONFIDENCE
from firmweave.session import cut_lineage

_COMPANY_COLUMNS = [
    name for name in COMPANIES.names if name not in ("company_id", "updated_at")
]


def _trimmed_or_null(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def registry_clean(registry: DataFrame) -> DataFrame:
    """Active, named register rows with standard spelling and one address text."""
    address = F.concat_ws(", ", *[_trimmed_or_null(c) for c in ("address_line_1", "address_line_2", "state", "postcode")])
    return registry.filter(
        (F.col("entity_status") == "Active") & F.col("abn").isNotNull() & F.col("entity_name").isNotNull()
    ).select(
        "abn",
        F.upper(F.trim("entity_name")).alias("entity_name"),
        "entity_type",
        "entity_status",
        address.alias("full_address"),
        F.upper(F.trim("state")).alias("state"),
        "postcode",
        "start_date",
        "loaded_at",
    )


def crawl_clean(crawl: DataFrame) -> DataFrame:
    """Crawl rows that name a company or a number."""
    return crawl.filter(
        F.col("website_url").isNotNull()
        & (F.col("scraped_company_name").isNotNull() | F.col("scraped_abn").isNotNull())
    ).select(
        F.col("id").alias("cc_id"),
        "website_url",
        F.trim("scraped_company_name").alias("company_name"),
        F.trim("scraped_industry").alias("industry"),
        F.col("scraped_abn").alias("abn"),
        "html_content_snippet",
        "loaded_at",
    )


def matched_enriched(matches: DataFrame, sites: DataFrame, entities: DataFrame) -> DataFrame:
    """Matches with the clean site (``crawl_clean``) and the clean register row (``registry_clean``)."""
    site = sites.select(
        "cc_id",
        "website_url",
        F.col("company_name").alias("cc_company_name"),
        F.col("industry").alias("cc_industry"),
    )
    entity = entities.select(
        "abn",
        F.col("entity_name").alias("abr_entity_name"),
        "entity_type",
        "entity_status",
        "full_address",
        "state",
        "postcode",
        "start_date",
    )
    joined = spread_join(
        matches.join(site, "cc_id"), entity, "abn", [F.col("cc_id")], counts=count_keys(matches, "abn")
    )
    return joined.select(
        "match_id",
        "cc_id",
        "abn",
        "match_method",
        "match_confidence",
        "match_reasoning",
        "website_url",
        "cc_company_name",
        "cc_industry",
        "abr_entity_name",
        "entity_type",
        "entity_status",
        "full_address",
        "state",
        "postcode",
        "start_date",
        F.col("created_at").alias("matched_at"),
    )


def register_only(entities: DataFrame, enriched: DataFrame) -> DataFrame:
    """Clean register rows without an enriched match; numbers are made distinct first."""
    return entities.join(enriched.select("abn").distinct(), "abn", "left_anti")


def crawl_only(sites: DataFrame, matches: DataFrame) -> DataFrame:
    """Clean crawl rows that appear in no match, enriched or not.

    NULL ids among the matches are ignored (a NOT IN would then give no rows at all).
    """
    taken = matches.select("cc_id").filter(F.col("cc_id").isNotNull())
    return sites.join(taken, "cc_id", "left_anti")


def companies_unnumbered(
    registry: DataFrame,
    crawl: DataFrame,
    matches: DataFrame,
    active_only: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Matched, register-only and crawl-only companies, from two joins in all.

    Equal to the union of ``matched_enriched``, ``register_only`` and ``crawl_only``,
    which would join the same inputs five times:

    1. Sites left-join the matches on cc_id: a site without a match is crawl-only.
    2. The result full-outer-joins the register on abn: both sides present is a
       matched company, a register row alone is register-only. A matched site
       whose register row is not clean (a cancelled entity, say) is in neither group
       and goes; with ``active_only`` it counts as crawl-only instead.

    Hot numbers are spread, if a clean site stands behind one of their links: only then does
    a repeated register row that meets no site go, since another one of its number
    has. Sites without a match get keys of their own, so they do not pile up under NULL.
    """
    sites, entities = crawl_clean(crawl), registry_clean(registry)
    links = matches.filter(F.col("cc_id").isNotNull()).select(
        "cc_id", F.col("abn").alias("link_abn"), "match_confidence", F.col("created_at").alias("matched_at")
    )
    if active_only:
        links = links.withColumnRenamed("link_abn", "abn")
        links = spread_join(links, entities.select("abn"), "abn", [F.col("cc_id")], "left_semi").withColumnRenamed(
            "abn", "link_abn"
        )
    links = links.withColumn("linked", F.lit(True))
    joined = sites.drop("html_content_snippet").join(links, "cc_id", "left").withColumns(
        {"linked": F.col("linked").isNotNull(), "site_loaded_at": F.col("loaded_at"), "site_abn": F.col("abn")}
    ).drop("loaded_at", "abn")
    # A link without a number only says that its site is taken.
    joined = joined.filter(~F.col("linked") | F.col("link_abn").isNotNull())
    alone = F.concat(F.lit("~"), F.xxhash64("cc_id").cast("string"))
    keyed = joined.withColumn("key", F.when(F.col("linked"), F.col("link_abn")).otherwise(alone))

    counts = count_keys(links.select(F.col("link_abn").alias("key")), "key")
    hot = hot_keys(counts, "key", rows_per_task=rows_per_task)
    behind = links.select("cc_id", F.col("link_abn").alias("key")).join(F.broadcast(hot), "key")
    met = behind.join(sites.select("cc_id"), "cc_id", "left_semi").select("key").distinct()
    hot = cut_lineage(hot.join(met, "key", "left_semi"))
    left = salted(keyed, "key", hot, [F.col("cc_id")])
    right = replicated(entities.withColumn("key", F.col("abn")), "key", hot)
    both = left.join(right, ["key", SALT], "full_outer")

    has_site, has_entity = F.col("cc_id").isNotNull(), F.col("entity_name").isNotNull()
    source = (
        F.when(has_site & has_entity, F.lit("BOTH"))
        .when(has_site & ~F.col("linked"), F.lit("CC"))
        .when(~has_site & (F.col(FAN) == 1), F.lit("ABR"))
    )
    rows = both.withColumn("data_source", source).filter(F.col("data_source").isNotNull())
    from_site = F.col("data_source") == "CC"
    return rows.select(
        F.when(from_site, F.col("site_abn")).otherwise(F.col("abn")).alias("abn"),
        F.when(from_site, F.col("company_name"))
        .otherwise(F.coalesce("company_name", "entity_name"))
        .alias("company_name"),
        "website_url",
        "industry",
        "full_address",
        "state",
        "postcode",
        "entity_type",
        "entity_status",
        "start_date",
        "data_source",
        F.col("match_confidence").cast(CONFIDENCE).alias("match_confidence"),
        F.when(F.col("data_source") == "BOTH", F.col("matched_at"))
        .when(from_site, F.col("site_loaded_at"))
        .otherwise(F.col("loaded_at"))
        .alias("created_at"),
    ).select(*_COMPANY_COLUMNS)


def company_order() -> list[Column]:
    """Order of the company ids; the address breaks ties, so it is total."""
    return [
        F.col("data_source").desc(),
        F.col("abn").asc_nulls_last(),
        F.col("website_url").asc_nulls_last(),
        F.col("company_name").asc_nulls_last(),
    ]


def one_row_per_abn(companies: DataFrame) -> DataFrame:
    """Keep the most confident row of each number; rows without a number stay."""
    # Rows without a number get groups of their own, by address, so they do not form one big one.
    own = F.when(F.col("abn").isNull(), F.struct("website_url", "company_name"))
    order = Window.partitionBy("abn", own).orderBy(
        F.col("match_confidence").desc_nulls_last(), F.col("website_url").asc_nulls_last()
    )
    return companies.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1).drop("_n")


def companies(
    registry: DataFrame,
    crawl: DataFrame,
    matches: DataFrame,
    now: Column,
    unique_abn: bool = False,
    active_only: bool = False,
) -> DataFrame:
    """The company dimension with dense ids."""
    rows = companies_unnumbered(registry, crawl, matches, active_only)
    if unique_abn:
        rows = one_row_per_abn(rows)
    numbered = dense_ids(rows, company_order(), "company_id")
    return numbered.withColumn("updated_at", now).select(*COMPANIES.names)


def lost_matches(registry: DataFrame, crawl: DataFrame, matches: DataFrame) -> DataFrame:
    """Clean sites whose only matches point at register rows that are not clean: absent from the mart."""
    links = matches.filter(F.col("cc_id").isNotNull()).select("cc_id", "abn")
    kept = spread_join(links, registry_clean(registry).select("abn"), "abn", [F.col("cc_id")], "left_semi")
    sites = crawl_clean(crawl).select("cc_id", "website_url")
    return sites.join(links, "cc_id", "left_semi").join(kept, "cc_id", "left_anti")
