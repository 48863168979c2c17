"""The whole job: extract, load, match, unify, check, count."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmweave.functions import web
from firmweave.operators import extract, load, match, quality, stats, upsert
from firmweave.operators.name_index import NameIndex
from firmweave.plans import models
from firmweave.plans.kept_mart import KeptMart
from firmweave.session import cut_lineage
from firmweave.sources import archive, page_lines, register_xml, tables


@dataclass
class Report:
    """Everything a run tells; all entries are DataFrames, read them as needed."""

    companies: DataFrame
    attempts: DataFrame
    checks: DataFrame
    quarantined: DataFrame
    statistics: dict[str, DataFrame] = field(default_factory=dict)
    missing_tables: list[str] = field(default_factory=list)


def load_pages(spark: SparkSession, root: str, lines: DataFrame) -> DataFrame:
    """Upsert page rows that carry a ``load_order`` into the crawl table."""
    rows = load.crawl_rows(lines, keep=("load_order",))
    fresh = upsert.latest_crawl(rows, F.col("load_order"))
    now = F.current_timestamp()
    return tables.upsert_table(spark, root, "crawl", fresh, lambda current, highest: upsert.merge_crawl(current, fresh, now, F.lit(highest)))


def load_register(spark: SparkSession, root: str, xml_path: str) -> DataFrame:
    """Upsert register files into the registry table."""
    rows = load.registry_rows(register_xml.read_register(spark, xml_path), keep=("load_order",))
    fresh = cut_lineage(upsert.latest_registry(rows, F.col("load_order")))
    return tables.upsert_table(spark, root, "registry", fresh, lambda current, _: upsert.merge_registry(current, fresh, F.current_timestamp()))


def extract_to_lines(
    spark: SparkSession,
    archives: str,
    lines_path: str,
    max_records: int | None = None,
    scorer: Callable[[str], str | None] | None = None,
) -> DataFrame:
    """Write the page rows of an archive folder as JSON lines; returns them with their ``load_order``.

    The order is that of the archives (file, record), so which of two captures of an address wins does not depend
    on how the lines are dealt to files. With a ``scorer``, rows without a name are put to it (see
    ``extract.with_extraction_prompt``). Archives are read once, and the scorer asked once: both are written first.
    """
    pages = extract.extract_pages(archive.read_archives(spark, archives, web.COUNTRY_PART), max_records)
    if scorer is None:
        rows = pages.drop("html")
    else:
        pages = cut_lineage(pages)
        asked = extract.with_extraction_prompt(pages.filter(F.col("company_name").isNull()))
        keyed = asked.withColumn("id", F.struct("file", "pos"))
        answers = cut_lineage(match.score_prompts(keyed, scorer).select("id", "answer"))
        rows = pages.drop("html").withColumn("id", F.struct("file", "pos")).join(answers, "id", "left")
        rows = extract.apply_extraction_answer(rows).drop("id", "answer")
    rows = cut_lineage(rows.withColumn("load_order", F.struct("file", "pos")))
    page_lines.write_page_lines(rows, lines_path)
    return rows


def add_manual(spark: SparkSession, root: str, manual: DataFrame) -> DataFrame:
    """Put manual pairs with valid keys into the match table, in place of other matches of their sites."""
    current = tables.read_table(spark, root, "matches")
    ours = match.with_manual(current.limit(0), manual)
    valid, _ = quality.split_valid_matches(
        ours, tables.read_table(spark, root, "crawl"), tables.read_table(spark, root, "registry")
    )
    valid = cut_lineage(valid)
    others = current.join(valid.select("cc_id"), "cc_id", "left_anti").select(*current.columns)
    return tables.write_table(match.append_matches(others, valid, F.current_timestamp()), root, "matches")


def run_matching(
    spark: SparkSession,
    root: str,
    strategy: str = "all",
    limits: dict[str, int] | None = None,
    scorer: Callable[[str], str | None] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Match unmatched sites and append valid results: (matches, attempts, quarantined).

    The name tier reads an index under ``root``, which is first brought up to the register.
    """
    registry, crawl = tables.read_table(spark, root, "registry"), tables.read_table(spark, root, "crawl")
    current = tables.read_table(spark, root, "matches")
    index = None
    if strategy in ("all", "fuzzy"):
        index = NameIndex(spark, f"{root}/name_index", tables.stored(spark, root, "registry"))
        index.refresh()
    new, attempts = match.match_all(crawl, registry, strategy, limits, scorer, current, index)
    valid, quarantined = quality.split_valid_matches(new, crawl, registry)
    return tables.append_table(spark, root, valid, F.current_timestamp()), attempts, quarantined


def build_companies(
    spark: SparkSession, root: str, unique_abn: bool = False, active_only: bool = False, incremental: bool = False
) -> DataFrame:
    """The company table, built in full, or (``incremental``) from what changed since the last build, with ids that stay."""
    if incremental:
        if unique_abn:
            raise ValueError("one row an abn is picked among all rows; build in full")
        table = KeptMart(spark, root, active_only).refresh(F.current_timestamp())
        table.createOrReplaceTempView("companies")
        return table
    table = models.companies(
        tables.read_table(spark, root, "registry"),
        tables.read_table(spark, root, "crawl"),
        tables.read_table(spark, root, "matches"),
        F.current_timestamp(),
        unique_abn=unique_abn,
        active_only=active_only,
    )
    return tables.write_table(table, root, "companies")


def run_pipeline(
    spark: SparkSession,
    root: str,
    archives: str | None = None,
    lines_path: str | None = None,
    register_path: str | None = None,
    strategy: str = "all",
    limits: dict[str, int] | None = None,
    max_records: int | None = None,
    scorer: Callable[[str], str | None] | None = None,
    page_scorer: Callable[[str], str | None] | None = None,
    unique_abn: bool = False,
    active_only: bool = False,
    manual: DataFrame | None = None,
    incremental: bool = False,
) -> Report:
    """Run all steps whose inputs are given; tables live in Parquet folders under ``root``.

    ``lines_path`` is where extracted pages go (default ``root/pages``), or, without
    ``archives``, where they come from. ``manual``: pairs (cc_id, abn, match_reasoning) that go into the match
    table before the tiers run and replace other matches of their sites. The report's ``statistics`` also hold the
    counters of each step that ran: pages, archive_errors, lines, register. ``incremental`` derives only the companies
    that changes touch, and their ids stay (see ``kept_mart``).
    """
    counters: dict[str, DataFrame] = {}
    if archives:
        lines_path = lines_path or f"{root}/pages"
        pages = extract_to_lines(spark, archives, lines_path, max_records, page_scorer)
        counters["pages"] = extract.extraction_counters(pages, F.col("source") == "LLM")
        counters["archive_errors"] = archive.read_errors(archive.read_archives(spark, archives, web.COUNTRY_PART))
        load_pages(spark, root, pages)
    elif lines_path:
        lines = page_lines.read_page_lines(spark, lines_path)
        counters["lines"] = page_lines.line_counters(lines)
        load_pages(spark, root, page_lines.good_lines(lines))
    if register_path:
        entities = load.registry_rows(register_xml.read_register(spark, register_path), keep=("file",))
        counters["register"] = load.register_counters(entities, "file")
        load_register(spark, root, register_path)
    if manual is not None:
        add_manual(spark, root, manual)
    matches, attempts, quarantined = run_matching(spark, root, strategy, limits, scorer)
    companies = build_companies(spark, root, unique_abn, active_only, incremental)

    registry, crawl = tables.read_table(spark, root, "registry"), tables.read_table(spark, root, "crawl")
    named = {"registry": registry, "crawl": crawl, "matches": matches, "companies": companies}
    checks = cut_lineage(quality.run_suite(named, quality.STAGING_CHECKS + quality.MART_CHECKS))
    return Report(
        companies=companies,
        attempts=attempts,
        checks=checks,
        quarantined=quarantined,
        statistics={
            "table_counts": stats.table_counts(crawl, registry, matches),
            "matches_by_method": stats.matches_by_method(matches),
            "count_with_total": stats.count_with_total(matches),
            "companies_by_source": stats.companies_by_source(companies),
            "companies_by_state": stats.companies_by_state(companies),
            "match_rate": stats.match_rate(attempts),
            "site_match_rate": stats.site_match_rate(crawl, matches),
            "lost_matches": models.lost_matches(registry, crawl, matches),
            **counters,
        },
        missing_tables=quality.missing_tables(spark, root, [n for n in tables.TABLES if not (incremental and n == "companies")]),
    )
