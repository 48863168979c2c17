"""One query per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import load
from firmweave.functions import dates, names, prompts, scoring, similarity, web
from firmweave.operators import extract, load as loading, match, quality, stats, upsert, word_index
from firmweave.operators.name_index import NameIndex
from firmweave.operators.similarity_join import Measure, similar_pairs
from firmweave.plans import models
from firmweave.plans.kept_mart import KeptMart
from firmweave.schemas import CRAWL, MATCHES, REGISTRY
from firmweave.session import cut_lineage, ensure_checkpoint_dir
from firmweave.sources import tables
from firmweave.sources.keyed import KeyedTable, PairLog

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def text_of(name: str):
    return F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss").alias(name)


def staged(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return load(spark, sf, "registry_fx"), load(spark, sf, "crawl_fx"), load(spark, sf, "matches_fx")


def mart(spark: SparkSession, sf: str) -> DataFrame:
    return models.companies_unnumbered(*staged(spark, sf))


# --- models -----------------------------------------------------------------


@query
def registry_clean(spark, sf):
    clean = models.registry_clean(load(spark, sf, "registry_fx"))
    return clean.withColumn("loaded_at", text_of("loaded_at"))


@query
def crawl_clean(spark, sf):
    clean = models.crawl_clean(load(spark, sf, "crawl_fx"))
    return clean.withColumn("loaded_at", text_of("loaded_at"))


def _enriched(spark, sf):
    registry, crawl, matches = staged(spark, sf)
    return models.matched_enriched(matches, models.crawl_clean(crawl), models.registry_clean(registry))


@query
def matched_enriched(spark, sf):
    return _enriched(spark, sf).withColumn("matched_at", text_of("matched_at"))


@query
def register_only(spark, sf):
    entities = models.registry_clean(load(spark, sf, "registry_fx"))
    return models.register_only(entities, _enriched(spark, sf)).select("abn", "entity_name", "state")


@query
def crawl_only(spark, sf):
    _, crawl, matches = staged(spark, sf)
    return models.crawl_only(models.crawl_clean(crawl), matches).select("cc_id", "company_name", "abn")


@query
def companies(spark, sf):
    table = models.companies(*staged(spark, sf), now=F.lit(None).cast("timestamp")).drop("updated_at")
    return table.withColumn("created_at", text_of("created_at"))


@query
def companies_kept(spark, sf):
    """The kept company table after a second load of register rows, sites and matches that the first one lacked or had otherwise."""
    root = f"{ensure_checkpoint_dir(spark)}/kept_{uuid.uuid4().hex}"

    def shaped(df, schema):
        return df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])

    registry, crawl, matches = (shaped(df, schema) for df, schema in zip(staged(spark, sf), (REGISTRY, CRAWL, MATCHES)))
    late = F.col("id") % 5 == 0
    old = crawl.where(F.col("id") % 7 != 0).withColumn("scraped_company_name", F.when(late, "old name").otherwise(F.col("scraped_company_name")))
    tables.write_table(registry.withColumn("entity_status", F.when(F.col("abn").endswith("3"), "Cancelled").otherwise(F.col("entity_status"))), root, "registry")
    tables.write_table(old, root, "crawl")
    tables.write_table(matches.where("cc_id % 3 <> 0"), root, "matches")
    kept, now = KeptMart(spark, root), F.lit("2025-01-01").cast("timestamp")
    kept.refresh(now)
    rows, sites = cut_lineage(registry.where(F.col("abn").endswith("3"))), cut_lineage(crawl.where(late | (F.col("id") % 7 == 0)))

    def put(fresh, key):
        return lambda current, _: current.join(fresh.select(key), key, "left_anti").select(*fresh.columns).unionByName(fresh)

    tables.upsert_table(spark, root, "registry", rows, put(rows, "abn"))
    tables.upsert_table(spark, root, "crawl", sites, put(sites, "website_url"))
    tables.append_table(spark, root, matches.where("cc_id % 3 = 0").drop("match_id", "created_at"), F.lit("2025-03-17").cast("timestamp"))
    return kept.refresh(now).drop("company_id", "updated_at").withColumn("created_at", text_of("created_at"))


@query
def companies_one_per_abn(spark, sf):
    return models.one_row_per_abn(mart(spark, sf)).select("abn", "company_name", "website_url", "match_confidence")


@query
def lost_matches(spark, sf):
    return models.lost_matches(*staged(spark, sf))


@query
def companies_by_source_and_state(spark, sf):
    return (
        mart(spark, sf)
        .groupBy("data_source", "state")
        .agg(F.count(F.lit(1)).alias("companies"), F.count_if(F.col("website_url").isNotNull()).alias("with_website"))
        .orderBy("data_source", F.col("state").asc_nulls_last())
    )


# --- statistics -------------------------------------------------------------


@query
def companies_by_source(spark, sf):
    return stats.companies_by_source(mart(spark, sf))


@query
def companies_by_state(spark, sf):
    return stats.companies_by_state(mart(spark, sf))


@query
def top_matched(spark, sf):
    return stats.top_matched(mart(spark, sf))


@query
def matches_by_method(spark, sf):
    table = stats.matches_by_method(load(spark, sf, "matches_fx"))
    return table.withColumn("avg_confidence", F.round(F.col("avg_confidence").cast("double"), 4))


@query
def table_counts(spark, sf):
    registry, crawl, matches = staged(spark, sf)
    return stats.table_counts(crawl, registry, matches)


@query
def count_with_total(spark, sf):
    return stats.count_with_total(load(spark, sf, "matches_fx"))


@query
def match_rate(spark, sf):
    attempts = (
        load(spark, sf, "matches_fx")
        .groupBy(F.col("match_method").alias("strategy"))
        .agg(F.count_if(F.col("match_confidence") > 0.8).alias("matched"), F.count(F.lit(1)).alias("candidates"))
    )
    return stats.match_rate(attempts)


@query
def site_match_rate(spark, sf):
    _, crawl, matches = staged(spark, sf)
    return stats.site_match_rate(crawl, matches)


def true_pairs(spark, sf):
    crawl = load(spark, sf, "crawl_fx")
    return crawl.filter(~F.col("scraped_company_name").startswith("Unrelated")).select(
        F.col("id").alias("cc_id"), (F.lit(10000000000 - 1) + F.col("id")).cast("string").alias("abn")
    )


@query
def match_quality(spark, sf):
    table = stats.match_quality(load(spark, sf, "matches_fx"), true_pairs(spark, sf))
    return table.withColumns({name: F.round(name, 6) for name in ("precision", "recall", "f1")})


@query
def review_sample(spark, sf):
    return stats.review_sample(load(spark, sf, "matches_fx"))


# --- staging tables ---------------------------------------------------------


@query
def registry_upsert(spark, sf):
    current = load(spark, sf, "registry_fx")
    current = current.withColumn("full_address", loading.loaded_address(F.col("address_line_1"), F.col("address_line_2")))
    incoming = load(spark, sf, "incoming_registry_fx").withColumn("full_address", F.lit(None).cast("string"))
    now = F.lit("2025-04-01 00:00:00").cast("timestamp")
    merged = upsert.upsert_registry(current, incoming, F.col("seq"), now)
    return merged.withColumn("loaded_at", text_of("loaded_at"))


@query
def crawl_upsert(spark, sf):
    current = load(spark, sf, "crawl_fx").withColumn("warc_file_path", F.concat(F.lit("file-"), F.col("id")))
    now = F.lit("2025-04-01 00:00:00").cast("timestamp")
    merged = upsert.upsert_crawl(current, load(spark, sf, "incoming_crawl_fx"), F.col("seq"), now)
    return merged.withColumn("loaded_at", text_of("loaded_at"))


@query
def crawl_upsert_in_buckets(spark, sf):
    """The same upsert on a keyed table, of which only the buckets of incoming sites are rewritten."""
    current = load(spark, sf, "crawl_fx").withColumn("warc_file_path", F.concat(F.lit("file-"), F.col("id")))
    now = F.lit("2025-04-01 00:00:00").cast("timestamp")
    table = KeyedTable(spark, f"{ensure_checkpoint_dir(spark)}/crawl_{uuid.uuid4().hex}", CRAWL, ["website_url"], counter="id")
    table.replace(current.select(*CRAWL.names))
    fresh = upsert.latest_crawl(load(spark, sf, "incoming_crawl_fx"), F.col("seq"))
    merged = table.upsert(fresh, lambda part, highest: upsert.merge_crawl(part, fresh, now, F.lit(highest)))
    return merged.withColumn("loaded_at", text_of("loaded_at"))


@query
def match_append_to_log(spark, sf):
    """Matches of the key tier added to a log that holds some of their pairs already."""
    registry, crawl, matches = staged(spark, sf)
    log = PairLog(spark, f"{ensure_checkpoint_dir(spark)}/matches_{uuid.uuid4().hex}", MATCHES, ["cc_id", "abn"], "match_id")
    log.replace(matches.filter("cc_id % 3 = 0").select(*MATCHES.names))
    merged = log.append(match.match_direct(crawl, registry), ["cc_id", "abn"], {"created_at": F.lit("2025-04-01 00:00:00").cast("timestamp")})
    return merged.withColumn("created_at", text_of("created_at"))


@query
def latest_per_key(spark, sf):
    rows = load(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return upsert.latest_per_key(rows, "user_id", F.col("event_id"))


@query
def match_append(spark, sf):
    registry, crawl, matches = staged(spark, sf)
    new = match.match_direct(crawl, registry)
    merged = match.append_matches(
        matches.filter(F.col("match_method") != "direct_abn"), new, F.lit("2025-04-01 00:00:00").cast("timestamp")
    )
    return merged.withColumn("created_at", text_of("created_at"))


@query
def quarantined_matches(spark, sf):
    registry, crawl, _ = staged(spark, sf)
    # Every site claims a number; many of those numbers are not in the register.
    claims = crawl.select(
        F.col("id").alias("cc_id"),
        (F.lit(10000000000) + F.col("id")).cast("string").alias("abn"),
        F.lit("manual").alias("match_method"),
        ((F.col("id") % 150) / 100).cast("decimal(3,2)").alias("match_confidence"),
        F.lit("claimed").alias("match_reasoning"),
    )
    _, bad = quality.split_valid_matches(claims, crawl, registry)
    return bad.select("cc_id", "abn", "reason")


@query
def valid_matches(spark, sf):
    registry, crawl, _ = staged(spark, sf)
    # The sites' own numbers, claimed twice with unlike confidence.
    claims = crawl.select(
        F.col("id").alias("cc_id"),
        F.col("scraped_abn").alias("abn"),
        F.lit("manual").alias("match_method"),
        F.explode(F.array(*[F.lit(c).cast("decimal(3,2)") for c in ("0.50", "0.75")])).alias("match_confidence"),
        F.lit("claimed").alias("match_reasoning"),
    )
    good, _ = quality.split_valid_matches(claims, crawl, registry)
    return good.select("cc_id", "abn", "match_confidence")


# --- matching ---------------------------------------------------------------


@query
def match_direct(spark, sf):
    registry, crawl, _ = staged(spark, sf)
    return match.match_direct(crawl, registry)


@query
def match_direct_unmatched(spark, sf):
    registry, crawl, matches = staged(spark, sf)
    return match.match_direct(crawl, registry, matches.filter(F.col("match_method") == "llm"))


@query
def unmatched_sites(spark, sf):
    _, crawl, matches = staged(spark, sf)
    return match.unmatched(crawl, matches).select("id", "scraped_company_name")


@query
def first_unmatched_sites(spark, sf):
    _, crawl, matches = staged(spark, sf)
    named = match.unmatched(crawl.filter(F.col("scraped_company_name").isNotNull()), matches)
    return match.first_rows(named, 100).select("id", "website_url")


@query
def named_sites_with_context(spark, sf):
    _, crawl, matches = staged(spark, sf)
    named = match.unmatched(crawl.filter(F.col("scraped_company_name").isNotNull()), matches)
    return named.filter(F.col("html_content_snippet").isNotNull()).select("id", "html_content_snippet")


@query
def match_manual(spark, sf):
    matches = load(spark, sf, "matches_fx")
    manual = matches.filter(F.col("match_method") == "llm").select(
        "cc_id", "abn", F.lit("checked by hand").alias("match_reasoning")
    )
    return match.with_manual(matches, manual)


@query
def normalized_names(spark, sf):
    sites = load(spark, sf, "crawl_fx").select(
        F.col("id"), F.col("scraped_company_name").alias("raw"), names.normalize_name(F.col("scraped_company_name")).alias("name")
    )
    return sites


@query
def normalized_register_names(spark, sf):
    registry = load(spark, sf, "registry_fx")
    return registry.select("abn", names.normalize_name(F.col("entity_name")).alias("name"))


@query
def edit_similarity_of_pairs(spark, sf):
    registry, crawl, matches = staged(spark, sf)
    pairs = matches.join(crawl.select(F.col("id").alias("cc_id"), "scraped_company_name"), "cc_id").join(
        registry.select("abn", "entity_name"), "abn"
    )
    a, b = names.normalize_name(F.col("scraped_company_name")), names.normalize_name(F.col("entity_name"))
    staged_names = pairs.select("cc_id", "abn", a.alias("a"), b.alias("b"))
    return staged_names.select(
        "cc_id", "abn", F.round(similarity.edit_similarity(F.col("a"), F.col("b")), 6).alias("similarity")
    )


@query
def match_by_edit_distance(spark, sf):
    registry, crawl, _ = staged(spark, sf)
    found = match.match_fuzzy(crawl, registry, measure="edit")
    return found.select("cc_id", "abn", "match_method")


@query
def match_by_edit_distance_first_letter(spark, sf):
    registry, crawl, matches = staged(spark, sf)
    found = match.match_fuzzy(crawl, registry, matches, measure="edit", blocking="first_letter")
    return found.select("cc_id", "abn", "match_method")


@query
def similar_name_pairs(spark, sf):
    registry, crawl, _ = staged(spark, sf)
    sites = match.named_sites(crawl, None).select("name").filter(F.col("name") != "").distinct()
    register = match.active_names(registry).select("name").distinct()
    pairs = similar_pairs(sites, register, Measure("edit", 0.9))
    return pairs.withColumn("similarity", F.round("similarity", 6))


@query
def match_fuzzy(spark, sf):
    registry, crawl, matches = staged(spark, sf)
    return match.match_fuzzy(crawl, registry, matches)


@query
def match_fuzzy_all_sites(spark, sf):
    registry, crawl, _ = staged(spark, sf)
    return match.match_fuzzy(crawl, registry)


@query
def match_fuzzy_by_index(spark, sf):
    """The name tier from the kept index, of which a second load changes a part: rows that were cancelled come back."""
    registry, crawl, matches = staged(spark, sf)
    rows = registry.select(*[F.col(f.name) if f.name in registry.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in REGISTRY])
    path = f"{ensure_checkpoint_dir(spark)}/names_{uuid.uuid4().hex}"
    table = KeyedTable(spark, f"{path}/registry", REGISTRY, ["abn"], buckets=16)
    late = F.pmod(F.xxhash64("abn"), F.lit(16)) < 2  # two buckets, so the second load changes these alone
    table.replace(rows.withColumn("entity_status", F.when(late, "Cancelled").otherwise(F.col("entity_status"))))
    index = NameIndex(spark, f"{path}/index", table)
    index.refresh()
    fresh = cut_lineage(rows.where(late))
    table.upsert(fresh, lambda current, _: fresh)
    index.refresh()
    return match.match_fuzzy(crawl, table.read().limit(0), matches, index=index)


@query
def top_candidates(spark, sf):
    registry, crawl, matches = staged(spark, sf)
    registry = registry.withColumn("full_address", F.concat_ws(" ", "address_line_1", "address_line_2"))
    listed = match.top_candidates(crawl, registry, matches)
    return listed.select("id", F.explode("candidates").alias("c")).select(
        "id", "c.rank", "c.abn", F.round("c.similarity", 6).alias("similarity")
    )


@query
def match_assisted(spark, sf):
    registry, crawl, matches = staged(spark, sf)
    registry = registry.withColumn("full_address", F.concat_ws(" ", "address_line_1", "address_line_2"))
    return match.match_assisted(crawl, registry, matches, below=0.85)


@query
def fuzzy_confidence(spark, sf):
    scores = load(spark, sf, "part").select(
        "p_partkey", (F.lit(0.85) + F.col("p_size") / 400.0).alias("similarity"), (F.col("p_size") % 2 == 0).alias("same")
    )
    return scores.select(
        "p_partkey",
        scoring.fuzzy_confidence(F.col("similarity")).alias("confidence"),
        scoring.fuzzy_confidence(F.col("similarity"), state_agrees=F.col("same")).alias("with_bonus"),
    )


@query
def match_reasoning(spark, sf):
    registry, crawl, matches = staged(spark, sf)
    pairs = matches.join(crawl.select(F.col("id").alias("cc_id"), "scraped_company_name"), "cc_id").join(
        registry.select("abn", "entity_name"), "abn"
    )
    return pairs.select(
        "cc_id",
        scoring.direct_reasoning(F.col("abn")).alias("direct"),
        scoring.fuzzy_reasoning(
            F.col("match_confidence").cast("string"), F.col("scraped_company_name"), F.col("entity_name")
        ).alias("fuzzy"),
        scoring.assisted_reasoning(F.col("match_reasoning")).alias("assisted"),
    )


@query
def match_prompt(spark, sf):
    registry, crawl, matches = staged(spark, sf)
    entities = registry.withColumn(
        "full_address", loading.loaded_address(F.col("address_line_1"), F.col("address_line_2"))
    ).filter(F.col("entity_name").isNotNull())
    listed = (
        matches.select(F.col("cc_id").alias("id"), "abn", "match_confidence")
        .join(entities, "abn")
        .groupBy("id")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "abn", "entity_name", "entity_type", "state", "full_address",
                        F.col("match_confidence").cast("double").alias("similarity"),
                    )
                )
            ).alias("candidates")
        )
    )
    return prompts.with_match_prompt(crawl.join(listed, "id")).select("id", "prompt")


@query
def match_answers(spark, sf):
    answers = load(spark, sf, "answers_fx").select("id", prompts.parse_match_answer(F.col("answer")).alias("said"))
    return answers.select("id", "said.matched_abn", "said.confidence", "said.reasoning")


# --- page extraction --------------------------------------------------------


@query
def canonical_domains(spark, sf):
    url = F.col("url")
    variants = load(spark, sf, "pages").select(
        "page_id",
        F.explode(
            F.array(url, F.upper(url), F.replace(url, F.lit("://"), F.lit("://WWW.")),
                    F.regexp_replace(url, r"^([^/]*//[^/?#]*)", "$1.:8080"), F.regexp_replace(url, "^[^/]*//", ""))
        ).alias("url"),
    )
    return variants.select("page_id", "url", web.canonical_domain(F.col("url")).alias("domain"))


@query
def country_domains(spark, sf):
    domain = web.canonical_domain(F.col("url"))
    staged_pages = load(spark, sf, "pages_fx").select("page_id", domain.alias("domain"))
    return staged_pages.select("page_id", "domain", web.is_australian_domain(F.col("domain")).alias("in_country"))


@query
def country_pages(spark, sf):
    return extract.keep_country_pages(load(spark, sf, "pages_fx")).select("page_id", "url", "domain")


def _fields(spark, sf):
    return extract.with_page_fields(load(spark, sf, "pages_fx"))


@query
def page_titles(spark, sf):
    return _fields(spark, sf).select("page_id", "title")


@query
def page_headings(spark, sf):
    return _fields(spark, sf).select("page_id", "h1")


@query
def page_descriptions(spark, sf):
    return _fields(spark, sf).select("page_id", "meta_description")


@query
def page_texts(spark, sf):
    return _fields(spark, sf).select("page_id", "page_text")


@query
def json_ld_facts(spark, sf):
    return _fields(spark, sf).select("page_id", "json_ld_name", "json_ld_industry")


@query
def page_rows(spark, sf):
    rows = extract.page_rows(extract.keep_country_pages(load(spark, sf, "pages_fx")))
    return rows


@query
def extraction_counters(spark, sf):
    return extract.extraction_counters(extract.page_rows(extract.keep_country_pages(load(spark, sf, "pages_fx"))))


@query
def first_page_rows(spark, sf):
    kept = extract.keep_country_pages(load(spark, sf, "pages_fx"))
    return kept.orderBy("page_id").limit(20).select("page_id", "domain")


@query
def business_numbers(spark, sf):
    return _fields(spark, sf).select("page_id", web.extract_abn(F.col("page_text")).alias("abn"))


@query
def business_numbers_in_documents(spark, sf):
    docs = load(spark, sf, "documents")
    labelled = F.concat(
        F.col("text"), F.lit(" abn: "), F.lpad(F.col("doc_id").cast("string"), 11, "5"), F.lit(" a.b.n 11 222 333 444")
    )
    return docs.select("doc_id", labelled.alias("text")).select(
        "doc_id", web.extract_abn(F.col("text")).alias("abn")
    )


@query
def normalized_numbers(spark, sf):
    raw = F.concat(F.lit("No. "), F.col("c_custkey") + 99999999990, F.lit("-x"))
    return load(spark, sf, "customer").select("c_custkey", web.normalize_abn(raw).alias("abn"))


@query
def prompt_texts(spark, sf):
    texts = extract.with_prompt_text(load(spark, sf, "pages_fx"))
    return texts.select("page_id", "prompt_text")


@query
def extraction_prompts(spark, sf):
    texts = extract.with_prompt_text(load(spark, sf, "pages_fx"))
    prompt = extract.extraction_prompt(F.col("url"), F.col("prompt_text"))
    return texts.select("page_id", F.md5(prompt).alias("prompt_md5"), F.length(prompt).alias("prompt_chars"))


@query
def extraction_answers(spark, sf):
    rows = load(spark, sf, "answers_fx").join(load(spark, sf, "crawl_fx"), "id").select(
        "id",
        F.col("scraped_company_name").alias("company_name"),
        F.col("scraped_industry").alias("industry"),
        F.lit("Schema").alias("source"),
        F.col("page_answer").alias("answer"),
    )
    return extract.apply_extraction_answer(rows).drop("answer")


# --- load and register scalars ----------------------------------------------


@query
def context_snippets(spark, sf):
    fields = _fields(spark, sf)
    snippet = loading.context_snippet(F.col("title"), F.col("h1"), F.col("meta_description"))
    return fields.select("page_id", snippet.alias("html_content_snippet"))


@query
def crawl_rows(spark, sf):
    return loading.crawl_rows(extract.page_rows(extract.keep_country_pages(load(spark, sf, "pages_fx"))))


@query
def parsed_dates(spark, sf):
    return load(spark, sf, "stamps_fx").select("c_custkey", dates.parse_date(F.col("stamp")).alias("start_date"))


@query
def first_present_attribute(spark, sf):
    registry = load(spark, sf, "registry_fx")
    return registry.select(
        "abn", loading.first_present(F.col("state"), F.col("address_line_2"), F.col("entity_type")).alias("value")
    )


@query
def loaded_addresses(spark, sf):
    registry = load(spark, sf, "registry_fx")
    return registry.select(
        "abn", loading.loaded_address(F.col("address_line_1"), F.col("address_line_2")).alias("full_address")
    )


@query
def register_counters(spark, sf):
    rows = load(spark, sf, "registry_fx").select(
        F.col("entity_type"), F.col("address_line_1").isNotNull().alias("has_address")
    )
    return loading.register_counters(rows, "entity_type")


@query
def word_search(spark, sf):
    return stats.with_word(mart(spark, sf), "company_name", "ring").select("abn", "company_name", "website_url")


@query
def word_search_by_index(spark, sf):
    """Sites whose scraped name holds both words, through an index of all names."""
    sites = load(spark, sf, "crawl_fx").select("id", "website_url", "scraped_company_name")
    path = f"{ensure_checkpoint_dir(spark)}/word_index_{uuid.uuid4().hex}"
    folders = word_index.build_index(sites, path, "scraped_company_name")
    found = word_index.search(spark, path, ["ring", "medium"], folders)
    return sites.join(found, "id")


# --- quality ----------------------------------------------------------------


@query
def staging_checks(spark, sf):
    registry, crawl, matches = staged(spark, sf)
    return quality.run_suite({"registry": registry, "crawl": crawl, "matches": matches}, quality.STAGING_CHECKS)


@query
def mart_checks(spark, sf):
    table = models.companies(*staged(spark, sf), now=F.lit(None).cast("timestamp"))
    return quality.run_suite({"companies": table}, quality.MART_CHECKS)


@query
def repeated_names(spark, sf):
    return quality.not_unique(models.registry_clean(load(spark, sf, "registry_fx")), "entity_name")


@query
def nameless_companies(spark, sf):
    return quality.nulls(mart(spark, sf), "company_name").select("abn", "website_url", "data_source")


@query
def unexpected_states(spark, sf):
    states = ["NSW", "VIC", "QLD", "WA", "SA"]
    return quality.not_accepted(mart(spark, sf), "state", states).select("abn", "state", "website_url")


@query
def confidence_out_of_range(spark, sf):
    return quality.out_of_range(load(spark, sf, "matches_fx"), "match_confidence", 0.75, 0.9).select(
        "match_id", "match_confidence"
    )


@query
def sites_with_unknown_numbers(spark, sf):
    registry, crawl, _ = staged(spark, sf)
    return quality.orphans(crawl, "scraped_abn", registry, "abn").select("id", "scraped_abn")
