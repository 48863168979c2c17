"""Skew-safe joins, numbering, upserts and the mart on small fixtures."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.fixtures import load
from firmweave.operators import stats, upsert
from firmweave.operators.numbering import dense_ids
from firmweave.operators.skew import spread_join
from firmweave.plans import models

SF = "/root/testdata/sf0.001"


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else (f"k{i % 7}" if i % 2 else None)) for i in range(300)], "id long, k string")
    parent = spark.createDataFrame([("hot", 1), ("k1", 2), ("k3", 3), ("other", 4)], "k string, v int")
    got = spread_join(facts, parent, "k", [F.col("id")], how, rows_per_task=10)
    assert rows(got) == rows(facts.join(parent, "k", how))


def test_hot_key_is_spread(spark):
    from firmweave.operators.skew import SALT, count_keys, hot_keys, salted

    facts = spark.range(1000).withColumn("k", F.when(F.col("id") < 900, "hot").otherwise(F.col("id").cast("string")))
    hot = hot_keys(count_keys(facts, "k"), "k", rows_per_task=100)
    sizes = [r["count"] for r in salted(facts, "k", hot, [F.col("id")]).groupBy("k", SALT).count().collect()]
    assert hot.count() == 1 and max(sizes) < 200 and sum(sizes) == 1000


def test_dense_ids_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("v"), F.lit("x").alias("w")).repartition(7)
    got = [(r.n, r.v) for r in dense_ids(df, [F.col("v").desc()], "n", start=5).orderBy("n").collect()]
    values = sorted((i * 7919 % 1009 for i in range(1000)), reverse=True)
    assert got == list(enumerate(values, 5))


def test_dense_ids_of_nothing(spark):
    assert dense_ids(spark.range(0), [F.col("id")], "n").count() == 0


def test_crawl_upsert_keeps_id_and_file(spark):
    current = spark.createDataFrame(
        [(7, "u1", "a", None, None, None, "f1", None), (9, "u2", "b", None, None, None, "f2", None)],
        "id long, website_url string, scraped_company_name string, scraped_industry string, scraped_abn string, "
        "html_content_snippet string, warc_file_path string, loaded_at timestamp",
    )
    incoming = spark.createDataFrame(
        [("u2", "b1", 1), ("u2", None, 2), ("u4", "d", 1), ("u3", "c", 1)],
        "website_url string, scraped_company_name string, seq int",
    ).select("*", *[F.lit(None).cast("string").alias(c) for c in ("scraped_industry", "scraped_abn", "html_content_snippet")])
    merged = upsert.upsert_crawl(current, incoming, F.col("seq"), F.current_timestamp())
    got = {r.website_url: (r.id, r.scraped_company_name, r.warc_file_path) for r in merged.collect()}
    assert got == {"u1": (7, "a", "f1"), "u2": (9, None, "f2"), "u3": (10, "c", None), "u4": (11, "d", None)}


@pytest.fixture(scope="module")
def staged(spark):
    return [load(spark, SF, name) for name in ("registry_fx", "crawl_fx", "matches_fx")]


def plain_mart(registry, crawl, matches):
    """The mart as the union of its three parts."""
    sites, entities = models.crawl_clean(crawl), models.registry_clean(registry)
    enriched = models.matched_enriched(matches, sites, entities)
    none = F.lit(None).cast("string")
    both = enriched.select("abn", F.coalesce("cc_company_name", "abr_entity_name").alias("company_name"), "website_url", "full_address", F.lit("BOTH").alias("data_source"), "match_confidence")
    abr = models.register_only(entities, enriched).select("abn", F.col("entity_name").alias("company_name"), none.alias("website_url"), "full_address", F.lit("ABR").alias("data_source"), F.lit(None).cast("decimal(3,2)").alias("match_confidence"))
    cc = models.crawl_only(sites, matches).select("abn", "company_name", "website_url", none.alias("full_address"), F.lit("CC").alias("data_source"), F.lit(None).cast("decimal(3,2)").alias("match_confidence"))
    return both.unionByName(abr).unionByName(cc)


@pytest.mark.parametrize("rows_per_task", [1_000_000, 3])
def test_mart_from_two_joins_equals_union(spark, staged, rows_per_task):
    registry, crawl, matches = staged
    # A third of all sites point at one register row, some matches lack a key, one site has two.
    hot = matches.withColumn("abn", F.when(F.col("cc_id") % 3 == 0, F.lit("10000000007")).otherwise(F.col("abn")))
    extra = hot.limit(1).select(F.lit(99999).alias("match_id"), "cc_id", F.lit("10000000009").alias("abn"), *hot.columns[3:])
    broken = hot.limit(2).withColumn("abn", F.lit(None).cast("string")).withColumn("cc_id", F.lit(2).cast("long"))
    orphan = hot.limit(1).withColumn("cc_id", F.lit(None).cast("long"))
    links = hot.unionByName(extra).unionByName(broken).unionByName(orphan)
    got = models.companies_unnumbered(registry, crawl, links, rows_per_task=rows_per_task)
    want = plain_mart(registry, crawl, links)
    assert rows(got.select(*want.columns)) == rows(want)


@pytest.mark.parametrize("rows_per_task", [1, 3, 1_000_000])
def test_hot_number_without_clean_sites_stays_a_company(spark, staged, rows_per_task):
    """Links of sites that are not clean make a number hot, but no match: its company is in the register only."""
    registry, crawl, matches = staged
    entity = registry.where("entity_status = 'Active' AND entity_name IS NOT NULL").limit(1).withColumn("abn", F.lit("99999999999"))
    junk = crawl.limit(4).withColumn("id", F.col("id") + 1_000_000).withColumn("website_url", F.concat(F.lit("junk"), F.col("id").cast("string")))
    junk = junk.withColumn("scraped_company_name", F.lit(None).cast("string")).withColumn("scraped_abn", F.lit(None).cast("string"))
    links = matches.limit(1).drop("cc_id", "abn").crossJoin(junk.select(F.col("id").alias("cc_id"), F.lit("99999999999").alias("abn")))
    got = models.companies_unnumbered(registry.unionByName(entity), crawl.unionByName(junk), links.select(*matches.columns), rows_per_task=rows_per_task)
    assert [r.data_source for r in got.where("abn = '99999999999'").collect()] == ["ABR"]


def test_created_at_is_that_of_the_match(spark, staged):
    registry, crawl, matches = staged
    got = models.companies_unnumbered(registry, crawl, matches.withColumn("created_at", F.lit(None).cast("timestamp")))
    seen = {(r.data_source, r.created_at is None) for r in got.select("data_source", "created_at").collect()}
    assert ("BOTH", True) in seen and ("BOTH", False) not in seen and ("ABR", False) in seen and ("CC", False) in seen


def test_active_only_keeps_sites_of_cancelled_entities(spark, staged):
    registry, crawl, matches = staged
    lost = models.lost_matches(registry, crawl, matches).count()
    usual = {r.data_source: r.companies for r in stats.companies_by_source(models.companies_unnumbered(*staged)).collect()}
    kept = {
        r.data_source: r.companies
        for r in stats.companies_by_source(models.companies_unnumbered(*staged, active_only=True)).collect()
    }
    assert lost > 0
    assert kept == {**usual, "CC": usual["CC"] + lost}


def test_count_with_total_of_nothing(spark, staged):
    none = staged[2].limit(0)
    assert [tuple(r) for r in stats.count_with_total(none).collect()] == [("TOTAL", 0)]
