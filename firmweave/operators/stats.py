"""Statistics on matches and companies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def matches_by_method(matches: DataFrame) -> DataFrame:
    """Count and confidence range of each method, most frequent first."""
    return (
        matches.groupBy("match_method")
        .agg(
            F.count(F.lit(1)).alias("matches"),
            F.avg("match_confidence").alias("avg_confidence"),
            F.min("match_confidence").alias("min_confidence"),
            F.max("match_confidence").alias("max_confidence"),
        )
        .orderBy(F.col("matches").desc(), F.col("match_method"))
    )


def companies_by_state(companies: DataFrame) -> DataFrame:
    return (
        companies.filter(F.col("state").isNotNull())
        .groupBy("state")
        .agg(
            F.count(F.lit(1)).alias("company_count"),
            F.count_if(F.col("website_url").isNotNull()).alias("with_website"),
        )
        .orderBy(F.col("company_count").desc(), F.col("state"))
    )


def companies_by_source(companies: DataFrame) -> DataFrame:
    return companies.groupBy("data_source").agg(F.count(F.lit(1)).alias("companies")).orderBy("data_source")


def table_counts(crawl: DataFrame, registry: DataFrame, matches: DataFrame) -> DataFrame:
    """One row: crawl rows, active register rows, matches."""
    parts = [
        crawl.agg(F.count(F.lit(1)).alias("n")).scalar().alias("crawl_rows"),
        registry.agg(F.count_if(F.col("entity_status") == "Active").alias("n")).scalar().alias("active_register_rows"),
        matches.agg(F.count(F.lit(1)).alias("n")).scalar().alias("match_rows"),
    ]
    return crawl.sparkSession.range(1).select(*parts)


def count_with_total(matches: DataFrame) -> DataFrame:
    """Matches per method and a TOTAL row, which is there for an empty table too."""
    per_method = matches.groupBy("match_method").agg(F.count(F.lit(1)).alias("n"))
    labelled = per_method.select(
        F.coalesce("match_method", F.lit("No matches yet")).alias("match_method"), "n"
    )
    total = per_method.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return labelled.unionByName(total.select(F.lit("TOTAL").alias("match_method"), "n"))


def match_rate(attempts: DataFrame) -> DataFrame:
    """Matched over tried, summed over tiers (a site may be tried by several)."""
    return attempts.agg(
        F.coalesce(F.sum("matched"), F.lit(0)).alias("matched"),
        F.coalesce(F.sum("candidates"), F.lit(0)).alias("candidates"),
    ).withColumn(
        "rate_percent",
        F.when(F.col("candidates") > 0, F.round(F.col("matched") / F.col("candidates") * 100, 1)),
    )


def site_match_rate(crawl: DataFrame, matches: DataFrame) -> DataFrame:
    """Share of crawl rows with at least one match, each counted once."""
    taken = matches.select(F.col("cc_id").alias("id")).filter(F.col("id").isNotNull())
    matched = crawl.select("id").join(taken, "id", "left_semi").agg(F.count(F.lit(1)).alias("n")).scalar()
    return (
        crawl.agg(F.count(F.lit(1)).alias("sites"))
        .withColumn("matched_sites", matched)
        .withColumn(
            "rate_percent",
            F.when(F.col("sites") > 0, F.round(F.col("matched_sites") / F.col("sites") * 100, 1)),
        )
    )


def match_quality(matches: DataFrame, labels: DataFrame) -> DataFrame:
    """Precision, recall and F1 per method against true pairs (cc_id, abn)."""
    truth = labels.select("cc_id", "abn").distinct().withColumn("hit", F.lit(1))
    total = labels.select("cc_id", "abn").distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = (
        matches.select("cc_id", "abn", "match_method")
        .join(truth, ["cc_id", "abn"], "left")
        .groupBy("match_method")
        .agg(F.count(F.lit(1)).alias("predicted"), F.count("hit").alias("correct"))
        .withColumn("labelled", total)
    )
    precision = F.col("correct") / F.col("predicted")
    recall = F.when(F.col("labelled") > 0, F.col("correct") / F.col("labelled"))
    f1 = F.when(
        F.col("predicted") + F.col("labelled") > 0,
        2 * F.col("correct") / (F.col("predicted") + F.col("labelled")),
    )
    return counted.withColumns({"precision": precision, "recall": recall, "f1": f1})


def review_sample(matches: DataFrame, per_method: int = 100) -> DataFrame:
    """A repeatable sample of each method for manual review, in order of a hash of the id."""
    order = Window.partitionBy("match_method").orderBy(F.md5(F.col("match_id").cast("string")), "match_id")
    return (
        matches.withColumn("sample_rank", F.row_number().over(order))
        .filter(F.col("sample_rank") <= per_method)
        .select("match_id", "cc_id", "abn", "match_method", "match_confidence", "sample_rank")
    )


def top_matched(companies: DataFrame, n: int = 100) -> DataFrame:
    """Matched companies by confidence, the n surest first."""
    return (
        companies.filter(F.col("data_source") == "BOTH")
        .select("company_name", "abn", "website_url", "industry", "state", "data_source", "match_confidence")
        .orderBy(F.col("match_confidence").desc(), F.col("abn"), F.col("website_url"))
        .limit(n)
    )


def with_word(df: DataFrame, column: str, word: str) -> DataFrame:
    """Rows whose text holds the word (lower-cased, split at other characters, no stemming)."""
    words = F.split(F.lower(F.col(column)), "[^a-z0-9]+")
    return df.filter(F.array_contains(words, word.lower()))
