"""The matching tiers: key match, name match, assisted match, manual matches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.functions import prompts
from firmweave.functions.names import normalize_name
from firmweave.functions.scoring import (
    DIRECT_CONFIDENCE,
    FUZZY_THRESHOLD,
    assisted_reasoning,
    direct_reasoning,
    fuzzy_confidence,
    fuzzy_reasoning,
    two_decimals,
)
from firmweave.operators.answers import with_answers
from firmweave.operators.name_index import NameIndex, active_names
from firmweave.operators.numbering import dense_ids
from firmweave.operators.similarity_join import GROUP_ROWS, Measure, best_pairs, candidate_pairs
from firmweave.operators.skew import spread_join
from firmweave.operators.top_join import top_pairs
from firmweave.schemas import CONFIDENCE, MATCH_COLUMNS, MATCHES
from firmweave.session import by_shuffle, cut_lineage

CANDIDATE_FLOOR = 0.60
TOP_CANDIDATES = 5


def unmatched(crawl: DataFrame, matches: DataFrame | None) -> DataFrame:
    """Crawl rows without any match yet (NOT EXISTS on cc_id)."""
    if matches is None:
        return crawl
    taken = matches.select(F.col("cc_id").alias("id")).filter(F.col("id").isNotNull())
    return crawl.join(by_shuffle(taken), "id", "left_anti")


def first_rows(df: DataFrame, limit: int | None, key: str = "id") -> DataFrame:
    """The first ``limit`` rows by key when the user asks for a cap; 0 and None mean no cap."""
    return df.orderBy(key).limit(limit) if limit else df


def match_direct(
    crawl: DataFrame, registry: DataFrame, matches: DataFrame | None = None, limit: int | None = None
) -> DataFrame:
    """Sites whose scraped number is in the register, whatever its status.

    Only the key column of the register is read. One number may stand on a large
    share of all sites, so its rows are spread over many tasks.
    """
    sites = unmatched(crawl.filter(F.col("scraped_abn").isNotNull()), matches)
    keyed = sites.select("id", F.col("scraped_abn").alias("abn"))
    hits = spread_join(keyed, registry.select("abn"), "abn", [F.col("id")], "left_semi")
    return first_rows(hits, limit).select(
        F.col("id").alias("cc_id"),
        "abn",
        F.lit("direct_abn").alias("match_method"),
        F.lit(str(DIRECT_CONFIDENCE)).cast(CONFIDENCE).alias("match_confidence"),
        direct_reasoning(F.col("abn")).alias("match_reasoning"),
    )


def named_sites(crawl: DataFrame, matches: DataFrame | None, limit: int | None = None) -> DataFrame:
    """Unmatched sites with a name, normalised once: id, scraped_company_name, name."""
    sites = first_rows(unmatched(crawl.filter(F.col("scraped_company_name").isNotNull()), matches), limit)
    return sites.withColumn("name", normalize_name(F.col("scraped_company_name")))


def _counted_names(rows: DataFrame) -> DataFrame:
    """Distinct, non-empty names with their number of rows.

    The length comes out of the aggregate: a filter on the name itself would be moved below
    it and normalise every name a second time.
    """
    counted = rows.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.max(F.length("name")).alias("chars"))
    return counted.filter(F.col("chars") > 0).drop("chars")


def match_fuzzy(
    crawl: DataFrame,
    registry: DataFrame,
    matches: DataFrame | None = None,
    threshold: float = FUZZY_THRESHOLD,
    limit: int | None = None,
    blocking: str = "exact",
    measure: str = "ratio",
    group_rows: int = GROUP_ROWS,
    index: NameIndex | None = None,
) -> DataFrame:
    """Best active register row by name similarity for each unmatched named site.

    Ties go to the lowest abn. Both sides shrink to distinct normalised names;
    equal names are settled by an equi-join (nothing beats similarity 1), the
    rest by the similarity join; the answer goes back to the site rows at the end.
    ``blocking="first_letter"`` also asks for equal first letters, which loses pairs. With an ``index``,
    which must be fresh, ``registry`` is not read.
    """
    if blocking not in ("exact", "first_letter"):
        raise ValueError(f"unknown blocking {blocking!r}")
    rows = named_sites(crawl, matches, limit).select("id", "scraped_company_name", "name")
    counted = _counted_names(rows)
    # Both distinct-name tables feed several plans below, so each is written once.
    if index is None:
        entries = cut_lineage(active_names(registry).groupBy("name").agg(F.min(F.struct("abn", "entity_name")).alias("entry")))
        counted = cut_lineage(counted.join(entries, "name", "left"))
    else:
        counted = cut_lineage(counted)
        counted = cut_lineage(counted.join(index.entries(counted), "name", "left"))

    equal = counted.filter(F.col("entry").isNotNull()).select(
        "name", F.lit(1.0).alias("similarity"), F.col("entry")
    )
    scale, first_letter = Measure(measure, threshold), blocking == "first_letter"
    others = counted.filter(F.col("entry").isNull()).select("name")
    if index is None:
        candidates = candidate_pairs(others, entries.select("name"), scale, first_letter=first_letter, group_rows=group_rows)
    else:
        candidates = index.candidate_pairs(others, scale, first_letter)
    pairs = best_pairs(candidates, scale, 1)
    if index is not None:
        pairs = cut_lineage(pairs)
        entries = index.entries(pairs.select(F.col("register_name").alias("name")))
    ranked = F.struct((-F.col("similarity")).alias("worse"), F.col("entry"))
    near = (
        pairs.join(entries.withColumnRenamed("name", "register_name"), "register_name")
        .groupBy(F.col("site_name").alias("name"))
        .agg(F.min(ranked).alias("best"))
        .select("name", (-F.col("best.worse")).alias("similarity"), F.col("best.entry").alias("entry"))
    )
    best = equal.unionByName(near)
    found = spread_join(rows, best, "name", [F.col("id")], counts=counted.select("name", "rows"))
    return found.select(
        F.col("id").alias("cc_id"),
        F.col("entry.abn").alias("abn"),
        F.lit("fuzzy_name").alias("match_method"),
        fuzzy_confidence(F.col("similarity"), threshold).alias("match_confidence"),
        fuzzy_reasoning(
            two_decimals(F.col("similarity")), F.col("scraped_company_name"), F.col("entry.entity_name")
        ).alias("match_reasoning"),
    )


def _first_entries(registry: DataFrame, k: int) -> DataFrame:
    """The k lowest numbers of each normalised name; more can never be among k candidates."""
    order = Window.partitionBy("name").orderBy("abn")
    return (
        active_names(registry)
        .select("name", "abn", "entity_name", "entity_type", "state", "full_address")
        .withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= k)
        .drop("_n")
    )


def top_candidates(
    crawl: DataFrame,
    registry: DataFrame,
    matches: DataFrame | None = None,
    k: int = TOP_CANDIDATES,
    floor: float = CANDIDATE_FLOOR,
    below: float | None = None,
    limit: int | None = None,
    rich_context: bool = False,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """The k most similar active register rows of each unmatched named site.

    Columns: id, name, rank, abn, entity_name, entity_type, state, full_address,
    similarity. Candidates have at least similarity ``floor`` (and less than
    ``below``, if given); ties go to the lowest abn.
    ``rich_context`` keeps only sites that carry a context snippet.
    """
    sites = named_sites(crawl, matches, limit)
    if rich_context:
        sites = sites.filter(F.col("html_content_snippet").isNotNull())
    sites = sites.select("id", "name")
    counted = cut_lineage(_counted_names(sites))
    entries = cut_lineage(_first_entries(registry, k))
    names = entries.select("name").distinct()
    measure = Measure("ratio", floor)
    pairs = top_pairs(counted.select("name"), names, measure, k, below, group_rows=group_rows)

    order = Window.partitionBy("name").orderBy(F.col("similarity").desc(), F.col("abn"))
    ranked = (
        pairs.join(entries.withColumnRenamed("name", "register_name"), "register_name")
        .withColumnRenamed("site_name", "name")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )
    listed = ranked.groupBy("name").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "rank", "abn", "entity_name", "entity_type", "state", "full_address", "similarity"
                )
            )
        ).alias("candidates")
    )
    return spread_join(sites, listed, "name", [F.col("id")], counts=counted)


def score_prompts(df: DataFrame, scorer: Callable[[str], str | None], retries: int = 2, store: str | None = None) -> DataFrame:
    """``id``, ``prompt`` and ``answer``: what ``scorer`` says to each different prompt (see ``answers.with_answers``).

    The scorer is the user's function (a call of a model, say); it runs in the
    tasks. A prompt whose calls all fail gets NULL.
    """
    return with_answers(df.select("id", "prompt"), scorer, store, retries)


def match_assisted(
    crawl: DataFrame,
    registry: DataFrame,
    matches: DataFrame | None = None,
    scorer: Callable[[str], str | None] | None = None,
    k: int = TOP_CANDIDATES,
    floor: float = CANDIDATE_FLOOR,
    below: float | None = None,
    min_confidence: float = prompts.MIN_CONFIDENCE,
    limit: int | None = None,
    rich_context: bool = False,
    answers: str | None = None,
) -> DataFrame:
    """Let a scorer choose among the candidates of each unmatched named site.

    Without a scorer a fixed rule answers (see ``prompts.offline_answer``), so that
    jobs run without network. An answer counts only if it names a candidate. ``answers`` is a folder
    that keeps the scorer's answers for later runs.
    """
    listed = top_candidates(
        crawl, registry, matches, k=k, floor=floor, below=below, limit=limit, rich_context=rich_context
    )
    sites = crawl.select(
        "id", "website_url", "scraped_company_name", "scraped_industry", "html_content_snippet"
    )
    asked = listed.join(sites, "id")
    if scorer is None:
        answered = asked.select("id", "candidates", prompts.offline_answer(F.col("candidates")).alias("answer"))
    else:
        asked = cut_lineage(prompts.with_match_prompt(asked).select("id", "candidates", "prompt"))
        answered = asked.select("id", "candidates").join(
            score_prompts(asked, scorer, store=answers).select("id", "answer"), "id"
        )
    return accepted_answers(answered, min_confidence)


def accepted_answers(answered: DataFrame, min_confidence: float = prompts.MIN_CONFIDENCE) -> DataFrame:
    """Matches from answers that parse, are confident enough and name a candidate."""
    parsed = answered.withColumn("said", prompts.parse_match_answer(F.col("answer"), min_confidence))
    known = F.array_contains(F.transform("candidates", lambda c: c["abn"]), F.col("said.matched_abn"))
    return parsed.filter(known).select(
        F.col("id").alias("cc_id"),
        F.col("said.matched_abn").alias("abn"),
        F.lit("llm").alias("match_method"),
        F.round("said.confidence", 2).cast(CONFIDENCE).alias("match_confidence"),
        assisted_reasoning(F.col("said.reasoning")).alias("match_reasoning"),
    )


def with_manual(matches: DataFrame, manual: DataFrame) -> DataFrame:
    """Manual pairs (cc_id, abn, match_reasoning) first; they replace other matches of the site."""
    ours = manual.select(
        "cc_id",
        "abn",
        F.lit("manual").alias("match_method"),
        F.lit("1.00").cast(CONFIDENCE).alias("match_confidence"),
        "match_reasoning",
    )
    others = matches.select(*MATCH_COLUMNS).join(
        manual.select("cc_id").filter(F.col("cc_id").isNotNull()), "cc_id", "left_anti"
    )
    return ours.unionByName(others)


def append_matches(matches: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """Matches plus new ones, which get the next ids in order of (cc_id, abn)."""
    highest = matches.agg(F.coalesce(F.max("match_id"), F.lit(0)).alias("top")).scalar()
    numbered = dense_ids(new.select(*MATCH_COLUMNS), [F.col("cc_id"), F.col("abn")], "match_id")
    stamped = numbered.withColumn("match_id", F.col("match_id") + highest).withColumn("created_at", now)
    return matches.select(*MATCHES.names).unionByName(stamped.select(*MATCHES.names))


def match_all(
    crawl: DataFrame,
    registry: DataFrame,
    strategy: str = "all",
    limits: dict[str, int] | None = None,
    scorer: Callable[[str], str | None] | None = None,
    matches: DataFrame | None = None,
    index: NameIndex | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Run the chosen tiers in order of confidence; each sees the matches before it.

    With an ``index`` of the register's names, which must be fresh, the name tier reads that.
    Returns (new matches, one row per tier with matched and candidates).
    """
    if strategy not in ("all", "direct", "fuzzy", "llm"):
        raise ValueError(f"unknown strategy {strategy!r}")
    limits = limits or {}
    spark = crawl.sparkSession
    found: DataFrame | None = None
    counts: list[DataFrame] = []

    def taken() -> DataFrame | None:
        both = [part.select("cc_id") for part in (matches, found) if part is not None]
        return both[0].unionByName(both[1]) if len(both) == 2 else (both[0] if both else None)

    for tier in ("direct", "fuzzy", "llm"):
        if strategy not in ("all", tier):
            continue
        limit = limits.get(tier)
        if tier == "direct":
            new = match_direct(crawl, registry, taken(), limit)
            tried = None
        else:
            tried = named_sites(crawl, taken(), limit).agg(F.count(F.lit(1)).alias("n")).scalar()
            if tier == "fuzzy":
                new = match_fuzzy(crawl, registry, taken(), limit=limit, index=index)
            else:
                new = match_assisted(crawl, registry, taken(), scorer=scorer, limit=limit)
        # Later tiers read these matches more than once; the name join is costly.
        new = cut_lineage(new)
        matched = F.count(F.lit(1)).alias("matched")
        counts.append(
            new.agg(matched).select(
                F.lit(tier).alias("strategy"),
                "matched",
                (F.col("matched") if tried is None else tried).alias("candidates"),
            )
        )
        found = new if found is None else found.unionByName(new)
    attempts = counts[0]
    for part in counts[1:]:
        attempts = attempts.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], MATCHES).select(*MATCH_COLUMNS)
    return found, attempts
