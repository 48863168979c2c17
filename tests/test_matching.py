"""Matching tiers against brute force on small fixtures."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from firmweave.functions import prompts
from firmweave.operators import match, quality
from firmweave.operators.similarity_join import Measure, similar_pairs
from tests.test_scalars import plain_normalize

CRAWL = (
    "id long, website_url string, scraped_company_name string, scraped_industry string, scraped_abn string, "
    "html_content_snippet string"
)
REGISTRY = "abn string, entity_name string, entity_type string, entity_status string, state string, full_address string"


def random_names(seed: int, n: int) -> list[str]:
    rnd = random.Random(seed)
    words = "Acme Steel Harbour Bakery North Sydney Plumbing Group Trading 24 Green Fields Dental O'Brien Société".split()
    out = []
    for _ in range(n):
        name = list(" ".join(rnd.choices(words, k=rnd.randint(1, 4))))
        for _ in range(rnd.randint(0, 4)):
            at, kind = rnd.randrange(len(name) + 1), rnd.randint(0, 2)
            if kind == 0:
                name.insert(at, rnd.choice("abcde é"))
            elif at < len(name) and len(name) > 1:
                if kind == 1:
                    name.pop(at)
                else:
                    name[at] = rnd.choice("xyz ")
        out.append("".join(name) + rnd.choice(["", " Pty Ltd", " LIMITED", " Inc."]))
    return out


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        nxt = [i]
        for j, y in enumerate(b, 1):
            nxt.append(min(row[j] + 1, nxt[-1] + 1, row[j - 1] + (x != y)))
        row = nxt
    return row[-1]


@pytest.fixture(scope="module")
def tables(spark):
    sites = [
        (i, f"https://s{i}.com.au/", name if i % 11 else None, None, None, "Title: x" if i % 3 else None)
        for i, name in enumerate(random_names(1, 150), 1)
    ]
    entries = [
        (f"{20000000000 + i}", name if i % 13 else None, "Company", "Active" if i % 5 else "Cancelled", "VIC", None)
        for i, name in enumerate(random_names(1, 90) + random_names(2, 110), 1)
    ]
    return spark.createDataFrame(sites, CRAWL), spark.createDataFrame(entries, REGISTRY), sites, entries


def ratio(site: str, entry: str) -> float:
    a, b = plain_normalize(site), plain_normalize(entry)
    return SequenceMatcher(None, a, b).ratio() if a and b else 0.0


def active(entries):
    return [e for e in entries if e[3] == "Active" and e[1] is not None]


@pytest.mark.parametrize(
    "name,floor,group_rows",
    [("ratio", 0.85, 100_000), ("ratio", 0.85, 20), ("ratio", 0.6, 20), ("edit", 0.85, 20), ("edit", 0.6, 100_000)],
)
def test_similar_pairs_lose_nothing(spark, name, floor, group_rows):
    left = sorted({plain_normalize(n) for n in random_names(3, 120)} - {""})
    right = sorted({plain_normalize(n) for n in random_names(4, 120) + random_names(3, 40)} - {""})
    as_df = lambda values: spark.createDataFrame([(v,) for v in values], "name string")
    rows = similar_pairs(as_df(left), as_df(right), Measure(name, floor), group_rows=group_rows).collect()
    got = {(r.site_name, r.register_name): r.similarity for r in rows}
    assert len(got) == len(rows)
    want = {}
    for a in left:
        for b in right:
            value = (
                SequenceMatcher(None, a, b).ratio() if name == "ratio" else 1 - edit_distance(a, b) / max(len(a), len(b))
            )
            # One-character names can only be equal, which the exact tier finds.
            if value >= floor and not (a == b and len(a) == 1):
                want[a, b] = value
    assert got == pytest.approx(want)


def test_match_fuzzy_equals_nested_loop(spark, tables):
    crawl, registry, sites, entries = tables
    got = {r.cc_id: r for r in match.match_fuzzy(crawl, registry).collect()}
    want = {}
    for site in sites:
        best, best_ratio = None, 0.0
        for entry in sorted(active(entries)):
            value = ratio(site[2], entry[1]) if site[2] else 0.0
            if value > best_ratio and value >= 0.85:
                best, best_ratio = entry, value
        if best:
            want[site[0]] = (best, best_ratio, site[2])
    assert got.keys() == want.keys() and len(want) > 30
    for cc_id, (entry, value, name) in want.items():
        row = got[cc_id]
        assert row.abn == entry[0]
        assert float(row.match_confidence) == round(min(0.75 + (value - 0.85) * 0.5, 0.95), 2)
        assert row.match_reasoning == (
            f"Fuzzy name match (similarity: {value:.2f}) between '{name}' and '{entry[1]}'"
        )


def test_first_letter_blocking_is_a_subset(spark, tables):
    crawl, registry, sites, entries = tables
    names = {s[0]: plain_normalize(s[2]) for s in sites if s[2]}
    register = {e[0]: plain_normalize(e[1]) for e in active(entries)}
    rows = match.match_fuzzy(crawl, registry, blocking="first_letter").collect()
    assert rows and all(names[r.cc_id][0] == register[r.abn][0] for r in rows)


@pytest.mark.parametrize("below", [None, 0.85])
def test_top_candidates_equal_sorted_loop(spark, tables, below):
    crawl, registry, sites, entries = tables
    listed = match.top_candidates(crawl, registry, below=below)
    got = {r.id: [(c.abn, c.similarity) for c in r.candidates] for r in listed.collect()}
    want = {}
    for site in sites:
        if not site[2]:
            continue
        scored = [(e[0], ratio(site[2], e[1])) for e in active(entries)]
        scored = [s for s in scored if s[1] >= 0.60 and (below is None or s[1] < below)]
        if scored:
            want[site[0]] = sorted(scored, key=lambda s: (-s[1], s[0]))[:5]
    assert got == want and len(want) > 50


def test_rich_context_gate(spark, tables):
    crawl, registry, sites, _ = tables
    ids = {r.id for r in match.top_candidates(crawl, registry, rich_context=True).collect()}
    assert ids and ids <= {s[0] for s in sites if s[5]}


def test_strategies_see_earlier_matches(spark, tables):
    crawl, registry, sites, entries = tables
    with_number = crawl.withColumn("scraped_abn", F.when(F.col("id") <= 20, F.lit("20000000005")))
    found, attempts = match.match_all(with_number, registry, limits={"fuzzy": 60, "llm": 30})
    rows = found.collect()
    assert len({r.cc_id for r in rows}) == len(rows)
    assert {r.cc_id for r in rows if r.match_method == "direct_abn"} == set(range(1, 21))
    tried = {r.strategy: (r.matched, r.candidates) for r in attempts.collect()}
    assert tried["direct"] == (20, 20)
    assert tried["fuzzy"][1] == 60 and tried["llm"][1] == 30
    only, _ = match.match_all(with_number, registry, strategy="direct")
    assert {r.match_method for r in only.collect()} == {"direct_abn"}


def test_assisted_match_takes_only_candidates(spark, tables):
    crawl, registry, *_ = tables
    calls = spark.sparkContext.accumulator(0)

    def scorer(prompt: str) -> str:
        calls.add(1)
        if "1. ABN: 2000000000" in prompt:
            raise ValueError("no answer")
        return '{"matched_abn": "99999999999", "confidence": 0.9, "reasoning": "invented"}'

    assert match.match_assisted(crawl, registry, scorer=scorer).count() == 0
    assert calls.value > 0

    def first(prompt: str) -> str:
        abn = prompt.split("1. ABN: ")[1].split("\n")[0]
        return '```json\n{"matched_abn": "%s", "confidence": 0.9, "reasoning": "first"}\n```' % abn

    rows = match.match_assisted(crawl, registry, scorer=first).collect()
    top = {r.id: r.candidates[0].abn for r in match.top_candidates(crawl, registry).collect()}
    assert {r.cc_id: r.abn for r in rows} == top
    assert {(r.match_method, str(r.match_confidence), r.match_reasoning) for r in rows} == {
        ("llm", "0.90", "LLM match: first")
    }


def test_match_prompt_text(spark):
    site = spark.createDataFrame(
        [("https://e.com.au", "Example Pty Ltd", None, "Title: Example",
          [("12345678901", "EXAMPLE PTY LTD", "Company", "VIC", "1 Collins St " * 20, 0.945),
           ("98765432109", "EXAMPLE TWO", None, None, None, 0.78)])],
        "website_url string, scraped_company_name string, scraped_industry string, html_content_snippet string, "
        "candidates array<struct<abn:string,entity_name:string,entity_type:string,state:string,full_address:string,"
        "similarity:double>>",
    )
    text = prompts.with_match_prompt(site).first().prompt
    assert "WEBSITE INFORMATION:\n- URL: https://e.com.au\n- Company Name (from website): Example Pty Ltd\n" in text
    assert "- Industry: N/A\n- Context: Title: Example\n\n\nCANDIDATES FROM AUSTRALIAN BUSINESS REGISTER:\n1. ABN: 12345678901\n" in text
    assert f"   Address: {'1 Collins St ' * 20}\n   Similarity Score: {0.945:.2f}\n2. ABN: 98765432109\n" in text
    assert "   Type: N/A\n   State: N/A\n   Address: N/A\n   Similarity Score: 0.78\n\n\nTASK:\n" in text
    assert text.endswith("JSON Response:")


def test_match_answers(one):
    answers = [
        '```json\n{"matched_abn": "123", "confidence": 0.9, "reasoning": "r"}\n```',
        'x {"matched_abn": 123, "confidence": "1.5"} y',
        '{"matched_abn": null, "confidence": 0.9}', '{"matched_abn": "no_match", "confidence": 0.9}',
        '{"matched_abn": "123", "confidence": 0.49}', '{"matched_abn": "123"}', "nothing", "", None,
        '{"matched_abn": " 123 ", "confidence": 0.5}',
    ]
    got = one(prompts.parse_match_answer, answers)
    assert [tuple(g) if g else None for g in got] == [
        ("123", 0.9, "r"), ("123", 1.0, "LLM determined match"), None, None, None, None, None, None, None,
        ("123", 0.5, "LLM determined match"),
    ]


def test_manual_matches_come_first(spark):
    old = spark.createDataFrame([(1, "a", "llm", 0.7, "x"), (2, "b", "llm", 0.7, "x")], "cc_id long, abn string, match_method string, match_confidence double, match_reasoning string")
    old = old.withColumn("match_confidence", F.col("match_confidence").cast("decimal(3,2)"))
    manual = spark.createDataFrame([(1, "c", "seen")], "cc_id long, abn string, match_reasoning string")
    rows = {(r.cc_id, r.abn, r.match_method, str(r.match_confidence)) for r in match.with_manual(old, manual).collect()}
    assert rows == {(1, "c", "manual", "1.00"), (2, "b", "llm", "0.70")}


def test_bad_matches_are_set_aside(spark, tables):
    crawl, registry, *_ = tables
    new = spark.createDataFrame(
        [(1, "20000000001", "llm", 0.7, "a"), (1, "20000000001", "llm", 0.9, "b"), (999, "20000000001", "llm", 0.7, "c"),
         (2, "nope", "llm", 0.7, "d"), (3, "20000000002", None, 0.7, "e"), (4, "20000000002", "llm", 1.5, "f"),
         (5, None, "llm", 0.7, "g")],
        "cc_id long, abn string, match_method string, match_confidence double, match_reasoning string",
    )
    good, bad = quality.split_valid_matches(new, crawl, registry)
    assert sorted(r.match_reasoning for r in good.collect()) == ["b", "g"]
    assert sorted(r.match_reasoning for r in bad.collect()) == ["c", "d", "e", "f"]


def test_inputs_and_matched_sites_are_joined_by_shuffle(spark, tmp_path):
    """Small files may hold more rows than the driver can send to every task, as at 6 GB."""
    from checks.fixtures import load

    parts = [(i, f"part {i}", "Brand#1", "SMALL") for i in range(40)]
    customers = [(i, i % 25, "FURNITURE") for i in range(30)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    registry, crawl, matches = (load(spark, str(tmp_path), name) for name in ("registry_fx", "crawl_fx", "matches_fx"))
    sites = match.named_sites(crawl, matches)
    given = spark.createDataFrame([(i + 1, f"part {i}") for i in range(9)], "id long, scraped_company_name string")
    taken = spark.createDataFrame([(1,), (None,), (4,)], "cc_id long")
    left = match.unmatched(given, taken)
    for df in (registry, matches, sites, left):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan, plan
    assert registry.count() == 30
    wanted = [i for i in range(30) if i % 3 == 0 or 2 <= (i + 1) % 10 <= 6]
    assert sorted(r.cc_id - 1 for r in matches.select("cc_id").collect()) == wanted
    assert sorted(r.id - 1 for r in sites.select("id").collect()) == [i for i in range(40) if i % 10 and i not in wanted]
    assert sorted(r.id for r in left.collect()) == [2, 3, 5, 6, 7, 8, 9]
