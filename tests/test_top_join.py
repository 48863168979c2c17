"""Top-k similarity join and the batched ratio against plain loops."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmweave.functions.matching_blocks import matched_characters, ratios
from firmweave.operators import top_join
from firmweave.operators.similarity_join import Measure


def plain_ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def text(rng: random.Random, size: int, letters: str) -> str:
    return "".join(rng.choice(letters) for _ in range(size))


@pytest.mark.parametrize("at_once", [1 << 21, 50])
def test_ratios_equal_the_definition(monkeypatch, at_once):
    from firmweave.functions import matching_blocks

    monkeypatch.setattr(matching_blocks, "AT_ONCE", at_once)
    rng = random.Random(at_once)
    left, right = ["", "", "A", "A", "\0\0", "A\0"], ["", "A", "", "A", "\0", "\0A"]
    for _ in range(3000 if at_once > 100 else 200):
        a = text(rng, rng.randint(0, 40), "ABCD ")
        b = list(a)
        for _ in range(rng.randint(0, 12)):
            b.insert(rng.randint(0, len(b)), rng.choice("ABCDE é😀"))
            if rng.random() < 0.5:
                b.pop(rng.randrange(len(b)))
        left.append(a)
        right.append("".join(b))
    for _ in range(150 if at_once > 100 else 10):  # long second texts, with frequent characters
        a = text(rng, rng.randint(150, 420), "ABCDEFGHIJ 0123456789" * 2 + "日本語テキスト" * 9)
        b = list(a)
        for _ in range(rng.randint(0, 120)):
            b[rng.randrange(len(b))] = rng.choice("ABCXYZ 日本")
        left += [a, text(rng, 230, "AB")]
        right += ["".join(b), text(rng, rng.randint(190, 300), "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + "A" * 20)]
    assert ratios(left, right).tolist() == [plain_ratio(a, b) for a, b in zip(left, right, strict=True)]
    assert matched_characters([], []).tolist() == []


def test_ratios_of_many_names():
    rng = random.Random(4)
    words = [text(rng, rng.randint(2, 8), "ABCDEFGHIJKLMNOPRST") for _ in range(60)]
    left = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(100_000)]
    right = [*left[1:], left[0]]
    assert np.array_equal(ratios(left, right), [plain_ratio(a, b) for a, b in zip(left, right, strict=True)])


@pytest.fixture(scope="module")
def names():
    rng = random.Random(7)
    words = ["RED", "ROD", "BLUE", "BOLT", "NORTH", "GEAR", "SMALL", "TRADING", "&", "4", "12", "25"]
    made = {" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(170)}
    made |= {text(rng, rng.randint(1, 9), "ABX") for _ in range(40)} | {"AAAAAAAA", "AAAAAAAB", "ZQ", "Q", "ÉTÉ", "東京"}
    register = sorted(made)
    sites = set(rng.sample(register, 30))
    for name in rng.sample(register, 90):
        letters = list(name)
        for _ in range(rng.randint(1, 3)):
            letters[rng.randrange(len(letters))] = rng.choice("ABXR ")
        sites.add("".join(letters).strip() or "R")
    return sorted(sites), register


@pytest.mark.parametrize("k, floor, below, group_rows, seeds", [(1, 0.75, None, 20_000, 48), (5, 0.6, None, 20_000, 2), (5, 0.6, 0.85, 7, 48), (3, 0.3, 0.9, 20_000, 48)])
def test_top_pairs_equal_sorted_loop(spark, names, monkeypatch, k, floor, below, group_rows, seeds):
    monkeypatch.setattr(top_join, "NAMES", seeds)
    sites, register = names
    left, right = (spark.createDataFrame([(n,) for n in side], "name string").repartition(4) for side in (sites, register))
    scored = spark.sparkContext.accumulator(0)
    found: dict = {}
    for r in top_join.top_pairs(left, right, Measure("ratio", floor), k, below, group_rows=group_rows, scored=scored).collect():
        found.setdefault(r.site_name, []).append((-r.similarity, r.register_name))
    assert scored.value > 0
    for site in sites:
        every = sorted((-v, n) for n in register if floor <= (v := plain_ratio(site, n)) and (below is None or v < below))
        got = sorted(found.get(site, []))
        assert got[:k] == every[:k]
        # Ties with the k-th best are there too.
        assert not every[k:] or {p for p in every if p[0] <= every[min(k, len(every)) - 1][0]} <= set(got)


def test_site_floors_never_pass_the_kth_best(spark, names):
    sites, register = names
    left, right = (spark.createDataFrame([(n,) for n in side], "name string") for side in (sites, register))
    lows = {r.name: r.low for r in top_join.site_floors(left, right, Measure("ratio", 0.6), 3).collect()}
    assert lows.keys() == set(sites) and max(lows.values()) > 0.6
    for site, low in lows.items():
        assert low == 0.6 or sorted((plain_ratio(site, n) for n in register), reverse=True)[2] >= low


def test_top_pairs_edit_measure_and_empty_sides(spark, names):
    sites, register = names
    left, right = (spark.createDataFrame([(n,) for n in side], "name string") for side in (sites, register))
    got = top_join.top_pairs(left, right, Measure("edit", 0.8), 1)
    from firmweave.operators.similarity_join import similar_pairs

    want = similar_pairs(left, right, Measure("edit", 0.8))
    best = lambda df: {r[0]: r[1] for r in df.groupBy("site_name").agg(F.max("similarity")).collect()}
    assert best(got) == best(want) != {}
    assert top_join.top_pairs(left.limit(0), right, Measure("ratio", 0.6), 2).count() == 0
    assert top_join.top_pairs(left, right.limit(0), Measure("ratio", 0.6), 2).count() == 0


def test_seeds_below_a_bound_raise_the_floors(spark):
    # 30 names too alike to be used, which alone were seeds before, and 10 that are usable.
    site = "ACME STEEL HARBOUR NORTH"
    alike = [f"{site} {c}" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ1234"]
    usable = [f"{site} {c}QZ PLUMBING GROUP" for c in "ABCDEFGHIJ"]
    left, right = (spark.createDataFrame([(n,) for n in side], "name string") for side in ([site], alike + usable))
    low = top_join.site_floors(left, right, Measure("ratio", 0.6), 5, below=0.85).first().low
    values = sorted((v for n in alike + usable if (v := plain_ratio(site, n)) < 0.85), reverse=True)
    assert 0.6 < low <= values[4]


def test_names_of_the_same_characters_meet_once(spark, monkeypatch):
    from firmweave.operators import similarity_join

    digits = [f"{i:04d}" for i in range(0, 10_000, 37)]
    sites = sorted({f"SITE {''.join(sorted(d))} RED" for d in digits} | {f"SITE {d} RED" for d in digits})
    register = ["SITE 1234 RED", "RED SITE 0042", "BLUE", "É 東京 SITE", "AAB", "BAA"]
    sites += ["BAA", "É 東京", "ABA"]
    rows = []
    plain = similarity_join.bag_rows

    def counted(bags, measure, order):
        rows.append(bags.count())
        return plain(bags, measure, order)

    monkeypatch.setattr(similarity_join, "bag_rows", counted)
    left, right = (spark.createDataFrame([(n,) for n in side], "name string") for side in (sites, register))
    got = {(r[0], r[1]): r[2] for r in similarity_join.similar_pairs(left, right, Measure("ratio", 0.6)).collect()}
    want = {(s, r): v for s in sites for r in register if (v := plain_ratio(s, r)) >= 0.6}
    assert got == want
    assert rows == [len({"".join(sorted(n)) for n in sites}), len({"".join(sorted(n)) for n in register})]
    assert rows[0] < len(sites) and rows[1] < len(register)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("few", [100_000, 0])
def test_seeds_send_only_counted_tokens_to_every_task(spark, monkeypatch, few):
    """Sites ask at many places each, so neither they nor the register names may be broadcast, however small their files are."""
    sites = spark.createDataFrame([(f"{a} stone {b}",) for a in ("grey", "red") for b in ("works", "yard")], "name string")
    register = spark.createDataFrame([("grey stone work",), ("red stone yards",), ("blue lamp",)], "name string")
    measure = Measure("ratio", 0.6)
    expected = sorted(map(tuple, top_join.seed_pairs(sites, register, measure, 1).collect()))
    monkeypatch.setattr(top_join, "FEW_ROWS", few)
    pairs = top_join.seed_pairs(sites, register, measure, 1)
    plan = plan_of(pairs)
    assert plan.count("BroadcastExchange") == (1 if few else 0), plan
    assert "SortMergeJoin" in plan
    assert sorted(map(tuple, pairs.collect())) == expected and expected
