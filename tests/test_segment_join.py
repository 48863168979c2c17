"""Names within an edit distance through shared segments, against a nested loop."""

from __future__ import annotations

import random

import pytest

from firmweave.operators import similarity_join
from firmweave.operators.segment_join import probe_rows, segment_rows
from firmweave.operators.similarity_join import Measure, candidate_pairs, similar_pairs


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def variants(seed: int, n: int, letters: str) -> list[str]:
    """Names of 1 to 45 characters, most of them edits of others."""
    rng = random.Random(seed)
    names = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 45))) for _ in range(n // 4)]
    while len(names) < n:
        name = list(rng.choice(names))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(name) + 1)
            kind = rng.randrange(3)
            if kind == 0:
                name.insert(at, rng.choice(letters))
            elif at < len(name) and len(name) > 1:
                name[at : at + 1] = [] if kind == 1 else [rng.choice(letters)]
        names.append("".join(name))
    return sorted(set(names))


def frame(spark, names):
    return spark.createDataFrame([(n,) for n in names], "name string")


@pytest.mark.parametrize("floor,letters,group_rows", [(0.7, "AB", 50), (0.8, "ABCDEF", 20_000), (0.85, "ABC 1É", 30), (0.9, "AB", 20_000)])
def test_segments_lose_nothing(spark, floor, letters, group_rows):
    names = variants(int(floor * 100), 160, letters)
    left, right = names[::2], sorted(names[1::2] + names[:20])
    got = similar_pairs(frame(spark, left), frame(spark, right), Measure("edit", floor), group_rows=group_rows).collect()
    want = {}
    for a in left:
        for b in right:
            value = 1 - distance(a, b) / max(len(a), len(b))
            if value >= floor - 1e-9:
                want[a, b] = value
    assert {(r.site_name, r.register_name): r.similarity for r in got} == pytest.approx(want)
    assert len(got) == len(want) > 10


def test_sites_keep_floors_of_their_own(spark):
    names = variants(5, 120, "ABC")
    left, right = names[::2], names[1::2]
    lows = {n: 0.75 + 0.05 * (i % 5) for i, n in enumerate(left)}
    sites = spark.createDataFrame(list(lows.items()), "name string, low double")
    got = {(r.site_name, r.register_name) for r in candidate_pairs(sites, frame(spark, right), Measure("edit", 0.75)).collect()}
    want = {(a, b) for a in left for b in right if 1 - distance(a, b) / max(len(a), len(b)) >= lows[a] - 1e-9}
    assert got == want


def test_segments_and_grams_agree(spark, monkeypatch):
    names = variants(9, 200, "ABCD ")
    left, right = [n for n in names[::2] if len(n) > 1], [n for n in names[1::2] if len(n) > 1]
    measure = Measure("edit", 0.85)

    def pairs():
        return sorted((r.site_name, r.register_name) for r in similar_pairs(frame(spark, left), frame(spark, right), measure).collect())

    by_segments = pairs()
    monkeypatch.setattr(similarity_join, "LEAST_FLOOR", 2.0)
    assert by_segments == pairs()


def test_rows_of_a_name(spark):
    """A name of ten at 0.8 is cut for two edits, and each of its own segments is among its places."""
    one = frame(spark, ["ABCDEFGHIJ"])
    cut = segment_rows(one, 0.8).collect()
    assert len(cut) == 3  # tau is 2 for lengths 10 to 12
    assert {r.token for r in cut} <= {r.token for r in probe_rows(one, 0.8).collect()}


def test_empty_sides(spark):
    some, none = frame(spark, ["ABCDEF"]), frame(spark, [])
    measure = Measure("edit", 0.85)
    assert similar_pairs(none, some, measure).count() == similar_pairs(some, none, measure).count() == 0


@pytest.mark.parametrize("few", [0, 1_000_000])
def test_places_without_a_segment_are_not_sent(spark, monkeypatch, few):
    names = [f"UNRELATED SITE {i}" for i in range(1000, 1400)] + ["LARGE RING BRAND7 SMALL", "LARGE RING BRAND17 SMAL"]
    register = ["LARGE RING BRAND7 SMALL", "HOT BOLT BRAND12 PROMO"]
    sent = []
    plain = similarity_join._salts

    def counted(rows, own, other, own_fan, other_fan):
        sent.append(rows.count())
        return plain(rows, own, other, own_fan, other_fan)

    monkeypatch.setattr(similarity_join, "_salts", counted)
    monkeypatch.setattr(similarity_join, "FEW_ROWS", few)
    got = {(r[0], r[1]) for r in similar_pairs(frame(spark, names), frame(spark, register), Measure("edit", 0.85)).collect()}
    assert got == {(s, "LARGE RING BRAND7 SMALL") for s in names[-2:]}
    asked = probe_rows(frame(spark, names), 0.85).count()
    assert sent[0] == asked if few == 0 else sent[0] < asked / 100
