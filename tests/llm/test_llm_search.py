"""Lexical search: every pair scored in plain Python; layouts, odd rows, blocks of items."""

from __future__ import annotations

import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import plain  # noqa: E402

from checks.compare import duck  # noqa: E402
from firmweave.llm import lexical_search as lexical  # noqa: E402
from firmweave.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(plain.LOWER))


def plain_search(docs, items, k=50):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    n, total = len(counted), sum(s for _, _, s in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked: dict = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        found = []
        for i, c, size in counted:
            m = 50 + 50 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        found.sort(key=lambda f: f[:3])
        out += [(item, rank, f[3], -f[0]) for rank, f in enumerate(found[:k], 1)]
    return Counter(out)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    rows = plain.odd_documents() + [(1000 + i, " ".join(rng.choice(["the", "An", "on", "x9", "rare%d" % rng.randrange(30)]) for _ in range(12))) for i in range(150)]
    rows += [(2000 + i, "the an on") for i in range(120)]
    schema = "doc_id long, text string, m string, block string, terms string, item string"
    return rows, spark.createDataFrame([(*r, "m", "b", "t", "i") for r in rows], schema).repartition(6)


ITEMS = [(1, "the AN rare1 rare2"), (2, "日 ß x9"), (3, None), (4, ""), (5, "?!"), (6, "nowhere"), (None, "on of tion"), (7, "rare3 the"), (7, "rare4"), (8, "the an on in of x9 re tion")]


@pytest.mark.parametrize("k, stratum, pilot, at_once, item_bytes", [(50, 4096, 16, 1 << 20, 4 << 20), (3, 7, 1, 40, 4 << 20), (10, 20, 2, 1 << 20, 60)])
def test_search_equals_plain(spark, docs, monkeypatch, k, stratum, pilot, at_once, item_bytes):
    for name, value in (("STRATUM_DOCS", stratum), ("PILOT", pilot), ("_AT_ONCE", at_once), ("ITEM_BYTES", item_bytes)):
        monkeypatch.setattr(lexical, name, value)
    rows, df = docs
    items = spark.createDataFrame([(*i, 5, "e") for i in ITEMS], "item_id long, text string, doc_id int, score string")
    out = lexical.search(df, items, k)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(tuple(r) for r in out.collect()) == plain_search(rows, ITEMS, k)


def test_long_texts_in_slices(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["aa", "b", "cé", "--", "d9\n"]) for _ in range(900)), "aa" * 500, None, "", "b"]
    vocabulary = {w.encode(): i for i, w in enumerate(["aa", "cé", "d9", "zz"])}
    whole = lexical.count_terms(texts, vocabulary)
    monkeypatch.setattr(lexical, "SLICE", 64)
    assert all(np.array_equal(a, b) for a, b in zip(whole, lexical.count_terms(texts, vocabulary), strict=True))
    n, text, term, count = whole
    assert n.tolist() == [len(terms(t)) for t in texts]
    names = list(vocabulary)
    assert {(int(i), names[j].decode()): int(c) for i, j, c in zip(text, term, count, strict=True)} == {
        (i, w): c for i, t in enumerate(texts) for w, c in Counter(terms(t)).items() if w.encode() in vocabulary
    }


def test_bounds_are_never_exceeded_and_prune():
    rng = np.random.default_rng(3)
    items = lexical.Items([(0, ["a", "b", "c"]), (1, ["c", "d"])])
    weight = np.array([500, -300, 2000, 40])
    scorer = lexical.Scorer(items, weight, 5, np.zeros(2, np.int64))
    for m in (50, 77, 400):
        tf = rng.integers(0, 6, (30, 4))
        top = tf.max(axis=0)
        held = np.flatnonzero(top)
        bounds = scorer.bounds(m, lexical._small(held), lexical._small(top[held]))
        value = np.where(tf > 0, lexical.impacts(np.maximum(tf, 1), m), 0) * weight
        scores = np.stack([value[:, :3].sum(axis=1), value[:, 2:].sum(axis=1)])
        assert (scores.max(axis=1) <= bounds).all()


def test_nothing_to_search(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([("q", "the")], "item_id string, text string")
    assert lexical.search(none, items).count() == 0
    some = spark.createDataFrame([(1, "the"), (2, None)], "doc_id long, text string")
    assert lexical.search(some, items.limit(0)).count() == 0
    assert lexical.search(some, items).schema.simpleString() == "struct<item_id:string,rank:int,doc_id:bigint,score:bigint>"


def test_query(spark):
    got = queries.QUERIES["op11_lexical_search"](spark, SF)
    rows = Counter(tuple(r) for r in got.collect())
    texts, items = ([tuple(r) for r in spark.read.parquet(f"{SF}/{t}.parquet").select(i, "text").collect()] for t, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert rows == plain_search(texts, items)
    cursor = duck(SF).execute(queries.ORACLES["op11_lexical_search"])
    assert [d[0] for d in cursor.description] == got.columns and Counter(cursor.fetchall()) == rows
