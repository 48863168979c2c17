"""The word index against a scan, and what a search reads."""

from __future__ import annotations

import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmweave.operators import word_index


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["ring", "Ring", "bolt", "RED", "steel-works", "a1", "é", "x_y"] + [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 6))) + (" common" if i % 3 else "")) for i in range(3000)]
    return [*rows, (5000, None), (None, "ring"), (2**33, "ring bolt common")]


@pytest.mark.parametrize("block, folders", [(1 << 20, None), (64, 7)])
def test_search_equals_scan(spark, tmp_path, monkeypatch, texts, block, folders):
    monkeypatch.setattr(word_index, "BLOCK", block)
    df = spark.createDataFrame(texts, "id long, text string").repartition(5)
    n = word_index.build_index(df, str(tmp_path / "i"), "text", folders=folders)
    held = {i: set(re.split("[^a-z0-9]+", t.lower())) for i, t in texts if i is not None and t is not None}
    for asked in (["ring"], ["RING", "bolt"], ["common"], ["common", "ring", "red"], ["works", "steel"], ["nowhere"], ["ring", "nowhere"], ["y"], []):
        got = sorted(r.id for r in word_index.search(spark, str(tmp_path / "i"), asked, n).collect())
        assert got == sorted(i for i, w in held.items() if asked and {a.lower() for a in asked} <= w), asked


def test_hot_words_are_dealt_by_blocks(spark, tmp_path, monkeypatch, texts):
    monkeypatch.setattr(word_index, "BLOCK", 100)
    df = spark.createDataFrame(texts, "id long, text string")
    word_index.build_index(df, str(tmp_path / "i"), "text")
    index = spark.read.parquet(str(tmp_path / "i"))
    assert index.where("word = 'common'").agg(F.max("rows")).first()[0] <= 100


def folder_bytes(path: Path, word: str, folders: int, spark) -> int:
    at = spark.range(1).select(F.pmod(F.xxhash64(F.lit(word)), F.lit(folders))).first()[0]
    return sum(f.stat().st_size for f in (path / f"word_bucket={at}").glob("*.parquet"))


def test_what_a_word_reads_does_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(word_index, "FOLDER_ROWS", 4000)
    sizes = {}
    for n in (2000, 16_000):
        df = spark.range(n).select("id", F.concat_ws(" ", *[F.concat(F.lit("v"), F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n)).cast("string")) for k in range(4)]).alias("text"))
        df = df.withColumn("text", F.when(F.col("id") == 7, F.concat("text", F.lit(" needle"))).otherwise(F.col("text")))
        path = tmp_path / str(n)
        folders = word_index.build_index(df, str(path), "text")
        assert [r.id for r in word_index.search(spark, str(path), ["needle"], folders).collect()] == [7]
        sizes[n] = folder_bytes(path, "needle", folders, spark)
    assert sizes[16_000] < 1.5 * sizes[2000]


def test_intersection():
    rng = np.random.default_rng(1)
    lists = [np.unique(rng.integers(0, 300, size)) for size in (10, 400, 150)]
    assert word_index.intersect(lists).tolist() == sorted(set.intersection(*[set(x.tolist()) for x in lists]))
    assert len(word_index.intersect([lists[0], np.zeros(0, np.int64)])) == 0


def test_empty_table(spark, tmp_path):
    none = spark.createDataFrame([], "id long, text string")
    n = word_index.build_index(none, str(tmp_path / "i"), "text")
    assert word_index.search(spark, str(tmp_path / "i"), ["a"], n).count() == 0
