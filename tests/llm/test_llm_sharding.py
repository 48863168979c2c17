"""Sharding: plain version, laws, weights, odd rows, files."""

from __future__ import annotations

import hashlib
import math
import sys
import zlib
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import plain  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.compare import duck  # noqa: E402
from firmweave.llm import queries, sharding  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain_shard(key, weights) -> int:
    digest = hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()
    a, b = int(digest[:8], 16), int(digest[8:16], 16)

    def draw(i):
        u = (sharding.stir((sharding.stir(a ^ sharding.shard_salt(i)) + b) % 2**32) + 0.5) / 2**32
        return -weights[i] / math.log(u)

    return max((i for i, w in enumerate(weights) if w > 0), key=lambda i: (draw(i), -i))


@pytest.fixture(scope="module")
def docs(spark):
    rows = plain.odd_documents() + [(500, "same")] * 400 + [(None, "nothing")] * 30
    schema = "doc_id long, text string, shard string, slot string, _a string, _tie int, _part int, _row int, _c0 string"
    return rows, spark.createDataFrame([(*r, "s", "t", "a", 1, 2, 3, "c") for r in rows], schema).repartition(5)


@pytest.mark.parametrize("weights", [[1.0] * 24, [1.0, 0.0, 2.5, 0.5], [3.0]])
def test_assignment_equals_plain(docs, weights):
    rows, df = docs
    out = sharding.assign_shards(df, weights)
    assert out.columns == [c for c in df.columns if c != "shard"] + ["shard"]
    want = Counter((i, t, plain_shard(i, weights)) for i, t in rows)
    assert Counter((r.doc_id, r.text, r.shard) for r in out.collect()) == want


def test_more_shards_take_rows_only_into_themselves(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    weights = [1.0, 2.0, 1.0, 4.0]
    before = sharding.assign_shards(df, weights)
    both = sharding.assign_shards(before, [*weights, 2.0], out="grown").collect()
    assert all(r.grown in (r.shard, 4) for r in both)
    moved = sum(r.grown == 4 for r in both) / len(both)
    assert abs(moved - 0.2) < 0.015
    sizes = Counter(r.shard for r in both)
    assert all(abs(sizes[i] / len(both) - w / 8) < 0.02 for i, w in enumerate(weights))
    # A raised weight takes, a shard that leaves gives; nobody else's rows move.
    raised = sharding.assign_shards(before, [1.0, 3.0, 1.0, 4.0], out="other").collect()
    assert all(r.other in (r.shard, 1) for r in raised)
    left = sharding.assign_shards(before, [1.0, 2.0, 0.0, 4.0], out="other").collect()
    assert all(r.shard == 2 or r.other == r.shard for r in left) and all(r.other != 2 for r in left)


def test_slots_have_no_gaps(docs):
    rows, df = docs
    out = sharding.number_slots(sharding.assign_shards(df, [1.0] * 3), ["doc_id", "text"])
    got = out.collect()
    assert len(got) == len(rows) and set(out.columns) == set(df.columns)
    for shard in range(3):
        mine = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        keys = [(r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()) for r in mine]
        assert keys == sorted(keys)
    assert all((r._a, r._tie, r._part, r._row, r._c0) == ("a", 1, 2, 3, "c") for r in got)


def test_keys_of_several_columns_are_told_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "x"), ("", "x")], "k string, l string")
    bits = sharding._key_bits([F.col("k"), F.col("l")])
    assert df.select(*[b.alias(n) for b, n in zip(bits, "ab", strict=True)]).distinct().count() == 4


def test_no_rows_and_no_weights(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.number_slots(sharding.assign_shards(empty, [1.0] * 24)).count() == 0
    with pytest.raises(ValueError):
        sharding.assign_shards(empty, [0.0])


def test_files_hold_whole_rows(docs, tmp_path, spark):
    rows, df = docs
    sharding.write_shards(df, str(tmp_path / "out"), [1.0] * 4, rows_per_file=100)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text, r.shard) for r in back.collect()) == Counter((i, t, plain_shard(i, [1.0] * 4)) for i, t in rows)
    assert len(list((tmp_path / "out" / f"shard={plain_shard(500, [1.0] * 4)}").glob("*.parquet"))) > 1


def test_query(spark):
    got = queries.QUERIES["op13_sharding"](spark, SF)
    rows = got.collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert (r.shard, r.grown_shard) == (plain_shard(r.doc_id, [1.0] * 24), plain_shard(r.doc_id, [1.0] * 25))
    cursor = duck(SF).execute(queries.ORACLES["op13_sharding"])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(got.columns)
    assert Counter(cursor.fetchall()) == Counter(tuple(r[n] for n in names) for r in rows)
