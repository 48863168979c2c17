"""Keyed tables and the match log: what a load reads and writes, versions, expiry."""

from __future__ import annotations

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.sources import keyed, tables

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType()), T.StructField("v", T.StringType())])


def digests(path: Path) -> dict[str, str]:
    return {str(f.relative_to(path)): hashlib.sha256(f.read_bytes()).hexdigest() for f in path.rglob("*.parquet")}


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def merged(fresh):
    """New rows replace old ones of their key; those without number get the next ones."""

    def merge(current, highest):
        numbers = {r.k: i for i, r in enumerate(fresh.select("k").orderBy("k").collect(), highest + 1)}
        named = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
        old = current.select("k", F.col("n").alias("o"))
        new = fresh.join(old, "k", "left").select("k", F.coalesce("o", F.element_at(named, F.col("k"))).alias("n"), "v")
        return current.join(fresh.select("k"), "k", "left_anti").unionByName(new)

    return merge


def test_upsert_touches_only_its_buckets(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], counter="n", buckets=16)
    assert table.read().count() == 0
    first = frame(spark, [(f"k{i}", None, "a") for i in range(400)])
    table.upsert(first, merged(first))
    before = digests(tmp_path / "t")
    assert len(before) == 16
    one = frame(spark, [("k7", None, "b")])
    table.upsert(one, merged(one))
    after = digests(tmp_path / "t")
    # All files are as they were, and one bucket has a new one.
    assert before.items() <= after.items() and len(after) == 17
    manifests = [table.versions.load(n) for n in table.versions.numbers()]
    assert sum(a != b for a, b in zip(manifests[0]["files"].values(), (manifests[1]["files"][b] for b in manifests[0]["files"]), strict=True)) == 1
    rows = {r.k: (r.n, r.v) for r in table.read().collect()}
    assert len(rows) == 400 and rows["k7"][1] == "b" and sorted(n for n, _ in rows.values()) == list(range(1, 401))
    more = frame(spark, [("new", None, "c"), ("k9", None, "c")])
    rows = {r.k: (r.n, r.v) for r in table.upsert(more, merged(more)).collect()}
    assert rows["new"][0] > 400 and rows["k9"][1] == "c" and len(rows) == 401
    # Old versions read as they were until they expire.
    assert table.read(1).where("v = 'a'").count() == 400
    table.expire(keep=1)
    assert table.versions.numbers() == [3] and table.read().count() == 401
    # Files nobody names may lie in a folder with named ones; whole folders go.
    folders = {f.split("/")[0] for group in table.versions.load()["files"].values() for f in group}
    assert {p.name for p in (tmp_path / "t" / "data").iterdir()} == folders


def test_upsert_of_nothing_and_of_foreign_keys(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], buckets=8)
    none = frame(spark, [])
    assert table.upsert(none, lambda current, _: current).count() == 0 and table.versions.numbers() == []
    one = frame(spark, [("a", 1, "x")])
    with pytest.raises(ValueError):
        table.upsert(one, lambda current, _: frame(spark, [(f"k{i}", 1, "x") for i in range(50)]))
    assert table.read().count() == 0  # a load that fails is no version
    assert table.replace(one).count() == 1
    assert table.replace(table.read().unionByName(frame(spark, [("b", 2, None), (None, 3, "n")]))).count() == 3


def test_two_loads_of_one_version(spark, tmp_path):
    table = keyed.KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"])
    table.replace(frame(spark, [("a", 1, "x")]))
    manifest = table.versions.load()
    with pytest.raises(RuntimeError):
        table.versions.commit(manifest)


def test_filters():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    packed = keyed.make_filter(hashes)
    assert keyed.may_hold(packed, hashes).all()
    assert keyed.may_hold(packed, rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).mean() < 0.03
    assert not keyed.may_hold(keyed.make_filter(hashes[:0]), hashes).any()


LOG = T.StructType([T.StructField("match_id", T.LongType()), T.StructField("cc_id", T.LongType()), T.StructField("abn", T.StringType()), T.StructField("at", T.StringType())])


def test_log_appends_only_new_pairs(spark, tmp_path, monkeypatch):
    log = keyed.PairLog(spark, str(tmp_path / "m"), LOG, ["cc_id", "abn"], "match_id", buckets=8)
    rng = random.Random(2)
    known: dict = {}
    nulls = 0
    read = []
    plain_read = keyed.read_files
    monkeypatch.setattr(keyed, "read_files", lambda spark, root, names, schema: (read.append(list(names)), plain_read(spark, root, read[-1], schema))[1])
    for turn in range(4):
        pairs = {(rng.randrange(60), f"{rng.randrange(8)}") for _ in range(40)}
        new = spark.createDataFrame([*pairs, (None, "1"), (5, None)], "cc_id long, abn string")
        before = digests(tmp_path / "m")
        out = log.append(new, ["cc_id", "abn"], {"at": F.lit(f"t{turn}")})
        assert before.items() <= digests(tmp_path / "m").items()  # nothing is rewritten
        for p in sorted(pairs - known.keys()):
            known[p] = f"t{turn}"
        nulls += 2
        rows = out.collect()
        assert {(r.cc_id, r.abn): r["at"] for r in rows if r.cc_id is not None and r.abn is not None} == known
        assert len(rows) == len(known) + nulls and sorted(r.match_id for r in rows) == list(range(1, len(rows) + 1))
    version = log.versions.numbers()[-1]
    # Far pairs: filters tell that no bucket has to be read.
    read.clear()
    far = spark.createDataFrame([(10**9 + 1, "zz")], "cc_id long, abn string")
    assert log.unseen(far).count() == 1 and sum(map(len, read)) <= 1
    # Pairs that are all there add nothing.
    log.append(spark.createDataFrame(list(known)[:5], "cc_id long, abn string"), ["cc_id", "abn"], {"at": F.lit("x")})
    assert log.versions.numbers()[-1] == version
    rows = {tuple(r) for r in log.read().collect()}
    assert {tuple(r) for r in log.compact().collect()} == rows
    assert len(log.versions.load()["filters"]) == 1
    log.expire(1)
    assert {tuple(r) for r in log.read().collect()} == rows
    assert log.unseen(spark.createDataFrame(list(known), "cc_id long, abn string")).count() == 0


def test_filters_are_made_by_several_tasks(spark, tmp_path):
    log = keyed.PairLog(spark, str(tmp_path / "m"), LOG, ["cc_id", "abn"], "match_id", buckets=8)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        log.replace(spark.range(40).selectExpr("id AS match_id", "id AS cc_id", "'1' AS abn", "'' AS at"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    folder = log.versions.load()["filters"][0]
    assert len(list((tmp_path / "m" / "data" / folder).glob("*.parquet"))) > 1
    assert log.unseen(spark.createDataFrame([(i, "1") for i in range(39, 42)], "cc_id long, abn string")).count() == 2


def test_tables_of_the_job(spark, tmp_path):
    root = str(tmp_path)
    crawl = spark.createDataFrame([(i, f"u{i}") for i in range(1, 30)], "id long, website_url string")
    full = crawl.select(*[F.col(c) if c in crawl.columns else F.lit(None).cast(tables.TABLES["crawl"][c].dataType).alias(c) for c in tables.TABLES["crawl"].names])
    tables.write_table(full, root, "crawl")
    before = digests(tmp_path)
    from firmweave.operators import upsert

    incoming = full.where("id = 3").withColumn("scraped_company_name", F.lit("new")).unionByName(full.where("id = 4").withColumn("website_url", F.lit("other")))
    fresh = upsert.latest_crawl(incoming, F.lit(1))
    now = F.current_timestamp()
    out = tables.upsert_table(spark, root, "crawl", fresh, lambda current, highest: upsert.merge_crawl(current, fresh, now, F.lit(highest)))
    rows = {r.website_url: (r.id, r.scraped_company_name) for r in out.collect()}
    assert rows["u3"] == (3, "new") and rows["other"] == (30, None) and len(rows) == 30
    after = digests(tmp_path)
    assert before.items() <= after.items() and len(after) - len(before) <= 2
    tables.expire_table(spark, root, "crawl", keep=1)
    assert tables.read_table(spark, root, "crawl").count() == 30
    assert spark.sql("SELECT count(*) FROM crawl").first()[0] == 30
