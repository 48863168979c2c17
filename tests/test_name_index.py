"""The kept name index: same matches as from scratch after every change, and no reads of what did not change."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from firmweave.operators import match, name_index, upsert
from firmweave.operators.name_index import NameIndex
from firmweave.operators.similarity_join import Measure
from firmweave.schemas import REGISTRY
from firmweave.sources import keyed
from firmweave.sources.keyed import KeyedTable
from tests.test_matching import CRAWL, random_names


def entries(spark, rows):
    frame = spark.createDataFrame(rows, "abn string, entity_name string, entity_status string")
    return frame.select(*[F.col(f.name) if f.name in frame.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in REGISTRY])


def load(table, fresh):
    now = F.lit("2020-01-01").cast("timestamp")
    return table.upsert(fresh, lambda current, _: upsert.merge_registry(current, fresh, now))


@pytest.fixture(scope="module")
def crawl(spark):
    sites = [(i, f"https://s{i}.com.au/", n if i % 11 else None, None, None, None) for i, n in enumerate(random_names(1, 120), 1)]
    return spark.createDataFrame(sites, CRAWL)


def both(crawl, registry, index, **how):
    scratch = match.match_fuzzy(crawl, registry, **how).collect()
    kept = match.match_fuzzy(crawl, registry.limit(0), index=index, **how).collect()
    assert sorted(kept, key=str) == sorted(scratch, key=str)
    return {r.cc_id: r.abn for r in kept}


@pytest.fixture
def reads(monkeypatch):
    seen: list[str] = []
    plain = keyed.read_files

    def read(spark, root, names, schema):
        names = list(names)
        seen.extend(f"{root}/{n}" for n in names)
        return plain(spark, root, names, schema)

    monkeypatch.setattr(keyed, "read_files", read)
    return seen


def test_index_follows_the_register(spark, tmp_path, crawl, reads):
    rnd = random.Random(5)
    names = random_names(1, 60) + random_names(2, 60)
    rows = [(f"{20000000000 + i}", n if i % 13 else None, "Active" if i % 5 else "Cancelled") for i, n in enumerate(names, 1)]
    rows.append(("30000000000", rows[0][1], "Active"))  # a second row of a name
    table = KeyedTable(spark, str(tmp_path / "registry"), REGISTRY, ["abn"], buckets=4)
    load(table, entries(spark, rows))
    index = NameIndex(spark, str(tmp_path / "index"), table, group_rows=25)
    assert index.refresh() == 4
    first = both(crawl, table.read(), index)
    assert len(first) > 20
    # Nothing new: the register is not read at all, and the index finds the same.
    reads.clear()
    assert index.refresh() == 0
    assert {r.cc_id: r.abn for r in match.match_fuzzy(crawl, spark.createDataFrame([], REGISTRY), index=index).collect()} == first
    assert reads and not any("/registry/" in r for r in reads)

    # Rows that answered go, others come back to life, change their spelling or are new; one bucket is read for one row.
    reads.clear()
    hit = sorted(set(first.values()))[0]
    load(table, entries(spark, [(hit, "Something Else", "Active")]))
    assert index.refresh() == 1
    assert both(crawl, table.read(), index) != first
    changed = []
    for abn, name, _ in rnd.sample(rows, 12):
        kind = rnd.randrange(4)
        changed.append((abn, [name, rnd.choice(names), None, (name or "x").upper()][kind], rnd.choice(["Active", "Active", "Cancelled"])))
    changed += [(f"1{i}", n, "Active") for i, n in enumerate(random_names(7, 5))]
    load(table, entries(spark, changed))
    index.refresh()
    both(crawl, table.read(), index)
    both(crawl, table.read(), index, threshold=0.92)

    # What the last state does not name may go.
    index.expire()
    both(crawl, table.read(), index, blocking="first_letter")
    with pytest.raises(ValueError):
        match.match_fuzzy(crawl, table.read(), threshold=0.5, index=index)
    with pytest.raises(ValueError):
        match.match_fuzzy(crawl, table.read(), measure="edit", index=index)


def test_refresh_that_fails_half_way(spark, tmp_path, crawl, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "registry"), REGISTRY, ["abn"], buckets=4)
    load(table, entries(spark, [(f"{i}", n, "Active") for i, n in enumerate(random_names(1, 40))]))
    index = NameIndex(spark, str(tmp_path / "index"), table)
    index.refresh()
    load(table, entries(spark, [("3", "Harbour Bakery", "Active"), ("77", "Acme Steel Group", "Active")]))

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(NameIndex, "_commit", fail)
        with pytest.raises(OSError):
            index.refresh()
    assert index.refresh() >= 1
    both(crawl, table.read(), index)


def test_index_of_little_and_of_much_more(spark, tmp_path, crawl, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "registry"), REGISTRY, ["abn"], buckets=4)
    index = NameIndex(spark, str(tmp_path / "index"), table, Measure("edit", 0.8))
    assert index.refresh() == 0  # no register yet
    assert match.match_fuzzy(crawl, table.read(), measure="edit", index=index).count() == 0
    load(table, entries(spark, [("1", "Pty Ltd", "Active"), ("2", None, "Active"), ("3", "Harbour", "Active")]))
    index.refresh()
    assert index.entries(spark.createDataFrame([("HARBOUR",), ("NONE",)], "name string")).count() == 1
    built = []
    plain = name_index.NameIndex._build
    monkeypatch.setattr(name_index.NameIndex, "_build", lambda self, *a: (built.append(1), plain(self, *a))[1])
    load(table, entries(spark, [(f"x{i}", n, "Active") for i, n in enumerate(random_names(1, 50))]))
    index.refresh()
    assert built == [1]  # three times as many names: a new order of the tokens
    both(crawl, table.read(), index, measure="edit")
    assert match.match_fuzzy(crawl.limit(0), table.read(), measure="edit", index=index).count() == 0
