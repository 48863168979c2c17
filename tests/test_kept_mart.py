"""The kept company table equals the full build but for ids, and ids of rows that stay are kept."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from firmweave.plans import kept_mart, models
from firmweave.plans.kept_mart import KeptMart
from firmweave.schemas import COMPANIES, CRAWL, MATCHES, REGISTRY
from firmweave.sources import tables

CONTENT = [c for c in COMPANIES.names if c not in ("company_id", "updated_at")]


def shaped(spark, rows, columns, schema):
    frame = spark.createDataFrame(rows, columns)
    frame = frame.select(*[F.col(f.name).cast(f.dataType) if f.name in frame.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    stamp = {c: F.lit("2024-05-06 07:08:09").cast("timestamp") for c in ("loaded_at", "created_at") if c in schema.names}
    return frame.withColumns(stamp)


def register(spark, rows):
    return shaped(spark, rows, "abn string, entity_name string, entity_status string", REGISTRY)


def sites(spark, rows):
    return shaped(spark, rows, "id long, website_url string, scraped_company_name string, scraped_abn string", CRAWL)


def links(spark, rows):
    return shaped(spark, rows, "match_id long, cc_id long, abn string, match_confidence double", MATCHES)


def replaced(key, fresh):
    return lambda current, _: current.join(fresh.select(key), key, "left_anti").select(*fresh.columns).unionByName(fresh)


def check(spark, root, mart, active_only):
    got = mart.refresh(F.current_timestamp()).collect()
    sources = [tables.read_table(spark, root, n) for n in ("registry", "crawl", "matches")]
    want = models.companies_unnumbered(*sources, active_only).select(*CONTENT).collect()
    assert sorted((str([r[c] for c in CONTENT]) for r in got)) == sorted(str(list(r)) for r in want)
    ids = [r.company_id for r in got]
    assert len(set(ids)) == len(ids)
    return {(r.data_source, r.website_url, None if r.data_source == "CC" else r.abn): r for r in got}


@pytest.mark.parametrize("active_only", [False, True])
def test_kept_mart_follows_its_sources(spark, tmp_path, active_only):
    root, rnd = str(tmp_path), random.Random(3)
    tables.write_table(register(spark, [(f"{i}", f"Firm {i}", "Active" if i % 4 else "Cancelled") for i in range(1, 31)]), root, "registry")
    tables.write_table(sites(spark, [(i, f"u{i}", f"Site {i}" if i % 5 else None, None) for i in range(1, 41)]), root, "crawl")
    first = [(i, i, "7" if i % 3 == 0 else f"{i}", 0.9) for i in range(1, 21)]  # a third stand behind one number
    tables.write_table(links(spark, [*first, (50, 2, "9", 0.7), (51, None, "3", 0.7), (52, 5, None, 0.7)]), root, "matches")
    mart = KeptMart(spark, root, active_only, buckets=8)
    before = check(spark, root, mart, active_only)
    assert sorted(r.company_id for r in before.values()) == list(range(1, len(before) + 1))
    version = mart.table.versions.numbers()
    check(spark, root, mart, active_only)
    assert mart.table.versions.numbers() == version  # nothing changed, nothing written

    # One register row changes: its rows change, all others keep id and time stamp, and other buckets their files.
    files = mart.table.versions.load()["files"]
    fresh = register(spark, [("25", "Firm New", "Active")])
    tables.upsert_table(spark, root, "registry", fresh, replaced("abn", fresh))
    after = check(spark, root, mart, active_only)
    moved = {k for k in before if before[k] != after.get(k)}
    assert moved == {("ABR", None, "25")} and after["ABR", None, "25"].company_id == before["ABR", None, "25"].company_id
    now = mart.table.versions.load()["files"]
    assert sum(now[b] != files[b] for b in now) == 1

    # New and changed sites, cancelled and revived firms, new links (the mart sees all at once).
    fresh = register(spark, [("7", "Firm 7", "Cancelled"), ("8", "Firm 8", "Active"), ("99", "Late", "Active"), ("2", None, "Active")])
    tables.upsert_table(spark, root, "registry", fresh, replaced("abn", fresh))
    changed = sites(spark, [(i, f"u{i}", rnd.choice([None, "Renamed"]), rnd.choice([None, "8"])) for i in (3, 5, 12, 33, 41, 42)])
    tables.upsert_table(spark, root, "crawl", changed, replaced("website_url", changed))
    tables.append_table(spark, root, links(spark, [(0, 41, "7", 0.8), (0, 30, "99", 0.8), (0, 31, "24", 0.8)]).select(*MATCHES.names[1:-1]), F.lit("2024-05-06 07:08:09").cast("timestamp"))
    last = check(spark, root, mart, active_only)
    assert {k: r.company_id for k, r in after.items() if k in last} == {k: last[k].company_id for k in after if k in last}
    new = [r.company_id for k, r in last.items() if k not in after]
    assert new and min(new) > max(r.company_id for r in after.values())

    # Links replaced as a whole, by hand: some are gone. Then old files are gone too: a full build, same ids.
    kept = tables.read_table(spark, root, "matches").where("cc_id % 4 <> 0")
    tables.write_table(kept, root, "matches")
    third = check(spark, root, mart, active_only)
    fresh = register(spark, [("1", "Firm One", "Active")])
    tables.upsert_table(spark, root, "registry", fresh, replaced("abn", fresh))
    tables.expire_table(spark, root, "registry", keep=1)
    mart.expire()
    fourth = check(spark, root, mart, active_only)
    assert {k: r.company_id for k, r in third.items()} == {k: r.company_id for k, r in fourth.items()}


def test_changed_keys_come_once(spark, tmp_path):
    root = str(tmp_path)
    tables.write_table(register(spark, [("1", "A", "Active"), ("2", "B", "Active"), ("2", "B", "Active"), (None, "N", "Active"), ("3", "C", None)]), root, "registry")
    old = tables.stored(spark, root, "registry").versions.load()["files"]
    tables.write_table(register(spark, [("1", "A", "Active"), ("2", "B", "Active"), (None, "M", "Active"), ("3", "C", None), ("4", "D", "Active"), ("4", "E", "Active")]), root, "registry")
    new = tables.stored(spark, root, "registry").versions.load()["files"]
    # A row that is there less often, a row without number and a new number; row 3, with a NULL in it, is the same.
    assert sorted((tuple(r) for r in kept_mart._changed(spark, root, "registry", old, new).collect()), key=str) == [("2",), ("4",), (None,)]


def test_rows_of_one_identity_keep_ids_in_order(spark):
    def row(source, url, abn, confidence, name):
        return {"data_source": source, "website_url": url, "abn": abn, "match_confidence": confidence, "company_name": name}

    rows = [row("BOTH", "u1", "1", 0.7, "A"), row("BOTH", "u1", "1", 0.9, "B"), row("CC", "u2", "5", None, "C"), row("ABR", None, "7", None, "D"), row("ABR", None, "7", None, "E")]
    schema = "data_source string, website_url string, abn string, match_confidence double, company_name string"

    def frame(rows):
        made = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
        return made.select(*[F.col(f.name).cast(f.dataType) if f.name in made.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in COMPANIES])

    then = F.lit("2025-01-01").cast("timestamp")
    old = frame([rows[0], rows[1], rows[2] | {"abn": "4"}, rows[3]])
    ids = F.when(F.col("website_url") == "u2", 3).when(F.col("abn") == "7", 4).when(F.col("company_name") == "A", 1).otherwise(2).cast("bigint")
    old = old.withColumn("company_id", ids).withColumn("updated_at", then)
    got = KeptMart._numbered(frame(rows), old, 9, F.lit("2026-01-01").cast("timestamp")).collect()
    found = {r.company_name: (r.company_id, r.updated_at.year) for r in got}
    # The site whose number changed keeps its id with a new time stamp; of two rows of number 7 one goes on and one is new.
    assert found["A"] == (1, 2025) and found["B"] == (2, 2025) and found["C"] == (3, 2026)
    assert sorted([found["D"][0], found["E"][0]]) == [4, 10] and len(got) == 5
