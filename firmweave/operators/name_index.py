"""The register's names as a kept index, so that matching new sites reads no register.

Four parts, in buckets, of which a refresh rewrites those that a change falls in:

* ``names``: number, normalised name and spelling of each active row, in the register's own buckets.
* ``entries``: the row that answers for each normalised name (lowest number).
* ``postings``: the prefix rows of the name join (see ``similarity_join``): token, rank, position, length, character counts. Frequent
  tokens are dealt among several parts by a hash of the name.
* ``state``: which files of the register each bucket was read from, which versions of the parts belong together, and the order of
  the tokens. It is written last, so a refresh that fails leaves the index as it was, and the next one starts from there.

The order of tokens is that of the register when the index was built. Any fixed order loses no pair; it only gets less apt as the register
grows, so the index is built anew once the register holds GROWN times the names. At a floor, the prefix of a name covers that of any higher floor:
one index serves all floors from its own on.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.functions.names import normalize_name
from firmweave.operators.similarity_join import (
    BUCKETS,
    GROUP_ROWS,
    Measure,
    bucket_value,
    fan_out,
    meeting_pairs,
    name_tokens,
    prefix_rows,
    token_counts,
)
from firmweave.session import cut_lineage
from firmweave.sources.keyed import KeyedTable, Versions

GROWN = 2.0
# Rows of a bucket of postings and of entries when the index is built.
BUCKET_ROWS = 1 << 20
LEAST_BUCKETS = 8

_NAMES = T.StructType([T.StructField(c, T.StringType()) for c in ("abn", "name", "entity_name")])
_ENTRIES = T.StructType([T.StructField(c, T.StringType()) for c in ("name", "abn", "entity_name")])


def active_names(registry: DataFrame) -> DataFrame:
    """Active register rows with a name, plus the normalised ``name`` (empty if nothing is left)."""
    active = registry.filter((F.col("entity_status") == "Active") & F.col("entity_name").isNotNull())
    return active.withColumn("name", normalize_name(F.col("entity_name")))


@dataclass
class NameIndex:
    """Index under ``path`` of a register that is a keyed table, for a similarity ``measure`` at its floor or above."""

    spark: SparkSession
    path: str
    register: KeyedTable
    measure: Measure = Measure("ratio", 0.85)
    group_rows: int = GROUP_ROWS

    def __post_init__(self):
        self.states = Versions(self.spark, f"{self.path}/state")
        self.q = self.measure.token_size()
        empty = self.spark.createDataFrame([], "name string")
        held = [f for f in prefix_rows(empty, self.q, self.measure, [0] * BUCKETS).schema if f.name not in ("low", "part")]
        self._postings_schema = T.StructType([T.StructField("deal", T.IntegerType()), *held])

    def _tables(self, state: dict) -> tuple[KeyedTable, KeyedTable, KeyedTable]:
        sizes = state["buckets"]
        return (
            KeyedTable(self.spark, f"{self.path}/names", _NAMES, ["abn"], buckets=sizes["names"]),
            KeyedTable(self.spark, f"{self.path}/entries", _ENTRIES, ["name"], buckets=sizes["entries"]),
            KeyedTable(self.spark, f"{self.path}/postings", self._postings_schema, ["token", "deal"], buckets=sizes["postings"]),
        )

    def _state(self) -> dict | None:
        state = self.states.load()
        return state["index"] if state else None

    def refresh(self) -> int:
        """Bring the index up to the register's last version; returns how many buckets of the register were read."""
        manifest = self.register.versions.load() or {"buckets": self.register.buckets, "files": {}}
        state = self._state()
        made_for = [manifest["buckets"], self.measure.name, self.measure.floor, self.group_rows]
        if state is None or state["made_for"] != made_for:
            return self._build(manifest, made_for)
        old = state["register"]
        changed = sorted(b for b in old.keys() | manifest["files"].keys() if old.get(b) != manifest["files"].get(b))
        if not changed:
            return 0
        state = self._change(state, manifest, changed)
        if state["held"] > GROWN * max(1, state["built_of"]):
            return self._build(manifest, made_for)
        self._commit(state)
        return len(changed)

    def _build(self, manifest: dict, made_for: list) -> int:
        """Settle the order of tokens from the register as it is, then take in every bucket as changed."""
        names = active_names(self.register.of_buckets(manifest["files"])).select("name").distinct().filter(F.col("name") != "")
        names = cut_lineage(names)
        nothing = names.limit(0)
        order = token_counts(name_tokens(nothing, self.q), name_tokens(names, self.q))[1]
        rows = token_counts(nothing.withColumn("token", F.col("name")), prefix_rows(names, self.q, self.measure, order))[1]
        distinct = names.count()
        size = lambda n: max(LEAST_BUCKETS, -(-n // BUCKET_ROWS))
        state = {
            "made_for": made_for,
            "register": {},
            "versions": [0, 0, 0],
            "buckets": {"names": manifest["buckets"], "entries": size(distinct), "postings": size(sum(rows))},
            "order": order,
            "fan": fan_out(rows, self.group_rows),
            "built_of": distinct,
            "held": 0,
        }
        self._commit(self._change(state, manifest, sorted(manifest["files"])))
        return len(manifest["files"])

    def _postings(self, names: DataFrame, state: dict) -> DataFrame:
        rows = prefix_rows(names, self.q, self.measure, state["order"])
        deal = F.pmod(F.xxhash64("name"), bucket_value(state["fan"], F.col("token"))).cast("int")
        return rows.withColumn("deal", deal).select(*self._postings_schema.names)

    def _change(self, state: dict, manifest: dict, changed: list[str]) -> dict:
        """The state after the register's ``changed`` buckets: only what differs in them goes on to entries and postings."""
        names, entries, postings = self._tables(state)
        at = state["versions"]
        read = self.register.of_buckets(changed, manifest.get("version", 0))
        now = active_names(read).filter(F.col("name") != "").select(*_NAMES.names)
        before = names.of_buckets(changed, at[0]) if at[0] else now.limit(0)
        now = cut_lineage(now)
        gone, come = cut_lineage(before.exceptAll(now)), cut_lineage(now.exceptAll(before))
        if gone.isEmpty() and come.isEmpty():
            return {**state, "register": manifest["files"]}
        names.put(changed, now, at[0])
        all_names = names.versions.numbers()[-1]

        touched = cut_lineage(gone.select("name").union(come.select("name")).distinct())
        known = cut_lineage(entries.near(touched, at[1]).join(touched, "name", "left_semi"))
        # Where the row that answered is gone, the next one is looked up among all names; else the lowest of old and new stays.
        orphans = cut_lineage(known.join(gone.select("name", "abn"), ["name", "abn"], "left_semi").select("name"))
        parts = known.join(orphans, "name", "left_anti").select("name", "abn", "entity_name").unionByName(come.select("name", "abn", "entity_name"))
        if not orphans.isEmpty():
            parts = parts.unionByName(names.read(all_names).join(orphans, "name", "left_semi").select("name", "abn", "entity_name"))
        answers = cut_lineage(parts.groupBy("name").agg(F.min(F.struct("abn", "entity_name")).alias("e")).select("name", "e.abn", "e.entity_name"))
        keep = lambda current: current.join(touched, "name", "left_anti").unionByName(answers)
        entries.upsert(touched, lambda current, _: keep(current), at[1])
        all_entries = entries.versions.numbers()[-1]

        born = answers.join(known, "name", "left_anti").select("name")
        died = touched.join(answers, "name", "left_anti").join(known, "name", "left_semi").select("name")
        new, old = cut_lineage(self._postings(born, state)), cut_lineage(self._postings(died, state).select("token", "deal", "name"))
        places = new.select("token", "deal").union(old.select("token", "deal")).distinct()
        dead = old.select("name").distinct()
        merge = lambda current, _: current.join(dead, "name", "left_anti").unionByName(new)
        version = at[2]
        if not places.isEmpty():
            postings.upsert(places, merge, at[2])
            version = postings.versions.numbers()[-1]
        held = state["held"] + new.select("name").distinct().count() - dead.count()
        return {**state, "register": manifest["files"], "versions": [all_names, all_entries, version], "held": held}

    def _commit(self, state: dict) -> None:
        last = (self.states.numbers() or [0])[-1]
        self.states.commit({"version": last + 1, "files": {}, "index": json.loads(json.dumps(state))})

    def expire(self) -> None:
        """Remove what the last state does not name; results that read older ones must be done."""
        state = self._state()
        if state is None:
            return
        for table, version in zip(self._tables(state), state["versions"], strict=True):
            table.expire(0, [version])
        self.states.expire(1)

    def entries(self, names: DataFrame) -> DataFrame:
        """``name`` and ``entry`` (abn, entity_name) for those of ``names`` that the register holds."""
        state = self._state()
        _, entries, _ = self._tables(state)
        return entries.near(names, state["versions"][1]).join(names.select("name"), "name", "left_semi").select("name", F.struct("abn", "entity_name").alias("entry"))

    def candidate_pairs(self, sites: DataFrame, measure: Measure, first_letter: bool = False) -> DataFrame:
        """What ``similarity_join.candidate_pairs`` finds among the register's names, from the postings of the sites' tokens."""
        if measure.name != self.measure.name or measure.floor < self.measure.floor:
            raise ValueError(f"the index is for {self.measure}, not {measure}")
        state = self._state()
        _, _, postings = self._tables(state)
        low = F.col("low") if "low" in sites.columns else F.lit(measure.floor)
        left = cut_lineage(prefix_rows(sites.select("name", low.alias("low")), self.q, measure, state["order"]))
        counts = token_counts(left, left.limit(0))[0]
        site_fan = fan_out(counts, self.group_rows)
        deals = F.sequence(F.lit(0), (bucket_value(state["fan"], F.col("token")) - 1).cast("int"))
        mine = F.pmod(F.xxhash64("name"), bucket_value(site_fan, F.col("token"))).cast("int")
        wanted = left.select("token", F.explode(deals).alias("deal"))
        right = postings.near(wanted, state["versions"][2])
        left = left.withColumn("salt_s", mine).withColumn("salt_r", F.explode(deals))
        theirs = F.sequence(F.lit(0), (bucket_value(site_fan, F.col("token")) - 1).cast("int"))
        right = right.withColumnRenamed("deal", "salt_r").withColumn("salt_s", F.explode(theirs))
        return meeting_pairs(left, right, measure, self.q, first_letter)
