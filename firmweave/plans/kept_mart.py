"""The company table brought up to its sources by the rows that changes touch, with ids that stay.

Register, crawl and matches are lists of files (``sources/keyed``). A refresh compares the lists with those of the last one, and in files that differ the
rows, so it knows the changed sites, register rows and links. Then

* sites that changed, whose links changed or that stand behind a changed register row get their rows anew (matched, crawl-only), and
* numbers that changed, or of which a link or a linked site changed, get their register-only row anew, if they still are one.

Rows lie in buckets by address, or by number where there is none, so a hot number is no hot bucket. Buckets without touched rows are neither read
nor written. A row that is still there (same source, address and number; for crawl-only rows, same address) keeps its id, and ``updated_at`` if nothing
in it changed; new rows get the ids after the highest one ever given. The order of ids is that of the full build in the first version alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.operators.numbering import dense_ids
from firmweave.plans import models
from firmweave.schemas import COMPANIES
from firmweave.session import cut_lineage
from firmweave.sources import tables
from firmweave.sources.keyed import Files, KeyedTable, Versions, read_files

_KEY = "row_key"
_SCHEMA = T.StructType([T.StructField(_KEY, T.StringType()), *COMPANIES.fields])
_CONTENT = [c for c in COMPANIES.names if c not in ("company_id", "updated_at")]
# The sources, with the columns by which a changed row touches the table.
_KEYS = {"registry": ["abn"], "crawl": ["id", "website_url"], "matches": ["cc_id", "abn"]}
_SOURCES = tuple(_KEYS)


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn(_KEY, F.coalesce("website_url", "abn"))


def _changed(spark: SparkSession, root: str, name: str, old: dict, new: dict) -> DataFrame | None:
    """Keys (the columns of ``_KEYS``) of rows of a table that one of two versions has more often, each once; None where old files are gone."""
    before = {f for group in old.values() for f in group}
    after = {f for group in new.values() for f in group}
    path, schema = f"{root}/{name}", tables.TABLES[name]
    store, gone, come = Files(spark, path), sorted(before - after), sorted(after - before)
    if not all(store.exists(f"data/{f}") for f in gone):
        return None
    rows = read_files(spark, path, come, schema)
    if gone:
        # Both versions in one pass: what is left after rows of the one are set off against equal rows of the other.
        both = rows.withColumn("_more", F.lit(1)).unionByName(read_files(spark, path, gone, schema).withColumn("_more", F.lit(-1)))
        rows = both.groupBy(*schema.names).agg(F.sum("_more").alias("_more")).where("_more <> 0")
    return cut_lineage(rows.select(*_KEYS[name]).distinct())


def _distinct(frames: Iterable[DataFrame], column: str) -> DataFrame:
    """Different values, not NULL, of the one column of ``frames``, written once."""
    frames = list(frames)
    both = frames[0]
    for frame in frames[1:]:
        both = both.union(frame)
    return cut_lineage(both.toDF(column).where(F.col(column).isNotNull()).distinct())


class KeptMart:
    """The company table under ``root/companies_kept``."""

    def __init__(self, spark: SparkSession, root: str, active_only: bool = False, buckets: int = 64):
        self.spark, self.root, self.active_only = spark, root, active_only
        path = f"{root}/companies_kept"
        self.table = KeyedTable(spark, f"{path}/rows", _SCHEMA, [_KEY], counter="company_id", buckets=buckets)
        self.states = Versions(spark, f"{path}/state")

    def read(self) -> DataFrame:
        """The table as the last refresh left it."""
        state = self._state()
        rows = self.table.read(state["version"] if state else 0)
        return rows.select(*COMPANIES.names)

    def _state(self) -> dict | None:
        state = self.states.load()
        return state["mart"] if state else None

    def refresh(self, now: Column) -> DataFrame:
        """Bring the table up to the last versions of its sources and return it."""
        manifests = {name: tables.stored(self.spark, self.root, name).versions.load() for name in _SOURCES}
        files = {name: m["files"] if m else {} for name, m in manifests.items()}
        state = self._state()
        changes = None
        if state and state["active_only"] == self.active_only:
            if state["files"] == files:
                return self.read()
            parts = [_changed(self.spark, self.root, name, state["files"][name], files[name]) for name in _SOURCES]
            changes = None if any(p is None for p in parts) else parts
        sources = [read_files(self.spark, f"{self.root}/{n}", [f for g in files[n].values() for f in g], tables.TABLES[n]) for n in _SOURCES]
        if changes is None:
            version = self._rebuild(state, sources, now)
        else:
            version = self._change(state["version"], sources, changes, now)
        last = (self.states.numbers() or [0])[-1]
        self.states.commit({"version": last + 1, "files": {}, "mart": {"files": files, "version": version, "active_only": self.active_only}})
        return self.read()

    def _rebuild(self, state: dict | None, sources: list[DataFrame], now: Column) -> int:
        """Everything anew; ids stay where the rows were there before."""
        if state:
            rows = models.companies_unnumbered(*sources, self.active_only)
            old = self.table.read(state["version"])
            fresh = self._numbered(rows, old, self.table.versions.load(state["version"])["highest"], now)
        else:
            fresh = models.companies(*sources, now=now, active_only=self.active_only)
        base = state["version"] if state else 0
        self.table.put(map(str, range(self.table.buckets)), _keyed(fresh), base)
        return self.table.versions.numbers()[-1]

    def _change(self, base: int, sources: list[DataFrame], changes: list[DataFrame], now: Column) -> int:
        registry, crawl, matches = sources
        entities, sites, links = changes
        numbers = _distinct([entities.select("abn")], "abn")
        # Sites whose rows are made anew, and numbers whose register-only row is.
        behind = matches.join(numbers, "abn", "left_semi").select("cc_id")
        ids = _distinct([sites.select("id"), links.select("cc_id"), behind], "id")
        own = cut_lineage(crawl.join(ids, "id", "left_semi"))
        linked = cut_lineage(matches.join(ids.withColumnRenamed("id", "cc_id"), "cc_id", "left_semi"))
        alone = _distinct([numbers, links.select("abn"), linked.select("abn")], "abn")

        rows = registry.join(alone, "abn", "left_semi")
        of_sites = models.companies_unnumbered(rows, own, linked, self.active_only).where("data_source <> 'ABR'")
        met = matches.join(alone, "abn", "left_semi").join(models.crawl_clean(crawl).select("cc_id"), "cc_id", "left_semi").select("abn").distinct()
        of_numbers = models.companies_unnumbered(rows.join(met, "abn", "left_anti"), own.limit(0), linked.limit(0))
        made = cut_lineage(_keyed(of_sites.unionByName(of_numbers)))

        keys = _distinct([sites.select("website_url"), own.select("website_url"), alone], _KEY)
        highest = self.table.versions.load(base)["highest"]

        def merge(current: DataFrame, _: int) -> DataFrame:
            old = current.join(keys, _KEY, "left_semi")
            fresh = self._numbered(made.drop(_KEY), old, highest, now)
            return current.join(keys, _KEY, "left_anti").unionByName(_keyed(fresh).select(*_SCHEMA.names))

        if keys.isEmpty():
            return base
        self.table.upsert(keys, merge, base)
        return self.table.versions.numbers()[-1]

    @staticmethod
    def _numbered(rows: DataFrame, old: DataFrame, highest: int, now: Column) -> DataFrame:
        """``rows`` with the ids of ``old`` rows that they continue, and new ids for the others."""
        # Equal rows of one identity (a site matched to a number twice) are told apart by their order.
        same = [
            F.col("data_source"),
            F.coalesce("website_url", F.lit("")),
            F.when(F.col("data_source") == "CC", F.lit("")).otherwise(F.coalesce("abn", F.lit(""))),
        ]
        identity = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(same)])

        # Rows and the old rows they continue meet in one shuffle, by identity: both windows keep to it.
        was = F.struct("company_id", "updated_at", F.struct(*_CONTENT).alias("content"))
        both = rows.select(*_CONTENT, F.lit(None).cast("bigint").alias("company_id"), F.lit(None).cast("timestamp").alias("updated_at"), F.lit(False).alias("_old"))
        both = both.unionByName(old.select(*_CONTENT, "company_id", "updated_at", F.lit(True).alias("_old")))
        order = Window.partitionBy("_same", "_old").orderBy(F.col("created_at"), F.col("match_confidence"), F.xxhash64(*_CONTENT))
        placed = both.withColumn("_same", identity).repartition("_same").withColumn("_nth", F.row_number().over(order))
        next_old = F.lead(F.when(F.col("_old"), was)).over(Window.partitionBy("_same", "_nth").orderBy("_old"))
        found = placed.withColumn("_was", next_old).where(~F.col("_old"))
        joined = cut_lineage(found.select(*_CONTENT, "_was.company_id", "_was.updated_at", F.col("_was.content").alias("_was")))
        stays = joined.where(F.col("company_id").isNotNull())
        unchanged = F.struct(*_CONTENT).eqNullSafe(F.col("_was"))
        stays = stays.withColumn("updated_at", F.when(unchanged, F.col("updated_at")).otherwise(now))
        new = joined.where(F.col("company_id").isNull()).select(*_CONTENT)
        new = dense_ids(new, models.company_order(), "company_id", start=highest + 1).withColumn("updated_at", now)
        return stays.select(*COMPANIES.names).unionByName(new.select(*COMPANIES.names))

    def expire(self) -> None:
        """Remove versions before the last refresh; results that read them must be done."""
        state = self._state()
        if state:
            self.table.expire(0, [state["version"]])
            self.states.expire(1)
