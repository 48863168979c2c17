"""Tables that a load changes in part: keyed tables in hash buckets, and an append-only log of unique pairs.

A version of a table is a *manifest*: a small JSON file that names the Parquet files of each bucket (or segment). A load writes the files of
the buckets its keys fall in and a manifest that refers to the files of all others as they are. Manifests are written under another name
and renamed, so a version is there as a whole or not at all; a load that fails leaves files that nothing names, which ``expire`` removes.
What the driver holds is the manifest: it grows with buckets and segments, not with rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.operators.numbering import dense_ids
from firmweave.session import cut_lineage

BUCKET = "key_bucket"
_MANIFEST, _DATA = "manifests", "data"


class Files:
    """The few file-system calls that Spark's readers and writers do not cover."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root
        self.fs = self.path().getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The whole file or, if another load has written it meanwhile, an error."""
        draft = f"{name}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(draft), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.fs.exists(self.path(name)) or not self.fs.rename(self.path(draft), self.path(name)):
            raise RuntimeError(f"{self.root}/{name} is there already: another load was faster")

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class Versions:
    """The manifests of a table, one file a version."""

    def __init__(self, spark: SparkSession, path: str):
        self.files = Files(spark, path)

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(_MANIFEST) if n.endswith(".json") and n[:-5].isdigit())

    def load(self, number: int | None = None) -> dict | None:
        if number is None:
            numbers = self.numbers()
            if not numbers:
                return None
            number = numbers[-1]
        return json.loads(self.files.read(f"{_MANIFEST}/{number:09d}.json"))

    def commit(self, manifest: dict) -> None:
        self.files.write(f"{_MANIFEST}/{manifest['version']:09d}.json", json.dumps(manifest))

    def expire(self, keep: int, named: Iterable[int] = ()) -> None:
        """Remove all but the last ``keep`` versions and the ``named`` ones, and the folders of data that none of these names."""
        numbers = self.numbers()
        last = numbers[-keep:] if keep else []
        kept = [n for n in numbers if n in {*last, *named}] or numbers[-1:]
        manifests = [self.load(n) for n in kept]
        used = {part.split("/")[0] for m in manifests for group in [*m["files"].values(), m.get("filters", [])] for part in group}
        for n in [n for n in numbers if n not in kept]:
            self.files.remove(f"{_MANIFEST}/{n:09d}.json")
        for folder in self.files.names(_DATA):
            if folder not in used:
                self.files.remove(f"{_DATA}/{folder}")


def _write_buckets(files: Files, rows: DataFrame, bucket: Column, columns: list[str]) -> dict[str, list[str]]:
    """Write ``rows`` to a new folder, one file a bucket; returns the files by bucket, as paths under the data folder."""
    folder = uuid.uuid4().hex
    out = rows.select(*columns, bucket.alias(BUCKET)).repartition(F.col(BUCKET))
    out.write.partitionBy(BUCKET).parquet(f"{files.root}/{_DATA}/{folder}")
    found: dict[str, list[str]] = {}
    for part in files.names(f"{_DATA}/{folder}"):
        if part.startswith(f"{BUCKET}="):
            names = [n for n in files.names(f"{_DATA}/{folder}/{part}") if n.endswith(".parquet")]
            found[part.removeprefix(f"{BUCKET}=")] = [f"{folder}/{part}/{n}" for n in names]
    return found


def read_files(spark: SparkSession, root: str, names: Iterable[str], schema: T.StructType) -> DataFrame:
    """Rows of files of the table under ``root``, as its manifests name them."""
    paths = [f"{root}/{_DATA}/{n}" for n in names]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


@dataclass
class KeyedTable:
    """One row for each ``key``, in ``buckets`` by a hash of the key (the number is fixed when the first version is written).

    ``counter`` is a column of ascending numbers, whose highest value the manifest keeps, so that new rows need no look at old ones.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: list[str]
    counter: str | None = None
    buckets: int = 64

    def __post_init__(self):
        self.versions = Versions(self.spark, self.path)

    def _bucket(self, manifest: dict | None) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(manifest["buckets"] if manifest else self.buckets)).cast("int")

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of a version, the last by default; none if there is no version."""
        manifest = self._base(version)[0]
        return read_files(self.spark, self.path, [f for group in manifest["files"].values() for f in group] if manifest else [], self.schema)

    def replace(self, rows: DataFrame) -> DataFrame:
        """A version of ``rows`` alone; they may come from the version before."""
        old = self.versions.load()
        files = _write_buckets(self.versions.files, rows, self._bucket(old), self.schema.names)
        self._commit(old, files, files, 0, old["version"] + 1 if old else 1)
        return self.read()

    def upsert(self, fresh: DataFrame, merge: Callable[[DataFrame, int], DataFrame], base: int | None = None) -> DataFrame:
        """A version in which the buckets of ``fresh``'s keys are ``merge(their rows, highest counter)``.

        ``merge`` returns the buckets' rows as they shall be; it may not make keys of other buckets. ``fresh`` should
        be written already (it is read twice). Rows of all other buckets are neither read nor written. ``base`` is the version
        to go on from (the last by default; 0 is an empty table).
        """
        old, number = self._base(base)
        touched = self._touched(fresh, old)
        if not touched:
            return self.read(base)
        before = old["files"] if old else {}
        current = read_files(self.spark, self.path, [f for b in touched for f in before.get(b, [])], self.schema)
        return self._put(old, number, touched, merge(current, old["highest"] if old else 0))

    def put(self, buckets: Iterable[str], rows: DataFrame, base: int | None = None) -> DataFrame:
        """A version in which ``buckets`` hold ``rows`` alone; all other buckets stay as they are in ``base``."""
        return self._put(*self._base(base), buckets, rows)

    def _put(self, old: dict | None, number: int, buckets: Iterable[str], rows: DataFrame) -> DataFrame:
        buckets = set(buckets)
        files = _write_buckets(self.versions.files, rows, self._bucket(old), self.schema.names)
        if not set(files) <= buckets:
            raise ValueError("rows have keys of buckets that the load does not touch")
        kept = {b: f for b, f in (old["files"] if old else {}).items() if b not in buckets}
        self._commit(old, kept | files, files, old["highest"] if old else 0, number)
        return self.read(number)

    def _base(self, version: int | None) -> tuple[dict | None, int]:
        """The manifest to go on from and the number of the version to come."""
        if version is None:
            old = self.versions.load()
            return old, old["version"] + 1 if old else 1
        return self.versions.load(version) if version else None, (self.versions.numbers() or [0])[-1] + 1

    def of_buckets(self, buckets: Iterable[str], version: int | None = None) -> DataFrame:
        """Rows of some buckets; no file of another is read."""
        manifest = self._base(version)[0]
        return read_files(self.spark, self.path, [f for b in buckets for f in manifest["files"].get(b, [])] if manifest else [], self.schema)

    def near(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """Rows of the buckets in which ``keys`` lie: all rows of these keys, and others."""
        return self.of_buckets(self._touched(keys, self._base(version)[0]), version)

    def _touched(self, keys: DataFrame, manifest: dict | None) -> list[str]:
        return [str(r[0]) for r in keys.select(self._bucket(manifest).alias(BUCKET)).distinct().collect()]  # buckets at most

    def _commit(self, old: dict | None, files: dict, new: dict, highest: int, version: int) -> None:
        if self.counter and new:
            rows = read_files(self.spark, self.path, [f for group in new.values() for f in group], self.schema)
            highest = max(highest, rows.agg(F.coalesce(F.max(self.counter), F.lit(0))).first()[0])
        self.versions.commit({"version": version, "buckets": old["buckets"] if old else self.buckets, "highest": highest, "files": files})

    def expire(self, keep: int = 2, named: Iterable[int] = ()) -> None:
        """Remove old versions but the ``named`` ones; results that still read them must be done."""
        self.versions.expire(keep, named)


# Bits of a filter for each key, and bits set for each: about one key in a hundred is looked up in vain.
_BITS, _SET = 10, 7


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return (low[:, None] + high[:, None] * np.arange(_SET, dtype=np.uint64)) % np.uint64(size)


def make_filter(hashes: np.ndarray) -> bytes:
    """A Bloom filter of 64-bit hashes."""
    size = max(64, len(hashes) * _BITS)
    bits = np.zeros(size, bool)
    bits[_places(hashes, size).ravel()] = True
    return np.int64(size).tobytes() + np.packbits(bits).tobytes()


def may_hold(packed: bytes, hashes: np.ndarray) -> np.ndarray:
    """Whether the filter may hold each hash; never False for one that it was made of."""
    size = int(np.frombuffer(packed[:8], np.int64)[0])
    bits = np.unpackbits(np.frombuffer(packed, np.uint8, offset=8), count=size)
    return bits[_places(hashes, size)].all(axis=1)


@dataclass
class PairLog:
    """Rows that are only added: numbered segments, pairs of ``key`` unique over all of them.

    Each segment is dealt into buckets by a hash of the pair, with a Bloom filter for each. New rows are tested against the filters of
    their bucket; only buckets of segments that may hold one of their pairs are read. So an append writes its own rows, and reads
    filters and, where a pair repeats, a few buckets. Rows with a NULL in the pair are never the same as others.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    key: list[str]
    number: str
    buckets: int = 64

    def __post_init__(self):
        self.versions = Versions(self.spark, self.path)

    def _bucket(self, manifest: dict | None) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(manifest["buckets"] if manifest else self.buckets)).cast("int")

    def read(self, version: int | None = None) -> DataFrame:
        manifest = self.versions.load(version)
        return read_files(self.spark, self.path, [f for group in manifest["files"].values() for f in group] if manifest else [], self.schema)

    def unseen(self, new: DataFrame) -> DataFrame:
        """Rows of ``new`` whose pair no segment holds."""
        manifest = self.versions.load()
        filters = [f"{self.path}/{_DATA}/{f}" for f in manifest["filters"]] if manifest else []
        if not filters:
            return new
        known = [F.col(k).isNotNull() for k in self.key]
        keyed = known[0]
        for c in known[1:]:
            keyed &= c
        pairs = new.where(keyed).select(F.xxhash64(*self.key).alias("h"), self._bucket(manifest).alias(BUCKET))

        def test(key, rows, made):
            hashes = rows.column("h").to_numpy().view(np.uint64)
            hit = [s for s, bits in zip(made.column("segment").to_pylist(), made.column("bits"), strict=True) if len(hashes) and may_hold(bits.as_py(), hashes).any()]
            return pa.table({"segment": pa.array(hit, pa.string()), BUCKET: pa.array([key[0].as_py()] * len(hit), pa.int32())})

        held = self.spark.read.schema(f"segment string, {BUCKET} int, bits binary").parquet(*filters)
        hits = pairs.groupBy(BUCKET).cogroup(held.groupBy(BUCKET)).applyInArrow(lambda key, a, b: test(key, a, b), f"segment string, {BUCKET} int")
        wanted = {(r["segment"], str(r[BUCKET])) for r in hits.collect()}  # buckets times segments at most
        names = [f for name, group in manifest["files"].items() if tuple(name.split(":")) in wanted for f in group]
        seen = read_files(self.spark, self.path, names, self.schema).select(*self.key)
        return new.join(seen, self.key, "left_anti").select(*new.columns)

    def append(self, new: DataFrame, order: list[str], stamp: dict[str, Column]) -> DataFrame:
        """Add rows whose pair is new, numbered on in ``order``, with the columns of ``stamp``; pairs of ``new`` must differ."""
        old = self.versions.load()
        highest = old["highest"] if old else 0
        columns = [c for c in self.schema.names if c != self.number and c not in stamp]
        fresh = cut_lineage(self.unseen(new.select(*columns)))
        if fresh.isEmpty():
            return self.read()
        rows = dense_ids(fresh, [F.col(c) for c in order], self.number, start=highest + 1)
        rows = rows.withColumn(self.number, F.col(self.number).cast(self.schema[self.number].dataType)).withColumns(stamp)
        self._add(old, rows, old["files"] if old else {}, old["filters"] if old else [])
        return self.read()

    def replace(self, rows: DataFrame) -> DataFrame:
        """One segment of ``rows`` alone; they may come from the version before."""
        self._add(self.versions.load(), rows, {}, [])
        return self.read()

    def compact(self) -> DataFrame:
        """All segments as one."""
        return self.replace(self.read())

    def _add(self, old: dict | None, rows: DataFrame, files: dict, filters: list[str]) -> None:
        store = self.versions.files
        new = _write_buckets(store, rows, self._bucket(old), self.schema.names)
        segment = uuid.uuid4().hex
        written = read_files(self.spark, self.path, [f for group in new.values() for f in group], self.schema)

        def pack(key, table):
            bits = make_filter(table.column("h").to_numpy().view(np.uint64))
            return pa.table({"segment": pa.array([segment]), BUCKET: pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits], pa.binary())})

        pairs = written.select(F.xxhash64(*self.key).alias("h"), self._bucket(old).alias(BUCKET))
        packed = pairs.groupBy(BUCKET).applyInArrow(lambda key, t: pack(key, t), f"segment string, {BUCKET} int, bits binary")
        folder = uuid.uuid4().hex
        packed.write.parquet(f"{self.path}/{_DATA}/{folder}")
        top = written.agg(F.coalesce(F.max(self.number), F.lit(0))).first()[0]
        version = old["version"] + 1 if old else 1
        named = {f"{segment}:{b}": group for b, group in new.items()}
        manifest = {"version": version, "buckets": old["buckets"] if old else self.buckets, "highest": max(top, old["highest"] if old else 0)}
        self.versions.commit(manifest | {"files": files | named, "filters": [*filters, folder]})

    def expire(self, keep: int = 2) -> None:
        self.versions.expire(keep)
