"""Embedding near-dedup by sorted projection passes.

In each pass the vectors of a label are ordered by 64 concatenated random hyperplane signs and compared with a bounded window of
neighbours; the pairs found in all passes are united. What the windows leave apart is then compared in full, block by block within its
label, so that no link is lost however alike a label's vectors are. Equal vectors are one class throughout. Links inside a component are
counted in full, too, since in a dense group many links lie outside all windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmweave.llm.components import components
from firmweave.llm.simhash_dedup import Forest
from firmweave.llm.tables import bound_batches, per_batch, per_shard, row_shards, settle

# Neighbours compared on each side, and passes. They unite most of what is near; results do not depend on them.
PASSES = 12
WINDOW = 64
# Rows of a segment and vectors of a block; layout only.
SEGMENT = 2048
BLOCK = 1024
REST_BLOCK = 2048


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def _classes(vectors: DataFrame) -> DataFrame:
    """Classes of equal usable vectors: ``cid``, ``label``, ``embedding`` (doubles), ``copies``, ``first`` (smallest id)."""
    values = F.col("embedding")
    # Compared with the largest double, since a NaN is above it; a null component gives a null, which is not true.
    finite = F.forall(values, lambda x: x.isNotNull() & (F.abs(x) <= 1.7976931348623157e308))
    usable = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists(values, lambda x: x != 0)
    grouped = vectors.where(usable).groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"))
    return grouped.withColumn("cid", F.monotonically_increasing_id())


def _projections(classes: DataFrame, passes: int, seed: int) -> DataFrame:
    """A row for each class and pass: ``pass``, ``label``, ``d``, ``key`` (64 signs), ``cid``, ``embedding``."""

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for d in set(table.column("d").to_pylist()):
                part = table.filter(pa.compute.equal(table.column("d"), d))
                if d not in planes:
                    planes[d] = np.random.Generator(np.random.PCG64([seed, d])).standard_normal((d, 64 * passes))
                signs = (_matrix(part.column("embedding"), d) @ planes[d] > 0).reshape(part.num_rows, passes, 64)
                # Signed order of the words is the lexicographic order of the signs with the first one flipped: still a sort by prefix.
                keys = np.packbits(signs, axis=2).reshape(-1, 8).view(">u8").astype(np.uint64).view(np.int64).reshape(-1, passes)
                for k in range(passes):
                    yield from part.append_column("pass", pa.array(np.full(part.num_rows, k, np.int32))).append_column("key", pa.array(keys[:, k])).to_batches()

    with_d = classes.select("label", "cid", F.size("embedding").alias("d"), "embedding")
    kind = dict(classes.dtypes)["label"]
    return per_batch(with_d, run, f"label {kind}, cid bigint, d int, embedding array<double>, pass int, key bigint")


def _found(projected: DataFrame, threshold: float, window: int) -> DataFrame:
    """Links (``a``, ``b``) that connect all classes at ``threshold`` or above within ``window`` places of one pass.

    Of the pairs of a segment only a spanning star of each group is sent on, so rows do not grow with the square of a group.
    """
    order = ["pass", "label", "d", "key", "cid"]
    laid = projected.repartitionByRange(*order).sortWithinPartitions(*order)
    laid = laid.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    laid = settle(laid, "projections")
    sizes = laid.groupBy("part").agg(F.count(F.lit(1)).alias("size"))  # one row per partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before")))
    placed = laid.join(offsets, "part").withColumn("place", F.col("before") + F.col("row"))
    segment = F.floor(F.col("place") / SEGMENT)
    # A row opens windows in its own segment and closes those that reach over from the one before.
    spread = F.when(F.col("place") % SEGMENT < window, F.array(segment, segment - 1)).otherwise(F.array(segment))
    placed = placed.select("place", "pass", "label", "d", "cid", "embedding", F.explode(spread).alias("segment"))

    def run(key, table):
        table = table.sort_by("place")
        segment = key[0].as_py()
        own = int((table.column("place").to_numpy() // SEGMENT == segment).sum())
        groups = np.unique(np.array([f"{p}|{lab}|{d}" for p, lab, d in zip(*(table.column(c).to_pylist() for c in ("pass", "label", "d")), strict=True)]), return_inverse=True)[1]
        ids = table.column("cid").to_numpy()
        forest = Forest(len(ids))
        for g in np.unique(groups[:own]):
            at = np.flatnonzero(groups == g)
            unit = _unit(_matrix(table.column("embedding").take(pa.array(at)), table.column("d")[int(at[0])].as_py()))
            mine = int((at < own).sum())
            for lo in range(0, mine, 256):
                hi = min(mine, lo + 256)
                stop = min(len(at), hi + window)
                near = unit[lo:hi] @ unit[lo:stop].T >= threshold
                i, j = np.nonzero(near)
                ok = (j > i) & (j - i <= window)
                forest.union(at[lo + i[ok]], at[lo + j[ok]])
        joined = np.flatnonzero(forest.root != np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[joined]), "b": pa.array(ids[forest.root[joined]])})

    return placed.groupBy("segment").applyInArrow(lambda key, rows: run(key, rows), "a bigint, b bigint").distinct()


def _left_apart(classes: DataFrame, roots: DataFrame, threshold: float) -> DataFrame:
    """Links (``a``, ``b``) that connect, with those of ``roots``, all classes of a label and length at ``threshold`` or above.

    A label is cut into blocks; each pair of blocks is compared in one place. Pairs of one component are not told again.
    """
    known = classes.join(roots, F.col("cid") == F.col("node"), "left")
    known = known.select("label", F.size("embedding").alias("d"), "cid", F.coalesce("root", "cid").alias("root"), "embedding")
    sizes = known.groupBy("label", "d").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("least"), F.max("root").alias("most"))
    parts = F.ceil(F.col("size") / REST_BLOCK).cast("int")
    part = F.pmod(F.xxhash64("cid"), parts).cast("int")
    dealt = known.join(sizes.where("least <> most").select("label", "d", "size"), ["label", "d"])
    dealt = dealt.select("label", "d", "cid", "root", "embedding", part.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    dealt = dealt.select("label", "d", "cid", "root", "embedding", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), (F.col("part") > F.col("other")).cast("int").alias("side"))

    def run(key, table):
        table = table.sort_by("side")
        ids, root, side = (table.column(c).to_numpy() for c in ("cid", "root", "side"))
        unit = _unit(_matrix(table.column("embedding"), table.column("d")[0].as_py()))
        forest = Forest(len(ids))
        cut = int((side == 0).sum())
        across = cut < len(ids)
        for lo in range(0, cut, 256):
            hi = min(cut, lo + 256)
            first = cut if across else lo
            near = (unit[lo:hi] @ unit[first:].T >= threshold) & (root[lo:hi, None] != root[None, first:])
            i, j = np.nonzero(near)
            forest.union(lo + i, first + j)
        joined = np.flatnonzero(forest.root != np.arange(len(ids)))
        return pa.table({"a": pa.array(ids[joined]), "b": pa.array(ids[forest.root[joined]])})

    return dealt.groupBy("label", "d", "low", "high").applyInArrow(lambda key, rows: run(key, rows), "a bigint, b bigint")


def _link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """``cid`` and ``links``: for each class the vectors of other classes of its component that it links with directly.

    A component is cut into blocks; each pair of blocks is compared in one place, and only counts leave it.
    """
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("size"), F.first(F.size("embedding")).alias("width"))
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    n = row_shards(sizes, F.col("size") * parts * F.col("width").cast("bigint") * 8)
    part = F.pmod(F.xxhash64("cid"), parts).cast("int")
    dealt = members.join(sizes, "root").select("root", "cid", "copies", "embedding", part.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    dealt = dealt.select("root", "cid", "copies", "embedding", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), (F.col("part") > F.col("other")).cast("int").alias("side"))
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("root", "low", "high"), n).cast("int"))

    def run(key, table):
        table = table.sort_by([("root", "ascending"), ("low", "ascending"), ("high", "ascending"), ("side", "ascending")])
        root, low, high, side = (table.column(c).to_numpy() for c in ("root", "low", "high", "side"))
        ids, copies = table.column("cid").to_numpy(), table.column("copies").to_numpy()
        new = np.ones(len(ids), bool)
        new[1:] = (root[1:] != root[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        cut = np.append(np.flatnonzero(new), len(ids))
        links = np.zeros(len(ids), np.int64)
        for s, e in zip(cut[:-1], cut[1:], strict=True):
            column = table.column("embedding").slice(s, e - s)
            unit = _unit(_matrix(column, len(column[0])))
            if low[s] == high[s]:
                near = unit @ unit.T >= threshold
                np.fill_diagonal(near, False)
                links[s:e] = near @ copies[s:e]
            else:
                m = s + int((side[s:e] == 0).sum())
                near = unit[: m - s] @ unit[m - s :].T >= threshold
                links[s:m] = near @ copies[m:e]
                links[m:e] = copies[s:m] @ near
        return pa.table({"cid": pa.array(ids), "links": pa.array(links)})

    counted = per_shard(dealt, run, "cid bigint, links bigint")
    return counted.groupBy("cid").agg(F.sum("links").alias("links"))


def link_embeddings(vectors: DataFrame, threshold: float = 0.98, passes: int = PASSES, window: int = WINDOW, seed: int = 7) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of each row of ``vectors`` (``vec_id``, ``embedding``, ``label``).

    Two rows link if their labels are equal and not null, their vectors have one length, and the cosine in double precision is
    ``threshold`` or more. Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows without id.
    ``n_links`` counts other rows, copies included; ``component_id`` is the smallest id reachable, ``kept`` whether it is
    the row's own. Repeated ids are vectors of their own. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label")
    classes = settle(_classes(rows), "vectors")
    found = settle(_found(_projections(classes, passes, seed), threshold, window), "window_links")
    rest = settle(_left_apart(classes, components(found), threshold), "rest_links")
    roots = components(found.union(rest))
    members = classes.join(roots, F.col("cid") == F.col("node")).select("root", "cid", "copies", "first", "embedding")
    members = settle(members, "members")
    names = members.groupBy("root").agg(F.min("first").alias("name"))
    facts = members.select("root", "cid").join(_link_counts(members, threshold), "cid").join(names, "root").select("cid", "links", "name")
    known = classes.join(facts, "cid", "left").select(
        "label",
        "embedding",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("name", "first").alias("component"),
    )
    known = settle(known, "linked")
    told = rows.join(known, ["label", "embedding"], "left")
    has_id = F.col("vec_id").isNotNull()
    component = F.when(has_id, F.coalesce("component", "vec_id"))
    return told.select(
        "vec_id",
        F.when(has_id, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        (~has_id | (component == F.col("vec_id"))).alias("kept"),
    )
