"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints that differ in three bits at most agree on one of four 16-bit blocks, so pairs are sought among those with an equal
block. There they are sorted by Gray rank (neighbours then share most bits); runs of neighbours form nodes, runs of nodes upper
nodes, each with the bits that all below it share. A node whose shared bits differ from a query in more than three
places is pruned with all below it. Only different fingerprints are compared; copies are a class of one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from firmweave.llm.components import components
from firmweave.llm.memo import forget
from firmweave.llm.tables import Texts, bound_batches, per_batch, per_shard, row_shards, settle
from firmweave.llm.words import WHITE, word_bounds

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_SEED = 42
_FAN = 8
# Fingerprints of one block value from which on they are dealt as pairs of parts; pairs held at once. Layout only.
PART = 1024
# Bytes of a fingerprint dealt to a shard, with its block and parts.
_ROW_BYTES = 32
_AT_ONCE = 1 << 18


def fingerprints(texts: Texts, shingle: int = 3) -> np.ndarray:
    """64-bit SimHash of each text over shingles of words; zero without words."""
    data = np.frombuffer(texts.data.tobytes().translate(_LOWER), np.uint8)
    starts, ends, at = word_bounds(data, texts.offsets, WHITE)
    out = np.zeros(len(texts), np.uint64)
    if not len(starts):
        return out
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    place = before + np.arange(len(starts))
    joined = np.full(int(place[-1] + lengths[-1]), 0x20, np.uint8)
    inner = np.arange(lengths.sum()) - np.repeat(before, lengths)
    joined[np.repeat(place, lengths) + inner] = data[np.repeat(starts, lengths) + inner]
    flat = joined.tobytes()
    words = np.diff(at)
    counts = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
    first = np.repeat(at[:-1], counts) + (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
    last = np.minimum(first + shingle, np.repeat(at[1:], counts)) - 1
    left, right = place[first], place[last] + lengths[last]
    digest = xxhash.xxh64_intdigest
    heads = np.cumsum(counts) - counts
    votes = np.zeros((len(texts), 64), np.int64)
    step = 1 << 16
    for lo in range(0, len(left), step):
        ranges = zip(left[lo : lo + step].tolist(), right[lo : lo + step].tolist(), strict=True)
        hashes = np.array([digest(flat[a:b], _SEED) for a, b in ranges], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        doc = int(np.searchsorted(heads, lo, side="right") - 1)
        stop = int(np.searchsorted(heads, lo + len(hashes)))
        inside = np.arange(doc, stop)[counts[doc:stop] > 0]
        cut = np.maximum(heads[inside] - lo, 0)
        votes[inside] += np.add.reduceat(bits, cut, axis=0, dtype=np.int64)
    set_bits = votes * 2 > counts[:, None]
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the Gray sequence."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


class Forest:
    """Union of verified pairs within a task; only a spanning star of each tree is sent on."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                jumped = self.root[self.root]
                if np.array_equal(jumped, self.root):
                    break
                self.root = jumped


def near_pairs(groups: np.ndarray, sides: np.ndarray, codes: np.ndarray, radius: int, emit) -> None:
    """Call ``emit(i, j)`` with all pairs of one group within ``radius`` bits (if the group has two sides, across them).

    Rows must be sorted by group and, within it, by Gray rank.
    """
    n = len(codes)
    levels = []  # of each level: low end and high end of each node's rows, shared bits and their values
    lo, hi, both, any_ = np.arange(n), np.arange(1, n + 1), codes, codes
    owner = groups
    while True:
        levels.append((lo, hi, ~(both ^ any_), both))
        new = np.ones(len(lo), bool)
        new[1:] = owner[1:] != owner[:-1]
        heads = np.flatnonzero(new)
        if len(heads) == len(lo):
            break
        rank = np.arange(len(lo)) - np.repeat(heads, np.diff(np.append(heads, len(lo))))
        cut = np.flatnonzero(rank % _FAN == 0)
        hi = hi[np.append(cut[1:], len(lo)) - 1]
        lo, owner = lo[cut], owner[cut]
        both, any_ = np.bitwise_and.reduceat(both, cut), np.bitwise_or.reduceat(any_, cut)
    top = levels[-1]
    root_of = np.searchsorted(top[0], np.arange(n), side="right") - 1
    queries = np.flatnonzero(top[1][root_of] > np.arange(n) + 1)
    children = [np.searchsorted(levels[k - 1][0], levels[k][0]) for k in range(1, len(levels))]

    def descend(query: np.ndarray, node: np.ndarray, level: int) -> None:
        _, high, shared, value = levels[level]
        near = np.bitwise_count((codes[query] ^ value[node]) & shared[node]) <= radius
        near &= high[node] > query + 1  # a pair is found from its first row
        query, node = query[near], node[near]
        if level == 0:
            fine = (node > query) & (~sided[query] | (sides[query] != sides[node]))
            if fine.any():
                emit(query[fine], node[fine])
            return
        begin = children[level - 1][node]
        end = np.append(children[level - 1], len(levels[level - 1][0]))[node + 1]
        sizes = end - begin
        stops = np.cumsum(sizes)
        at = 0
        while at < len(query):
            upto = max(at + 1, int(np.searchsorted(stops, (stops[at - 1] if at else 0) + _AT_ONCE)))
            part = sizes[at:upto]
            inner = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
            descend(np.repeat(query[at:upto], part), np.repeat(begin[at:upto], part) + inner, level - 1)
            at = upto

    sided = np.zeros(n, bool)
    if n:
        new = np.ones(n, bool)
        new[1:] = groups[1:] != groups[:-1]
        heads = np.flatnonzero(new)
        mixed = np.minimum.reduceat(sides, heads) != np.maximum.reduceat(sides, heads)
        sided = np.repeat(mixed, np.diff(np.append(heads, n)))
    for at in range(0, len(queries), _AT_ONCE):
        query = queries[at : at + _AT_ONCE]
        descend(query, root_of[query], len(levels) - 1)


def _links(radius: int):
    def run(key, table):
        columns = [table.column(c).to_numpy() for c in ("band", "block", "low", "high", "side", "code")]
        band, block, low, high, side = columns[:5]
        codes = columns[5].view(np.uint64)
        # Gray order puts the highest bits first; all rows of a group agree on the bits of the block anyway.
        order = np.lexsort((gray_rank(codes), high, low, block, band))
        band, block, low, high, side, codes = (x[order] for x in (band, block, low, high, side, codes))
        new = np.ones(len(codes), bool)
        new[1:] = (band[1:] != band[:-1]) | (block[1:] != block[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        forest = Forest(len(codes))
        near_pairs(np.cumsum(new), side, codes, radius, forest.union)
        out = np.flatnonzero(forest.root != np.arange(len(codes)))
        signed = codes.view(np.int64)
        return pa.table({"a": pa.array(signed[out]), "b": pa.array(signed[forest.root[out]])})

    return run


def fingerprint_links(codes: DataFrame, radius: int = 3) -> DataFrame:
    """Links (``a``, ``b``) that connect all of the different ``code`` values within ``radius`` bits of each other.

    Links within a task that connect what is connected already are left out, so each code sends four at most.
    """
    if not 0 <= radius <= 3:
        raise ValueError("a radius of 0 to 3 is needed: with four blocks, one then agrees")
    blocks = F.array(*[F.struct(F.lit(k).alias("band"), F.shiftrightunsigned("code", 16 * k).bitwiseAND(F.lit(0xFFFF)).cast("int").alias("block")) for k in range(4)])
    dealt = codes.select("code", F.inline(blocks))
    sizes = dealt.groupBy("band", "block").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    parts = F.ceil(F.col("size") / PART).cast("int")
    n = row_shards(sizes, F.col("size") * parts * _ROW_BYTES)
    part = F.pmod(F.xxhash64("code"), parts).cast("int")
    dealt = dealt.join(sizes, ["band", "block"]).select("band", "block", "code", part.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    dealt = dealt.select("band", "block", "code", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), (F.col("part") > F.col("other")).cast("int").alias("side"))
    shard = F.pmod(F.xxhash64("band", "block", "low", "high"), n).cast("int")
    dealt = dealt.select(shard.alias("shard"), "band", "block", "low", "high", "side", "code")
    run = _links(radius)
    return per_shard(dealt, run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``doc_id``, ``code`` (the fingerprint as a signed long) and ``component_id`` of each row of ``docs`` (``doc_id``, ``text``).

    A-Z are lowered; words are runs of anything but ASCII white space; shingles are ``shingle`` words joined by a space, repeats
    counted; a text of fewer words is one shingle, one without words (or null) has fingerprint zero, which links like any other. A bit is
    set if more than half of the shingles' XXH64 values have it. Rows link at ``radius`` differing bits or fewer.
    ``component_id`` is the smallest ``doc_id`` reachable; rows without id take part, but give a component its name only if it is null
    for all. Repeated rows stay. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)

    def run(batches):
        forget()
        for batch in batches:
            table = pa.Table.from_batches([batch])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(Texts(table), shingle).view(np.int64))], names=["doc_id", "code"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("_id"), F.col("text").alias("_text"))
    schema = StructType([StructField("doc_id", LongType()), StructField("code", LongType())])
    coded = settle(per_batch(narrow, run, schema), "simhash")
    classes = settle(coded.groupBy("code").agg(F.min("doc_id").alias("first")), "simhash_classes")
    roots = components(fingerprint_links(classes.select("code"), radius))
    named = classes.join(roots, F.col("code") == F.col("node"), "left").select("code", "first", F.coalesce("root", "code").alias("root"))
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = settle(named.join(names, "root").select("code", "component_id"), "simhash_named")
    return coded.join(named, "code").select("doc_id", "code", "component_id")


def first_of_groups(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The documents that are the smallest of their component; the columns stay as they are.

    Rows that repeat an id are one document here: the fingerprint of either may link it, and all its rows stay or go. Rows without id stay.
    """
    found = near_duplicates(docs, shingle, radius)
    kept = found.groupBy("doc_id").agg(F.min("component_id").alias("component_id")).where("doc_id = component_id").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.where(F.col("doc_id").isNull()))
