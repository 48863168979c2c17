"""Ranked lexical search over a length-stratified index.

The score of a term in a document depends on its count tf and on the document's length normaliser m alone, times the term's weight. So
documents are grouped by equal m into *strata* (large ones in several blocks), and a stratum's postings lie by (term, tf): an *impact* is
computed once per tf of a stratum, whatever the number of its documents. A stratum's greatest counts bound what any of its
documents can score for an item; strata are visited by falling bound, and those that cannot reach the k-th best score so far are passed over.

1. One scan of the texts counts the terms that items ask for, and all terms of each text (a *forward* row, written once).
2. From these rows follow the corpus statistics, the normalisers, and the index, one row a block of a stratum.
3. Pilot: for each item the few strata of greatest bound are scored; the k-th best score found is a floor for that item.
4. All strata whose bound reaches the floor are scored, each task in the order of bounds and raising its floors as it goes.

Items are taken in blocks of bounded size, one scan a block; only what belongs to a block's items (terms, weights, floors) is sent to tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from firmweave.llm.tables import bound_batches, per_batch, settle

# Bytes of the terms of a block of items.
ITEM_BYTES = 4 << 20
# Documents of a block of a stratum; strata of an item's pilot; text bytes split at once; sums made at once; strata of several blocks that may be broadcast. Layout only.
STRATUM_DOCS = 4096
PILOT = 16
SLICE = 1 << 20
_AT_ONCE = 1 << 20
LARGE_STRATA = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Bytes of no term become spaces, A-Z are lowered; bytes of longer characters stay.
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_NO_ID = np.iinfo(np.int64).max


class Items:
    """The items of a block: their terms as numbers, one after the other."""

    def __init__(self, rows: list[tuple[object, list[str]]]):
        self.ids = [i for i, _ in rows]
        self.vocabulary: dict[bytes, int] = {}
        flat, sizes = [], []
        for _, terms in rows:
            sizes.append(len(terms))
            for term in terms:
                flat.append(self.vocabulary.setdefault(term.encode("utf-8"), len(self.vocabulary)))
        self.terms = np.array(flat, np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.item = np.repeat(np.arange(len(rows)), sizes)

    def __len__(self) -> int:
        return len(self.ids)


def item_blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[Items]:
    """The items that have terms, in blocks of about ITEM_BYTES of terms. Rows that share an id are one item with the terms of all."""
    lowered = F.translate(F.col(f"`{text_col}`"), _UPPER, _LOWER)
    terms = items.select(F.col(f"`{item_col}`").alias("item"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term")).distinct()
    terms = settle(terms, "search_terms")
    size = terms.agg(F.coalesce(F.sum(F.length(F.col("term").cast("binary")) + 8), F.lit(0))).first()[0]
    blocks = max(1, -(-size // ITEM_BYTES))
    for b in range(blocks):
        mine = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        rows = mine.groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms")).orderBy("item").collect()
        if rows:
            yield Items([(r["item"], r["terms"]) for r in rows])


def _small(values: np.ndarray) -> bytes:
    """Numbers in as few bytes as the largest needs, after a byte that tells how many."""
    top = int(values.max(initial=0))
    size = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _wide(data) -> np.ndarray:
    raw = bytes(data)
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _slices(data: bytes) -> Iterator[bytes]:
    """Normal text in pieces of bounded size that end at a space."""
    at = 0
    while len(data) - at > SLICE:
        cut = data.find(b" ", at + SLICE)
        if cut < 0:
            break
        yield data[at:cut]
        at = cut
    yield data[at:]


def count_terms(texts: list[str | None], vocabulary: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and (text number, vocabulary number, count) of those in ``vocabulary``, sorted."""
    get, size = vocabulary.get, len(vocabulary)
    n = np.zeros(len(texts), np.int64)
    keys, counts = [], []
    waiting, owners = [], []

    def flush():
        found = np.fromiter(map(get, chain.from_iterable(waiting), repeat(-1)), np.int64, sum(map(len, waiting)))
        text = np.repeat(np.array(owners, np.int64), [len(w) for w in waiting])
        known = found >= 0
        k, c = np.unique(text[known] * size + found[known], return_counts=True)
        keys.append(k)
        counts.append(c)
        waiting.clear()
        owners.clear()

    held = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        for piece in _slices(text.encode("utf-8", "surrogatepass").translate(_NORMAL)):
            words = piece.split()
            n[i] += len(words)
            waiting.append(words)
            owners.append(i)
            held += len(piece)
            if held > SLICE:
                flush()
                held = 0
    if waiting:
        flush()
    if not keys:
        none = np.zeros(0, np.int64)
        return n, none, none, none
    flat, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate(counts), minlength=len(flat)).astype(np.int64)
    return n, flat // size, flat % size, total


def forward_rows(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id``, ``n`` (terms), ``terms`` and ``counts`` (packed) of each text that has terms."""
    schema = "doc_id bigint, n bigint, terms binary, counts binary"

    def run(batches):
        for batch in batches:
            n, text, term, count = count_terms(batch.column(1).to_pylist(), vocabulary)
            some = np.flatnonzero(n > 0)
            cut = np.searchsorted(text, np.append(some, len(n)))
            # Texts without terms lie between: their ranges are empty.
            ranges = [(int(a), int(np.searchsorted(text, i + 1))) for a, i in zip(cut[:-1], some, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(some)),
                    pa.array(n[some]),
                    pa.array([_small(term[a:b]) for a, b in ranges], pa.binary()),
                    pa.array([_small(count[a:b]) for a, b in ranges], pa.binary()),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    return per_batch(narrow, run, schema)


def document_counts(forward: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each of ``size`` terms; tasks send one row a term."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total[_wide(packed.as_buffer())] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    rows = per_batch(forward.select("terms"), run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    for r in rows:  # at most one a term of the block
        out[r["term"]] = r["n"]
    return out


def weights(documents: int, holding: np.ndarray) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding], np.int64)


def impacts(counts: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * counts) // (1000 * counts + 20 * m)


_INDEX = "m bigint, block bigint, docs binary, terms binary, tops binary, group_terms binary, group_counts binary, group_sizes binary, postings binary"


def _stratum(key, table: pa.Table) -> pa.Table:
    """One row of the index: documents in order of id, postings by term and falling tf."""
    ids = table.column("doc_id").combine_chunks().fill_null(_NO_ID).to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    terms = [_wide(table.column("terms")[int(i)].as_buffer()) for i in order]
    counts = [_wide(table.column("counts")[int(i)].as_buffer()) for i in order]
    doc = np.repeat(np.arange(len(order)), [len(t) for t in terms])
    term, count = np.concatenate(terms), np.concatenate(counts)
    by = np.lexsort((doc, -count, term))
    term, count, doc = term[by], count[by], doc[by]
    new = np.ones(len(term), bool)
    new[1:] = (term[1:] != term[:-1]) | (count[1:] != count[:-1])
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(term)))
    group_term, group_count = term[heads], count[heads]
    first = np.ones(len(heads), bool)
    first[1:] = group_term[1:] != group_term[:-1]
    packed = [ids[order].astype(np.int64).tobytes(), _small(group_term[first]), _small(group_count[first]), *map(_small, (group_term, group_count, sizes, doc))]
    names = ["docs", "terms", "tops", "group_terms", "group_counts", "group_sizes", "postings"]
    head = {"m": pa.array([key[0].as_py()], pa.int64()), "block": pa.array([key[1].as_py()], pa.int64())}
    return pa.table(head | {c: pa.array([v], pa.binary()) for c, v in zip(names, packed, strict=True)})


def build_index(forward: DataFrame, documents: int, terms: int) -> DataFrame:
    """The index of the ``forward`` rows: one row for each block of a stratum."""
    m = F.lit(50) + F.expr(f"(50 * n * {documents}L) div {max(1, terms)}L")
    asked = forward.where(F.length("terms") > 1).select("doc_id", m.alias("m"), "terms", "counts", F.monotonically_increasing_id().alias("row"))
    sizes = asked.groupBy("m").agg(F.ceil(F.count(F.lit(1)) / STRATUM_DOCS).cast("bigint").alias("blocks"))
    # Only strata of several blocks need to know how many; a stratum is a length, so they are few, but that is checked.
    large = settle(sizes.where("blocks > 1"), "search_strata")
    joined = asked.join(F.broadcast(large) if large.count() <= LARGE_STRATA else large, "m", "left")
    block = F.pmod(F.xxhash64("row"), F.coalesce("blocks", F.lit(1)).cast("bigint"))
    # Dealt by both, whatever the join has dealt by: a hot stratum must not stay in one task.
    dealt = joined.select("doc_id", "m", block.alias("block"), "terms", "counts").repartition("m", "block")
    return dealt.groupBy("m", "block").applyInArrow(lambda key, rows: _stratum(key, rows), _INDEX)


class Scorer:
    """Scores of a block's items in strata, with the k best of each item so far."""

    def __init__(self, items: Items, weight: np.ndarray, k: int, floors: np.ndarray):
        self.items, self.weight, self.k = items, weight, k
        self.floors = floors.copy()
        self.best: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(len(items))]
        self.size = len(items.vocabulary)

    def bounds(self, m: int, terms, tops) -> np.ndarray:
        """What no document of a stratum can exceed, for each item."""
        most = np.zeros(self.size, np.int64)
        numbers = _wide(terms)
        most[numbers] = np.maximum(self.weight[numbers], 0) * impacts(_wide(tops), m)
        # Each item has a term at least.
        return np.add.reduceat(most[self.items.terms], self.items.offsets[:-1])

    def score(self, row: dict, wanted: np.ndarray) -> None:
        """Score the items numbered ``wanted`` in a stratum."""
        m = row["m"]
        ids = np.frombuffer(row["docs"], np.int64)
        group_term, group_count, group_size, posting = (_wide(row[c]) for c in ("group_terms", "group_counts", "group_sizes", "postings"))
        # One impact a tf.
        tfs, which = np.unique(group_count, return_inverse=True)
        value = np.repeat(impacts(tfs, m)[which] * self.weight[group_term], group_size).astype(np.float64)  # below 2 ** 53: exact
        stops = np.cumsum(group_size)
        first = np.searchsorted(group_term, np.arange(self.size))
        after = np.searchsorted(group_term, np.arange(self.size), side="right")
        bound = np.concatenate([[0], stops])
        begin, end = bound[first], bound[after]
        d = len(ids)
        sizes = np.add.reduceat((end - begin)[self.items.terms], self.items.offsets[:-1])
        at = 0
        while at < len(wanted):
            filled = np.cumsum(sizes[wanted[at:]] + d)
            upto = at + max(1, int(np.searchsorted(filled, _AT_ONCE, side="right")))
            part = wanted[at:upto]
            spans = [np.arange(self.items.offsets[q], self.items.offsets[q + 1]) for q in part]
            local = np.repeat(np.arange(len(part)), [len(s) for s in spans])
            terms = self.items.terms[np.concatenate(spans)]
            lengths = end[terms] - begin[terms]
            flat = np.repeat(begin[terms], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            scores = np.bincount(np.repeat(local, lengths) * d + posting[flat], weights=value[flat], minlength=len(part) * d).reshape(len(part), d)
            for q, own in zip(part.tolist(), scores, strict=True):
                self._offer(q, own, ids)
            at = upto

    def _offer(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero(scores >= max(1, self.floors[q]))
        if not len(good):
            return
        self.best[q].append((scores[good].astype(np.int64), ids[good]))
        if sum(len(s) for s, _ in self.best[q]) >= self.k:
            self._cut(q)

    def _cut(self, q: int) -> None:
        scores, ids = (np.concatenate(x) for x in zip(*self.best[q], strict=True))
        order = np.lexsort((ids, -scores))[: self.k]
        self.best[q] = [(scores[order], ids[order])]
        if len(order) == self.k:
            self.floors[q] = max(self.floors[q], scores[order[-1]])

    def found(self) -> pa.RecordBatch:
        columns = [[], [], []]
        for q, parts in enumerate(self.best):
            if parts:
                self._cut(q)
                scores, ids = self.best[q][0]
                for column, values in zip(columns, (np.full(len(ids), q), ids, scores), strict=True):
                    column.append(values)
        flat = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(flat[0].astype(np.int64)), pa.array(flat[1], mask=flat[1] == _NO_ID), pa.array(flat[2])], names=["item", "doc_id", "score"])


_FOUND = "item bigint, doc_id bigint, score bigint"


def _pilot(index: DataFrame, items: Items, weight: np.ndarray) -> DataFrame:
    """``m``, ``block`` and ``wanted``: for each item its strata of greatest bound."""

    def run(batches):
        scorer = Scorer(items, weight, 1, np.zeros(len(items), np.int64))
        held = np.zeros((0, len(items)), np.int64)
        names = np.zeros((0, 2), np.int64)
        for batch in batches:
            rows = batch.to_pylist()
            more = np.array([scorer.bounds(r["m"], r["terms"], r["tops"]) for r in rows]).reshape(len(rows), len(items))
            held, names = np.concatenate([held, more]), np.concatenate([names, np.array([(r["m"], r["block"]) for r in rows]).reshape(-1, 2)])
            if len(held) > PILOT:  # keep each item's best strata only
                top = np.unique(np.argpartition(-held, PILOT - 1, axis=0)[:PILOT])
                held, names = held[top], names[top]
        at, item = np.nonzero(held > 0)
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(names[at, 0]), pa.array(names[at, 1]), pa.array(held[at, item])], names=["item", "m", "block", "bound"])

    bounds = per_batch(index.select("m", "block", "terms", "tops"), run, "item bigint, m bigint, block bigint, bound bigint")
    by = Window.partitionBy("item").orderBy(F.desc("bound"), "m", "block")
    chosen = bounds.withColumn("place", F.row_number().over(by)).where(F.col("place") <= PILOT)
    return chosen.groupBy("m", "block").agg(F.collect_list("item").alias("wanted"))


def _scored(index: DataFrame, items: Items, weight: np.ndarray, k: int, floors: np.ndarray) -> DataFrame:
    """The k best of each item in each task's strata. Rows with ``wanted`` are scored for those items, others for all whose floor the bound reaches."""

    def run(batches):
        scorer = Scorer(items, weight, k, floors)
        for batch in batches:
            rows = batch.to_pylist()
            if "wanted" in batch.schema.names:
                for row in rows:
                    scorer.score(row, np.array(row["wanted"], np.int64))
                continue
            bounds = [scorer.bounds(r["m"], r["terms"], r["tops"]) for r in rows]
            for i in sorted(range(len(rows)), key=lambda i: -int(bounds[i].max())):
                wanted = np.flatnonzero(bounds[i] >= np.maximum(scorer.floors, 1))
                if len(wanted):
                    scorer.score(rows[i], wanted)
        yield scorer.found()

    return per_batch(index, run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def _search(spark: SparkSession, forward: DataFrame, items: Items, k: int) -> DataFrame:
    documents, terms = forward.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = weights(documents, document_counts(forward, len(items.vocabulary)))
    index = settle(build_index(forward, documents, terms), "search_index")
    none = np.zeros(len(items), np.int64)
    # At most PILOT strata an item of the block.
    pilot = index.join(F.broadcast(_pilot(index, items, weight)), ["m", "block"])
    floors = none.copy()
    for r in _ranked(_scored(pilot, items, weight, k, none), k).where(F.col("rank") == k).select("item", "score").collect():
        floors[r["item"]] = r["score"]  # one an item of the block
    return _ranked(_scored(index, items, weight, k, floors), k)


def search(docs: DataFrame, items: DataFrame, k: int = 50, item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` best rows of ``docs`` (``doc_id``, ``text``) for each item: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Terms are runs of letters, digits and non-ASCII characters of the whole text, A-Z lowered. The score sums, over the item's different terms,
    weight times impact (``weights``, ``impacts``; a document's m is 50 + (50 n N) div L). Only scores above 0 count; equal ones go by ascending
    ``doc_id``, rows without id last. Results are exact: bounds only pass over what cannot be among the best.

    Null and empty texts have no terms and are no documents in the statistics. Rows that repeat an id are ranked one by one. Items that share
    an id are one item with the terms of all; items without terms have no rows; a null item id is an item. Other columns are not
    read. An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    kind = items.schema[item_col].dataType
    out = None
    for block in item_blocks(items, item_col, item_text):
        forward = settle(forward_rows(docs, block.vocabulary), "search_forward")
        ranked = _search(spark, forward, block, k)
        names = spark.createDataFrame(list(enumerate(block.ids)), StructType([StructField("item", LongType()), StructField(item_col, kind)]))
        part = ranked.join(F.broadcast(names), "item").select(item_col, F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        schema = StructType([StructField(item_col, kind), StructField("rank", IntegerType()), StructField("doc_id", LongType()), StructField("score", LongType())])
        return spark.createDataFrame([], schema)
    return out
