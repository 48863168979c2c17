"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, each text scanned once.

Normalising (ASCII lower case, every separator byte a space) keeps byte offsets; only runs of spaces are closed up, and the places of words
lead back to bytes of the original. Window and text carry a space on both ends, so matches begin and end at words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from firmweave.llm.tables import Texts, bound_batches, per_batch, settle
from firmweave.llm.words import word_bounds

# Bytes of windows in one automaton (times about 60 in memory) and broadcast; larger benchmarks take several passes.
SHARD_BYTES = 2 << 20

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
# Separators, after lower-casing, become spaces.
_NORMAL = bytes(0x20 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in _LOWER)
_SPACE = np.zeros(256, bool)
_SPACE[0x20] = True


@dataclass(frozen=True)
class Shard:
    """Windows of some items: ``items[k]`` are the indices in ``names`` of the items that hold ``windows[k]``."""

    windows: list[str]
    items: list[list[int]]
    names: list[str]


def item_windows(text: str | None, size: int) -> set[str]:
    """Distinct windows of an item, as normalised bytes read as Latin-1, with a space on both ends."""
    words = [w.decode("latin-1") for w in (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split(b" ") if w]
    if not words:
        return set()
    return {f" {' '.join(words[i : i + size])} " for i in range(max(1, len(words) - size + 1))}


def shards_of(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> Iterator[Shard]:
    """The items in shards of bounded size; the driver holds one shard at a time."""
    found: dict[str, list[int]] = {}
    names: list[str] = []
    filled = 0
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text_col)).where(F.col(text_col).isNotNull() & F.col(item_col).isNotNull())
    for name, text in rows.toLocalIterator():
        windows = item_windows(text, size)
        names.append(name)
        for w in windows:
            found.setdefault(w, []).append(len(names) - 1)
            filled += len(w)
        if filled > SHARD_BYTES:
            yield Shard(list(found), list(found.values()), names)
            found, names, filled = {}, [], 0
    if found:
        yield Shard(list(found), list(found.values()), names)


def _automaton(shard: Shard) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, window in enumerate(shard.windows):
        automaton.add_word(window, k)
    automaton.make_automaton()
    return automaton


def scan(texts: Texts, automaton: ahocorasick.Automaton, shard: Shard) -> tuple[np.ndarray, np.ndarray, dict[int, set[str]], np.ndarray, np.ndarray]:
    """Word numbers at which texts begin, which words are hit, the item names found by text number, and where words begin and end in bytes.

    The normal form of each text is a newline, which no window holds, then its words with a space before and after each.
    """
    normal = np.frombuffer(texts.data.tobytes().translate(_NORMAL), np.uint8)
    starts, ends, at = word_bounds(normal, texts.offsets, _SPACE)
    n = len(starts)
    found: dict[int, set[str]] = {}
    if not n:
        return at, np.zeros(0, bool), found, starts, ends
    heads = at[:-1][np.diff(at) > 0]
    opening = np.zeros(n, np.int64)
    opening[heads] = 2
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    place = before + np.arange(n) + np.cumsum(opening)
    out = np.full(int(place[-1] + lengths[-1] + 1), 0x20, np.uint8)
    out[place[heads] - 2] = 0x0A
    inner = np.arange(lengths.sum()) - np.repeat(before, lengths)
    out[np.repeat(place, lengths) + inner] = normal[np.repeat(starts, lengths) + inner]
    ends_at, kinds = [], []
    for end, k in automaton.iter(out.tobytes().decode("latin-1")):
        ends_at.append(end)
        kinds.append(k)
    hit = np.zeros(n + 1, np.int32)
    if kinds:
        last = np.searchsorted(place + lengths, np.array(ends_at))
        sizes = np.array([w.count(" ") - 1 for w in shard.windows])[kinds]
        np.add.at(hit, last - sizes + 1, 1)
        np.add.at(hit, last + 1, -1)
        owner = np.searchsorted(at, last, side="right") - 1
        for doc, k in set(zip(owner.tolist(), kinds, strict=True)):
            found.setdefault(doc, set()).update(shard.names[i] for i in shard.items[k])
    return at, np.cumsum(hit[:-1]) > 0, found, starts, ends


_SPAN = ["start", "end", "from_byte", "to_byte"]
_SPANS = ArrayType(StructType([StructField(c, LongType()) for c in _SPAN]))
_ADDED = StructType(
    [
        StructField("n_words", LongType()),
        StructField("n_hit", LongType()),
        StructField("items", ArrayType(StringType())),
        StructField("spans", _SPANS),
    ]
)


def _merge(spans: list, more: list) -> list:
    """Spans (first word, word after, first byte, byte after) of both lists, those that meet as one."""
    out: list = []
    for span in sorted(spans + more):
        if out and span[0] <= out[-1][1]:
            if span[1] > out[-1][1]:
                out[-1][1], out[-1][3] = span[1], span[3]
        else:
            out.append(list(span))
    return out


def _pass(docs: DataFrame, shard: Shard) -> DataFrame:
    """One scan of all texts; adds to what earlier scans have found. Spans are merged where they meet."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(shard)
    held: list = []

    def run(batches):
        if not held:
            held.append(_automaton(sent.value))
        for batch in batches:
            table = pa.Table.from_batches([batch])
            texts = Texts(table)
            at, hit, found, word_from, word_to = scan(texts, held[0], sent.value)
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
            begin, finish = edge[::2], edge[1::2]
            spans: list[list] = [[] for _ in range(len(texts))]
            for s, e in zip(begin.tolist(), finish.tolist(), strict=True):
                doc = int(np.searchsorted(at, s, side="right") - 1)
                while s < e:  # a run of hits may go on into the next text
                    stop = min(e, int(at[doc + 1]))
                    if stop > s:
                        first, text_at = int(at[doc]), int(texts.offsets[doc])
                        spans[doc].append([s - first, stop - first, int(word_from[s]) - text_at, int(word_to[stop - 1]) - text_at])
                    s, doc = stop, doc + 1
            before = [[[x[c] for c in _SPAN] for x in v] for v in table.column("_spans").to_pylist()]
            spans = [_merge(b, s) for b, s in zip(before, spans, strict=True)]
            names = [sorted(set(x) | found.get(k, set())) for k, x in enumerate(table.column("_items").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_text"),
                    pa.array(np.diff(at)),
                    pa.array(names, pa.list_(pa.string())),
                    pa.array([[dict(zip(_SPAN, x, strict=True)) for x in s] for s in spans], pa.list_(pa.struct([(c, pa.int64()) for c in _SPAN]))),
                    batch.column("_rest"),
                ],
                names=["_id", "_text", "_words", "_items", "_spans", "_rest"],
            )

    return per_batch(docs, run, docs.schema)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``docs`` with the benchmark windows found in ``text``.

    Words are runs of bytes other than ASCII non-alphanumerics, A-Z in lower case. A window is ``size`` consecutive words of an item; an
    item of fewer words is one window. Adds ``n_words``, ``n_hit`` (words inside any occurrence), ``items`` (ids of items that
    have an occurring window, as strings, sorted) and ``spans``: hit ranges as word numbers (``start`` to before ``end``) and as offsets
    in the UTF-8 bytes of the original text (``from_byte`` to before ``to_byte``).

    Null texts have no words; items without id, text or words have no windows; repeated items count under each id; an empty
    benchmark hits nothing. Each row of ``docs`` stays one row; other columns pass through, added ones win over their namesakes.
    """
    bound_batches(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    state = docs.select(
        F.col("doc_id").alias("_id"),
        F.col("text").alias("_text"),
        F.lit(0).cast("bigint").alias("_words"),
        F.array().cast("array<string>").alias("_items"),
        F.array().cast(_SPANS).alias("_spans"),
        rest.alias("_rest"),
    )
    passes = 0
    for shard in shards_of(benchmark, item_col, item_text, size):
        if passes:
            state = settle(state, "decontaminate")
        state = _pass(state, shard)
        passes += 1
    if not passes:
        state = _pass(state, Shard(["\0"], [[]], []))
    hits = F.aggregate("_spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    added = _ADDED.names
    return state.select(
        F.col("_id").alias("doc_id"),
        F.col("_text").alias("text"),
        *[F.col("_rest").getField(c).alias(c) for c in others if c not in added],
        F.col("_words").alias("n_words"),
        hits.alias("n_hit"),
        F.col("_items").alias("items"),
        F.col("_spans").alias("spans"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """Documents without any hit; the others go. Columns stay as they are."""
    safe = {c: f"_column{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    found = find_contamination(docs.toDF(*[safe.get(c, c) for c in docs.columns]), benchmark, size).where(F.col("n_hit") == 0)
    return found.select(*[F.col(safe.get(c, c)).alias(c) for c in docs.columns])
