"""Suffix-array dedup: bytes that repeat, over 50 bytes or more, what an earlier document holds.

Suffixes are sorted only as far as the window length, by bucket-pointer refinement: q-gram buckets first, then each bucket
is refined by the bucket pointers of its suffixes at a later offset: of all suffixes at first, and the pointers so found serve
the next refinement; then of the windows' starts alone, offset by offset up to the window length.
Initial buckets are built over sampled suffixes (one in about fourteen; the rarest q-gram of each window, so none is missed);
a bucket of one document is finished at once. What is left is refined in full, shard by shard and part by part (``repeats``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from firmweave.llm.repeats import Tokens, Windows, remove_windows, spans_array
from firmweave.llm.words import ranking

_OUT = StructType(
    [
        StructField("kept", BinaryType()),
        StructField("n_bytes", LongType()),
        StructField("n_removed", LongType()),
        StructField("n_spans", LongType()),
        StructField("spans", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))),
    ]
)


def bucket_pointers(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bucket of each suffix, by keys below ``2 ** bits``: the index of the bucket's last suffix in sorted order."""
    order, ranked = ranking(keys, bits)
    last = np.flatnonzero(np.append(ranked[1:] != ranked[:-1], True)[: len(ranked)])
    out = np.empty(len(keys), np.int32)
    out[order] = np.repeat(last, np.diff(np.append(-1, last)))
    return out


def refine(pointers: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Split the buckets of some suffixes by the pointers ``later``; buckets of one of them stay as they are.

    The parts of a bucket get pointers within its own range, so no pointer meets one of another bucket.
    """
    out = pointers.copy()
    active = np.flatnonzero(np.bincount(pointers)[pointers] > 1)
    if not len(active):
        return out
    mine = pointers[active]
    half = max(int(mine.max()), int(later.max())).bit_length()
    key = mine.astype(np.uint64)
    key <<= np.uint64(half)
    key |= later[active].astype(np.uint64)
    order, ranked = ranking(key, 2 * half)
    bucket = ranked >> np.uint64(half)
    part_last = np.flatnonzero(np.append(ranked[1:] != ranked[:-1], True))
    bucket_last = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True))
    bucket_end = np.repeat(bucket_last, np.diff(np.append(-1, bucket_last)))
    back = np.repeat(bucket_end[part_last] - part_last, np.diff(np.append(-1, part_last)))
    out[active[order]] -= back.astype(np.int32)
    return out


def window_classes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Equal numbers for equal windows ``data[start : start + length]``, exactly. Needs a length of 8 or more.

    Buckets of 5 bytes, which sort in one machine word with their places; all of them are refined while that is less work than
    refining ``starts`` alone once more often.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    five = np.ndarray((len(data),), dtype=">u8", buffer=padded.data, strides=(1,)).astype(np.uint64)
    five >>= np.uint64(24)
    pointers = bucket_pointers(five, 40)
    width = 5
    while width * 5 < length:
        pointers = refine(pointers, np.append(pointers[width:], np.repeat(pointers[-1:], min(width, len(data)))))
        width *= 2
    classes = pointers[starts]
    for offset in [*range(width, length - width, width), length - width]:
        classes = refine(classes, pointers[starts + offset])
    return classes


def _earlier(length: int):
    def compare(tokens: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> np.ndarray:
        spans = lengths - length + 1
        begin = np.cumsum(lengths) - lengths
        starts = np.arange(spans.sum()) + np.repeat(begin - (np.cumsum(spans) - spans), spans)
        classes = window_classes(tokens, starts, length)
        owner = np.repeat(owners, spans)
        least = np.full(len(tokens), np.iinfo(np.int64).max)
        np.minimum.at(least, classes, owner)
        return least[classes] < owner

    return compare


def _render(tokens: Tokens, covered: np.ndarray):
    offsets = tokens.offsets
    spans, n = spans_array(covered, offsets)
    gone = np.cumsum(pc.subtract(spans.values.field(1), spans.values.field(0)).to_numpy())
    before = np.append(0, gone)[spans.offsets.to_numpy()]
    kept = tokens.values[~covered]
    at = offsets - before
    texts = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(kept)])
    return texts.cast(pa.binary()), pa.array(np.diff(offsets)), pa.array(np.diff(before)), pa.array(n, pa.int64()), spans


def _render_characters(tokens: Tokens, covered: np.ndarray):
    heads = np.flatnonzero((tokens.values & 0xC0) != 0x80)
    if len(heads):
        sizes = np.diff(np.append(heads, len(covered)))
        covered = np.repeat(np.logical_or.reduceat(covered, heads), sizes)
    return _render(tokens, covered)


def remove_repeated_bytes(docs: DataFrame, length: int = 50, gram: int = 24, whole_characters: bool = False) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and any others) without repeated bytes.

    A byte goes if a string of ``length`` bytes that covers it also starts in a row with a smaller ``doc_id``. Adds ``kept``
    (the remaining bytes), ``n_bytes``, ``n_removed``, ``n_spans`` and ``spans`` (maximal removed runs, in bytes).

    ``whole_characters`` widens each cut to whole characters.

    Null texts are empty. Rows without id come after all others and are earlier than none. Rows of one id do not make
    each other repeated. Texts shorter than ``length`` stay whole. An empty table gives an empty result. Other columns pass
    through, whatever their names; where one is named like an added column, the added one stays.
    """
    if gram < 8 or length < gram:
        raise ValueError("8 <= gram <= length is needed")
    render = _render_characters if whole_characters else _render
    found = remove_windows(docs, Windows("byte", length, gram), _earlier(length), True, render, _OUT, "suffix_array")
    added = _OUT.names
    others = [F.col("_rest").getField(c).alias(c) for c in docs.columns if c not in ("doc_id", "text", *added)]
    return found.select(F.col("_id").alias("doc_id"), *others, *added)


def clean_texts(docs: DataFrame, length: int = 50) -> DataFrame:
    """The columns of ``docs`` with repeated bytes taken out of ``text``; ``n_chars``, if there, counted anew.

    A character of which a byte is removed goes as a whole, so texts stay UTF-8. A null text stays null. All other columns come
    through with their values, whatever their names. An empty table gives an empty result.
    """
    safe = {c: f"_column{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    marked = docs.toDF(*[safe.get(c, c) for c in docs.columns]).withColumn("_null", F.col("text").isNull())
    found = remove_repeated_bytes(marked, length, whole_characters=True)
    text = F.when(~F.col("_null"), F.col("kept").cast("string"))
    columns = {c: text if c == "text" else F.col(safe.get(c, c)) for c in docs.columns}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.coalesce(F.char_length(text), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return found.select(*[value.alias(c) for c, value in columns.items()])
