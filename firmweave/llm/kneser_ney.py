"""Language-model scoring: an interpolated modified Kneser-Ney n-gram model, counted in Spark.

Each level of the model is a table of sorted hash arrays with counts, one row a shard of hashes. A shard task counts what
all chunks of texts send it, stores its arrays, maps the file into memory and answers the chunks from it. The level below needs, of each
n-gram, its suffix and its context; only one chunk among those that hold an n-gram (its *owner*) adds it to them, so
texts, not hashes, tell what they are. No key is sent more than once by a chunk, however frequent.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from firmweave.llm.repeats import grams_of
from firmweave.llm.tables import Texts, chunk_table, cuts, pack_sorted, per_chunk, per_chunk_with, per_shard, settle, shard_of, text_shards, unpack_sorted
from firmweave.llm.words import WHITE, distinct, mix, ranking, word_bounds, word_hashes

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_BEGIN, _END = np.uint64(0xB0D1E5), np.uint64(0xE7D)
# Bits of a hash: at 10 ** 13 different n-grams about one in ten thousand shares its hash.
_DROP = np.uint64(8)
_BITS = 56
_CHUNK = 12 << 20

_FIELDS = ("count", "raw", "total", "n1", "n2", "n3")
_ASK = "shard int, _chunk bigint, hashes binary, " + ", ".join(f"{f} binary" for f in _FIELDS)
_TOLD = "kind string, shard int, _chunk bigint, hashes binary, owner binary, " + ", ".join(f"{f} binary" for f in _FIELDS) + ", stats array<bigint>"


class Grams:
    """Token sequences of a chunk: ``order - 1`` begins, the words, one end for each text."""

    def __init__(self, table: pa.Table, order: int):
        self.texts = texts = Texts(table)
        self.held_out = table.column("_rest").combine_chunks().field("held_out").to_numpy(zero_copy_only=False).astype(bool)
        data = np.frombuffer(texts.data.tobytes().translate(_LOWER), np.uint8)
        starts, ends, at = word_bounds(data, texts.offsets, WHITE)
        words = np.diff(at)
        pad = order - 1
        begin = np.concatenate([[0], np.cumsum(words + 1 + pad)])
        self.flat = np.full(int(begin[-1]), _BEGIN, np.uint64)
        self.flat[np.arange(len(starts)) + np.repeat(begin[:-1] + pad - at[:-1], words)] = word_hashes(data, starts, ends)
        self.flat[begin[1:] - 1] = _END
        self.n_tokens = words + 1
        real = np.ones(len(self.flat), bool)
        if pad:
            real[(begin[:-1, None] + np.arange(pad)).ravel()] = False
        self.real = real
        self.at = np.flatnonzero(real)  # tokens to be scored, text by text
        self.train = np.repeat(~self.held_out, self.n_tokens)
        self.heads = np.cumsum(self.n_tokens) - self.n_tokens

    def ending(self, k: int, at: np.ndarray) -> np.ndarray:
        """Hashes of the k-grams that end at places ``at``."""
        if k == 1:
            return mix(self.flat[at]) >> _DROP
        return mix(grams_of(self.flat, k)[at - k + 1]) >> _DROP

    def level(self, k: int, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different k-grams of the chunk, the number of each token's k-gram, and of its context (k-gram before it)."""
        if k == order:
            keys, own = distinct(self.ending(k, self.at), _BITS)
            return keys, own, own
        # A text begins with more begins than a context has tokens, so no gram reaches into the text before. The context of a token
        # ends where the token before it ends: only those of first tokens are places of their own.
        used = self.real.copy()
        used[self.at[self.heads] - 1] = True
        keys, inverse = distinct(self.ending(k, np.flatnonzero(used)), _BITS)
        own = (np.cumsum(used) - 1)[self.at]
        return keys, inverse[own], inverse[own - 1]


def _rows(key, keys: np.ndarray, columns: dict[str, np.ndarray], n_shards: int) -> pa.Table:
    at = cuts(shard_of(keys << _DROP, n_shards), n_shards)
    used = np.flatnonzero(np.diff(at))
    parts = [slice(at[s], at[s + 1]) for s in used]
    out = {"shard": pa.array(used, pa.int32()), "_chunk": pa.array(np.full(len(used), key[0].as_py()), pa.int64())}
    out["hashes"] = pa.array([pack_sorted(keys[x]) for x in parts], pa.binary())
    for f in _FIELDS:
        column = columns.get(f)
        out[f] = pa.array([b"" if column is None else _small(column[x]) for x in parts], pa.binary())
    return pa.table(out)


def _small(values: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest needs."""
    top = int(values.max(initial=0))
    size = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _wide(data) -> np.ndarray:
    raw = bytes(data)
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def _ask_top(order: int, n_shards: int):
    def ask(key, table):
        g = Grams(table, order)
        keys, own, _ = g.level(order, order)
        count = np.bincount(own, weights=g.train, minlength=len(keys)).astype(np.int64)
        return _rows(key, keys, {"count": count} | ({"raw": count} if order == 1 else {}), n_shards)

    return ask


def _told_level(k: int, told: pa.Table, fields: tuple[str, ...]) -> dict[str, np.ndarray]:
    """What the shards told of each k-gram of the chunk, in the order of ``level``."""
    rows = np.flatnonzero(told.column("level").to_numpy() == k)
    order = rows[np.argsort(told.column("shard").to_numpy()[rows])].tolist()
    columns = {f: told.column(f) for f in fields}
    return {f: np.concatenate([_wide(c[i].as_buffer()) for i in order]) if order else np.zeros(0, np.int64) for f, c in columns.items()}


def _ask_lower(k: int, order: int, n_shards: int):
    def ask(key, table, told):
        g = Grams(table, order)
        _, upper, _ = g.level(k + 1, order)
        above = _told_level(k + 1, told, ("count", "owner"))
        keys, own, context = g.level(k, order)
        sample = np.full(len(above["count"]), -1)
        sample[upper] = np.arange(len(upper))
        mine = np.flatnonzero((above["owner"] > 0) & (above["count"] > 0) & (sample >= 0))
        where, count = sample[mine], above["count"][mine]
        size = len(keys)
        columns = {"count": np.bincount(own[where], minlength=size), "total": np.bincount(context[where], weights=count, minlength=size).astype(np.int64)}
        for c, f in ((1, "n1"), (2, "n2"), (3, "n3")):
            right = count == c if c < 3 else count >= c
            columns[f] = np.bincount(context[where[right]], minlength=size)
        if k == 1:
            columns["raw"] = np.bincount(own, weights=g.train, minlength=size).astype(np.int64)
        return _rows(key, keys, columns, n_shards)

    return ask


def _store(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and their counts as files of the worker, mapped into memory."""
    with tempfile.TemporaryDirectory() as folder:
        out = []
        for name, array in (("hashes", keys), ("values", values)):
            path = os.path.join(folder, f"{name}.npy")
            np.save(path, array)
            out.append(np.load(path, mmap_mode="r") if array.size else array)
        return out[0], out[1]  # mapped files stay readable after they are unlinked


def _answer(key, table):
    hashes = [unpack_sorted(x.as_buffer()) for x in table.column("hashes")]
    sizes = [len(h) for h in hashes]
    flat = np.concatenate(hashes)
    order, ranked = ranking(flat, _BITS)
    heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    sent, columns = [], []  # a level sends the same fields from every chunk
    for f in _FIELDS:
        got = [x.as_buffer() for x in table.column(f)]
        if any(raw is not None and raw.size for raw in got):
            sent.append(f)
            columns.append(np.concatenate([_wide(raw) if raw is not None and raw.size else np.zeros(n, np.int64) for raw, n in zip(got, sizes, strict=True)]))
    keys, values = _store(ranked[heads], np.stack([np.add.reduceat(c[order], heads) for c in columns]))
    known = dict(zip(sent, map(np.asarray, values), strict=True))
    # The owner: the first chunk in which the n-gram counts.
    place = np.arange(len(flat))
    place[columns[0] == 0] = len(flat)
    first = np.minimum.reduceat(place[order], heads)
    owner = np.zeros(len(flat), np.uint8)
    owner[first[first < len(flat)]] = 1
    count, raw = known["count"], known.get("raw", np.zeros(0, np.int64))
    near = [int((count == c).sum()) for c in (1, 2, 3, 4)]
    stats = [*near, int((count >= 3).sum()), int(count.sum()), int(raw.sum()), int((raw > 0).sum())]
    out: dict[str, list] = {f: [] for f in ("kind", "_chunk", "hashes", "owner", *_FIELDS, "stats")}

    def put(kind, chunk, packed, owners, rows, told=None):
        for f, v in zip(out, (kind, chunk, packed, owners, *[b"" if r is None else _small(r) for r in rows], told), strict=True):
            out[f].append(v)

    put("stats", None, b"", b"", [None] * len(_FIELDS), stats)
    rank = np.empty(len(flat), np.int64)
    rank[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(flat))))
    end = 0
    for h, chunk in zip(hashes, table.column("_chunk").to_pylist(), strict=True):
        at = rank[end : end + len(h)]
        put("told", chunk, b"", _small(owner[end : end + len(h)]), [known[f][at] if f in known else None for f in _FIELDS])
        end += len(h)
    types = {"kind": pa.string(), "_chunk": pa.int64(), "stats": pa.list_(pa.int64())}
    made = {f: pa.array(v, types.get(f, pa.binary())) for f, v in out.items()}
    shard = pa.array([key[0].as_py()] * len(out["kind"]), pa.int32())
    return pa.table({"kind": made.pop("kind"), "shard": shard, **made})


def discounts(near: list[int]) -> list[float]:
    """D1, D2, D3+ from the numbers of n-grams that count 1, 2, 3 and 4; a half of the count where they do not exist."""
    n1, n2, n3, n4 = near
    if not n1 or not n2:
        return [0.5, 0.75, 1.0]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), 0.95 * c) for d, c in zip(raw, (1, 2, 3), strict=True)]


def _score(order: int, n_shards: int, stats: dict[int, list[int]], schema: StructType):
    cut = {k: discounts(s[:4]) for k, s in stats.items()}
    vocabulary, tokens = stats[1][7], stats[1][6]

    def run(key, table, told):
        g = Grams(table, order)
        p = np.full(len(g.at), 1.0 / (vocabulary + 1))
        context = None
        for k in range(1, order + 1):
            d = cut[k]
            _, own, before = g.level(k, order)
            here = _told_level(k, told, ("count", *(("raw",) if k == 1 else ()), *(("total", "n1", "n2", "n3") if k < order else ())))
            # Sums of a k-gram and of a context are made once each, then looked up by token.
            c = here["count"]
            left = np.maximum(c - np.array([0.0, *d])[np.minimum(c, 3)], 0)[own]
            if k == 1:
                s = stats[1]
                total, spare = np.full(len(own), float(s[5])), d[0] * s[0] + d[1] * s[1] + d[2] * s[4]
                known = total > 0
                safe = np.where(known, total, 1.0)
                share = spare / safe
                raw = here["raw"][own]
            else:
                total = context["total"].astype(float)
                spare = d[0] * context["n1"] + d[1] * context["n2"] + d[2] * context["n3"]
                safe = np.where(total > 0, total, 1.0)
                known, share, safe = (total > 0)[at], (spare / safe)[at], safe[at]
            p = np.where(known, left / safe + share * p, p)
            context, at = here, before

        def by_text(x):
            return np.add.reduceat(x, g.heads) if len(g.heads) else x

        base = np.log10((raw + 1) / (tokens + vocabulary + 1))
        made = [table.column("_id"), pa.array(g.held_out), pa.array(g.n_tokens), pa.array(by_text((raw > 0).astype(np.int64))), pa.array(by_text(base)), pa.array(by_text(np.log10(p)))]
        return pa.table([*made, table.column("_rest")], names=schema.names)

    return run


def score_texts(docs: DataFrame, held_out: Column, order: int = 2) -> DataFrame:
    """Score each row of ``docs`` (``doc_id``, ``text``) by a model of the rows that are not ``held_out``.

    Tokens are words (runs of anything but ASCII white space, A-Z lowered) and one end. Adds ``held_out``, ``n_tokens``, ``n_known``
    (tokens that training has), ``train_tokens``, ``base_score`` (add-one unigrams) and ``score`` (the model's log10 probability of the
    text). Its levels are interpolated down to one over the vocabulary and one unknown word.

    Null texts are empty: one end. A null ``held_out`` is false. Repeated rows and ids count and are scored row by row. Without
    training rows every probability is one over the (empty) vocabulary and one. An empty table gives an empty result. Other
    columns pass through; an added one wins over its namesake.
    """
    if order < 1:
        raise ValueError("order is at least 1")
    added = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    others = [c for c in docs.columns if c not in ("doc_id", "text", *added)]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    marked = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"), rest.alias("others"))
    chunks = chunk_table(marked, name="kneser_ney", size=_CHUNK)
    narrow = chunks.select("_chunk", "_id", "_text", F.struct("_rest.held_out").alias("_rest"))
    n = text_shards(chunks, _CHUNK)
    stats: dict[int, list[int]] = {}
    told = None
    for k in range(order, 0, -1):
        if k == order:
            asked = per_chunk(narrow, _ask_top(order, n), _ASK)
        else:
            above = told.where(F.col("level") == k + 1).select("shard", "_chunk", "level", "owner", "count")
            asked = per_chunk_with(narrow, above, _ask_lower(k, order, n), _ASK)
        level = settle(per_shard(asked, _answer, _TOLD), f"kneser_ney_{k}")
        sums = [F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)).alias(f"s{i}") for i in range(8)]
        stats[k] = list(level.where("kind = 'stats'").agg(*sums).first())  # one row
        answers = level.where("kind = 'told'").drop("kind", "hashes", "stats").withColumn("level", F.lit(k))
        told = answers if told is None else told.unionByName(answers)
    schema = StructType(
        [
            StructField("_id", LongType()),
            StructField("held_out", BooleanType()),
            StructField("n_tokens", LongType()),
            StructField("n_known", LongType()),
            StructField("base_score", DoubleType()),
            StructField("score", DoubleType()),
            chunks.schema["_rest"],
        ]
    )
    scored = per_chunk_with(chunks, told.drop("owner"), _score(order, n, stats, schema), schema)
    return scored.select(
        F.col("_id").alias("doc_id"),
        *[F.col("_rest.others").getField(c).alias(c) for c in others],
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(stats[1][6]).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
