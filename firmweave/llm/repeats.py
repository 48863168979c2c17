"""Windows of a fixed number of tokens that occur elsewhere too: search over all texts, exact.

Tokens are bytes or words. In each window the q-gram with the least fingerprint is its *anchor*; equal windows have
equal anchors at equal offsets, so only the texts round anchors that several places share can hold repeated windows.
Neighbouring windows with one anchor form a *run*. Shards of anchors tell (``_first_answer``) which anchors are shared
and, of these, which have the same text all round (their runs are equal as a whole). All others are sent as *pieces*,
with their tokens, to be compared in full by a method of the operator, part by part of a shard: a part has all pieces of its
anchors, and answers are one bit a window. Anchors with very many different runs are cut into pieces of one window each, dealt
by their own content, so no shard gets a whole hot anchor.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from firmweave.llm.tables import Texts, blobs, chunk_table, cuts, per_chunk, per_chunk_with, per_shard, settle, shard_of, text_shards
from firmweave.llm.words import WHITE, join, mix, ranking, sliding_min, word_bounds, word_hashes

_POS_BITS = np.uint64(18)
_BLOCK = 1 << 16
# Runs of one anchor from which on its windows are dealt one by one; layout only.
HOT_RUNS = 256
# Parts in which a shard compares its pieces, one after another, each with all pieces of its anchors; layout only.
PARTS = 16
_NONE, _WHOLE, _PIECES, _HOT = 0, 1, 2, 3

_ASK = "shard int, _chunk bigint, keys binary, runs binary, many binary, load binary"
_ASKED = "_chunk bigint, shard int, picks binary, verdicts binary"
_PIECE = "shard int, _chunk bigint, kind int, parts binary, lengths binary, owners binary, tokens binary"
_TOLD = "_chunk bigint, kind int, shard int, told binary"


@dataclass(frozen=True)
class Windows:
    """Windows of ``length`` tokens (``unit`` "byte" or "word") with anchors of ``gram`` tokens."""

    unit: str
    length: int
    gram: int

    @property
    def width(self) -> int:
        return self.length - self.gram + 1


class Tokens:
    def __init__(self, texts: Texts, unit: str):
        self.texts, self.unit = texts, unit
        if unit == "byte":
            self.values, self.offsets = texts.data, texts.offsets
        else:
            self.starts, self.ends, self.offsets = word_bounds(texts.data, texts.offsets, WHITE)
            self.values = word_hashes(texts.data, self.starts, self.ends)

    def grams(self, lo: int, hi: int, n: int) -> np.ndarray:
        """Fingerprints of all n-grams within tokens lo .. hi."""
        count = hi - lo - n + 1
        if count <= 0:
            return np.zeros(0, np.uint64)
        if self.unit == "byte":
            part = np.ascontiguousarray(self.values[lo:hi])
            eight = np.ndarray((len(part) - 7,), dtype="<u8", buffer=part.data, strides=(1,)).copy()
            out = eight[:count]
            for at in [*range(8, n - 8, 8), n - 8]:
                out = join(out, eight[at : at + count])
            out ^= out >> np.uint64(32)
            return out
        return grams_of(self.values[lo:hi], n)


def grams_of(tokens: np.ndarray, n: int) -> np.ndarray:
    out, have, step, size = None, 0, tokens, 1
    left = n
    while left:
        if left & 1:
            out = step if out is None else join(out[: len(step) - have], step[have:])
            have += size
        left >>= 1
        if left:
            step = join(step[:-size], step[size:])
            size *= 2
    out = out[: len(tokens) - n + 1]
    return out ^ (out >> np.uint64(32))


class Anchors:
    """The anchors of a chunk: key, token position, first and last window, run fingerprint, text number."""

    def __init__(self, tokens: Tokens, windows: Windows):
        length, gram, width = windows.length, windows.gram, windows.width
        n = len(tokens.values)
        offsets = tokens.offsets
        crossing = np.zeros(n, bool)
        ends = offsets[1:]
        for back in range(1, length):
            at = ends - back
            crossing[at[at >= offsets[:-1]]] = True
        steps = [*range(0, length - gram, gram), length - gram]
        place, none = np.uint64((1 << int(_POS_BITS)) - 1), ~np.uint64(0)
        places = np.arange(_BLOCK + width, dtype=np.uint64)
        parts = []
        for lo in range(0, max(0, n - length + 1), _BLOCK):
            hi = min(lo + _BLOCK, n - length + 1)
            g = tokens.grams(lo, hi + length - 1, gram)
            key = g & ~place
            key |= places[: len(g)]
            least = sliding_min(key, width)
            np.copyto(least, none, where=crossing[lo:hi])
            heads = np.append(0, np.flatnonzero(least[1:] != least[:-1]) + 1)
            tails = np.append(heads[1:], len(least)) - 1
            some = least[heads] != none
            first, last = heads[some], tails[some]
            at = (least[first] & place).astype(np.int64)

            def whole(s, g=g):
                out = g[s]
                for step in steps[1:]:
                    out = join(out, g[s + step])
                return out

            parts.append((lo + at, lo + first, lo + last, g[at], whole(first), whole(last)))
        if parts:
            pos, first, last, key, head, tail = (np.concatenate(x) for x in zip(*parts, strict=True))
        else:
            pos = first = last = np.zeros(0, np.int64)
            key = head = tail = np.zeros(0, np.uint64)
        if len(pos):  # runs cut by the block boundaries
            new = np.ones(len(pos), bool)
            new[1:] = (pos[1:] != pos[:-1]) | (last[:-1] + 1 != first[1:])
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(pos)) - 1
            pos, first, key, head, last, tail = pos[begin], first[begin], key[begin], head[begin], last[end], tail[end]
        key = mix(key)  # anchors have small fingerprints; shards need even ones
        shape = ((last - first).astype(np.uint64) << np.uint64(32)) | (pos - first).astype(np.uint64)
        run = mix(join(join(head, tail), shape)) if len(pos) else key
        run[run == 0] = 1
        doc = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(pos, offsets)))
        order, self.key = ranking(key, 64)
        self.pos, self.first, self.last, self.run, self.doc = pos[order], first[order], last[order], run[order], doc[order]
        new = np.ones(len(order), bool)
        new[1:] = self.key[1:] != self.key[:-1]
        self.heads = np.flatnonzero(new)
        self.sizes = np.diff(np.append(self.heads, len(order)))

    def reduce(self, ufunc, values):
        return ufunc.reduceat(values, self.heads) if len(self.heads) else values[:0]


def _first_ask(windows: Windows, n_shards: int, between_docs: bool):
    def ask(key, table: pa.Table) -> pa.Table:
        a = Anchors(Tokens(Texts(table), windows.unit), windows)
        keys = a.key[a.heads]
        low, high = a.reduce(np.minimum, a.run), a.reduce(np.maximum, a.run)
        mixed = low != high
        runs = np.where(mixed, np.uint64(0), low)
        many = a.reduce(np.minimum, a.doc) != a.reduce(np.maximum, a.doc) if between_docs else a.sizes > 1
        at = cuts(shard_of(keys, n_shards), n_shards)
        short = keys.astype(np.uint32)
        load = a.sizes.astype(np.uint32)
        used = np.flatnonzero(np.diff(at))
        pick = [slice(at[s], at[s + 1]) for s in used]
        return pa.table(
            {
                "shard": pa.array(used, pa.int32()),
                "_chunk": pa.array(np.full(len(used), key[0].as_py()), pa.int64()),
                "keys": pa.array([short[x].tobytes() for x in pick], pa.binary()),
                "runs": pa.array([runs[x].tobytes() for x in pick], pa.binary()),
                "many": pa.array([np.packbits(many[x]).tobytes() for x in pick], pa.binary()),
                "load": pa.array([load[x][mixed[x]].tobytes() for x in pick], pa.binary()),
            }
        )

    return ask


def _first_answer(key, table: pa.Table) -> pa.Table:
    keys = blobs(table.column("keys"), np.uint32)
    sizes = np.array([len(k) for k in keys])
    runs = np.concatenate(blobs(table.column("runs"), np.uint64))
    many = np.concatenate([np.unpackbits(b, count=n) for b, n in zip(blobs(table.column("many"), np.uint8), sizes, strict=True)])
    load = np.ones(len(runs), np.int64)
    load[runs == 0] = np.concatenate(blobs(table.column("load"), np.uint32))
    keys = np.concatenate(keys)
    order, ranked = ranking(keys.astype(np.uint64), 32)
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    heads = np.flatnonzero(new)
    counts = np.diff(np.append(heads, len(keys)))
    low, high = np.minimum.reduceat(runs[order], heads), np.maximum.reduceat(runs[order], heads)
    shared = (counts > 1) | (np.maximum.reduceat(many[order], heads) > 0)
    verdict = np.where((low == high) & (low != 0), _WHOLE, np.where(np.add.reduceat(load[order], heads) > HOT_RUNS, _HOT, _PIECES))
    verdict = np.where(shared, verdict, _NONE).astype(np.uint8)
    each = np.empty(len(keys), np.uint8)
    each[order] = np.repeat(verdict, counts)
    picks, verdicts, rows, end = [], [], [], 0
    for row, n in enumerate(sizes):
        part = each[end : end + n]
        end += n
        hit = np.flatnonzero(part)
        if len(hit):
            rows.append(row)
            picks.append(hit.astype(np.uint32).tobytes())
            verdicts.append(part[hit].tobytes())
    return pa.table(
        {
            "_chunk": table.column("_chunk").take(pa.array(rows, pa.int64())).combine_chunks().cast(pa.int64()),
            "shard": pa.array([key[0].as_py()] * len(rows), pa.int32()),
            "picks": pa.array(picks, pa.binary()),
            "verdicts": pa.array(verdicts, pa.binary()),
        }
    )


class Candidates:
    """What a chunk knows after the first answers: whole runs, and the pieces to compare."""

    def __init__(self, tokens: Tokens, windows: Windows, n_shards: int, answers: pa.Table):
        self.tokens, self.windows = tokens, windows
        a = self.anchors = Anchors(tokens, windows)
        keys = a.key[a.heads]
        at = cuts(shard_of(keys, n_shards), n_shards)
        verdict = np.zeros(len(keys), np.uint8)
        for shard, picks, verdicts in zip(
            answers.column("shard").to_pylist(), blobs(answers.column("picks"), np.uint32), blobs(answers.column("verdicts"), np.uint8), strict=True
        ):
            verdict[at[shard] + picks] = verdicts
        each = np.repeat(verdict, a.sizes)
        self.whole = np.flatnonzero(each == _WHOLE)
        some, hot = np.flatnonzero(each == _PIECES), np.flatnonzero(each == _HOT)
        # Pieces of single windows for hot anchors; occurrence: first token, number of tokens, text, key to deal by.
        spread = a.last[hot] - a.first[hot] + 1
        starts = np.repeat(a.first[hot], spread) + (np.arange(spread.sum()) - np.repeat(np.cumsum(spread) - spread, spread))
        self.start = np.concatenate([a.first[some], starts])
        self.size = np.concatenate([a.last[some] - a.first[some], np.zeros(len(starts), np.int64)]) + windows.length
        self.doc = np.concatenate([a.doc[some], np.repeat(a.doc[hot], spread)])
        window_prints = self._prints(starts)
        deal = np.concatenate([a.key[some], window_prints])
        same = np.concatenate([a.run[some], window_prints])
        # Equal pieces of a chunk are sent once: deal by key, then by fingerprint.
        order = np.lexsort((same, deal))
        new = np.ones(len(order), bool)
        new[1:] = (deal[order][1:] != deal[order][:-1]) | (same[order][1:] != same[order][:-1])
        self.order, self.heads = order, np.flatnonzero(new)
        self.class_of = np.empty(len(order), np.int64)
        self.class_of[order] = np.cumsum(new) - 1
        self.sample = order[self.heads]
        self.part = shard_of(deal[self.sample], n_shards * PARTS)
        self.shard = self.part // np.uint64(PARTS)

    def _prints(self, starts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), np.uint64)
        if len(starts):
            for step in range(self.windows.length):
                out = join(out, self.tokens.values[starts + step].astype(np.uint64))
            out = mix(out)
        return out

    def owners(self, weights: np.ndarray, ufunc) -> np.ndarray:
        return ufunc.reduceat(weights[self.order], self.heads) if len(self.heads) else weights[:0]

    def whole_classes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of whole runs by shard, the number of each occurrence's key, and the least id of each key."""
        a = self.anchors
        order, ranked = ranking(join(a.run[self.whole], a.key[self.whole]), 64)
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        heads = np.flatnonzero(new)
        inverse = np.empty(len(order), np.int64)
        inverse[order] = np.cumsum(new) - 1
        return ranked[heads], inverse, np.minimum.reduceat(ids[a.doc[self.whole]][order], heads)

    def content(self, cls: np.ndarray) -> np.ndarray:
        starts, sizes = self.start[self.sample[cls]], self.size[self.sample[cls]]
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        return self.tokens.values[np.repeat(starts, sizes) + inner]


def _second_ask(windows: Windows, n_shards: int, between_docs: bool):
    def ask(key, table: pa.Table, answers: pa.Table) -> pa.Table:
        texts = Texts(table)
        c = Candidates(Tokens(texts, windows.unit), windows, n_shards, answers)
        rows = {k: [] for k in ("shard", "kind", "parts", "lengths", "owners", "tokens")}
        if between_docs and len(c.whole):
            keys, _, least = c.whole_classes(texts.ids)
            at = cuts(shard_of(keys, n_shards), n_shards)
            for s in np.flatnonzero(np.diff(at)):
                x = slice(at[s], at[s + 1])
                for k, v in zip(rows, (int(s), 0, b"", b"", least[x].tobytes(), keys[x].tobytes()), strict=True):
                    rows[k].append(v)
        weights = texts.ids[c.doc] if between_docs else np.ones(len(c.doc), np.int64)
        owners = c.owners(weights, np.minimum if between_docs else np.add)
        at = cuts(c.shard, n_shards)
        parts = np.diff(cuts(c.part, n_shards * PARTS)).astype(np.uint32).reshape(n_shards, PARTS)
        for s in np.flatnonzero(np.diff(at)):
            cls = np.arange(at[s], at[s + 1])
            sizes = c.size[c.sample[cls]].astype(np.uint32)
            for k, v in zip(rows, (int(s), 1, parts[s].tobytes(), sizes.tobytes(), owners[cls].tobytes(), c.content(cls).tobytes()), strict=True):
                rows[k].append(v)
        types = {"shard": pa.int32(), "kind": pa.int32()}
        out = {k: pa.array(v, types.get(k, pa.binary())) for k, v in rows.items()}
        chunk = pa.array(np.full(len(rows["shard"]), key[0].as_py()), pa.int64())
        return pa.table({"shard": out["shard"], "_chunk": chunk, **{k: out[k] for k in ("kind", "parts", "lengths", "owners", "tokens")}})

    return ask


def _second_answer(windows: Windows, compare):
    """``compare(tokens, lengths, owners)``: for each window of each piece, in order, whether it is repeated.

    Between documents: whether it has an owner less than the piece's.
    """
    dtype = np.uint8 if windows.unit == "byte" else np.uint64

    def answer(key, table: pa.Table) -> pa.Table:
        kinds = np.array(table.column("kind").to_pylist())
        owners, tokens = blobs(table.column("owners"), np.int64), blobs(table.column("tokens"), dtype)
        told: list[bytes] = [b""] * len(kinds)
        rows = np.flatnonzero(kinds == 0)
        if len(rows):
            order, ranked = ranking(np.concatenate([tokens[r].view(np.uint64) for r in rows]), 64)
            mine = np.concatenate([owners[r] for r in rows])
            new = np.ones(len(ranked), bool)
            new[1:] = ranked[1:] != ranked[:-1]
            heads = np.flatnonzero(new)
            least = np.empty(len(order), np.int64)
            least[order] = np.repeat(np.minimum.reduceat(mine[order], heads), np.diff(np.append(heads, len(order))))
            hit = least < mine
            end = 0
            for r in rows:
                told[r] = np.packbits(hit[end : end + len(owners[r])]).tobytes()
                end += len(owners[r])
        rows = np.flatnonzero(kinds == 1)
        if len(rows):
            lengths = [x.astype(np.int64) for x in blobs(table.column("lengths"), np.uint32)]
            # Of each row and part: pieces, tokens and windows before it.
            parts = np.stack([x.astype(np.int64) for x in blobs(table.column("parts").take(pa.array(rows)), np.uint32)])
            pieces = np.concatenate([np.zeros((len(rows), 1), np.int64), np.cumsum(parts, axis=1)], axis=1)
            sums = [np.concatenate([[0], np.cumsum(lengths[r])]) for r in rows]
            words = np.stack([x[at] for x, at in zip(sums, pieces, strict=True)])
            spans = words - (windows.length - 1) * pieces
            hits = [np.empty(int(n), bool) for n in spans[:, -1]]
            for part in range(PARTS):
                some = np.flatnonzero(parts[:, part]).tolist()
                if not some:
                    continue
                pick = [(i, rows[i], slice(*pieces[i, part : part + 2].tolist())) for i in some]
                values = compare(
                    np.concatenate([tokens[r][slice(*words[i, part : part + 2].tolist())] for i, r, _ in pick]),
                    np.concatenate([lengths[r][x] for _, r, x in pick]),
                    np.concatenate([owners[r][x] for _, r, x in pick]),
                )
                end = 0
                for i in some:
                    lo, hi = spans[i, part : part + 2].tolist()
                    hits[i][lo:hi] = values[end : end + hi - lo]
                    end += hi - lo
            for r, hit in zip(rows, hits, strict=True):
                told[r] = np.packbits(hit).tobytes()
        return pa.table(
            {
                "_chunk": table.column("_chunk"),
                "kind": table.column("kind"),
                "shard": table.column("shard"),
                "told": pa.array(told, pa.binary()),
            }
        )

    return answer


def _cover(texts: Texts, c: Candidates, n_shards: int, told: pa.Table, between_docs: bool) -> np.ndarray:
    """For each token, whether a repeated window covers it.

    Between documents the answers are about the least id of the chunk; all greater ones have that one before them.
    """
    length = c.windows.length
    a = c.anchors
    n = len(c.tokens.values)
    by = {}
    for kind, shard, value in zip(told.column("kind").to_pylist(), told.column("shard").to_pylist(), told.column("told"), strict=True):
        by[kind, shard] = np.frombuffer(value.as_buffer(), np.uint8)

    def bits(kind: int, at: np.ndarray) -> np.ndarray:
        sizes = np.diff(at)
        return np.concatenate([np.unpackbits(by[kind, s], count=int(sizes[s])) for s in np.flatnonzero(sizes).tolist()]) > 0

    edge = np.zeros(n + 1, np.int32)
    whole = c.whole
    if between_docs and len(whole):
        keys, inverse, least = c.whole_classes(texts.ids)
        hit = bits(0, cuts(shard_of(keys, n_shards), n_shards))
        whole = whole[hit[inverse] | (texts.ids[a.doc[whole]] > least[inverse])]
    np.add.at(edge, a.first[whole], 1)
    np.add.at(edge, a.last[whole] + length, -1)
    if len(c.sample):
        spans = c.size[c.sample] - length + 1
        begin = np.concatenate([[0], np.cumsum(spans)])
        hit = bits(1, begin[cuts(c.shard, n_shards)])
        some = np.arange(len(c.start))
        if between_docs:
            ids = texts.ids[c.doc]
            later = ids > c.owners(ids, np.minimum)[c.class_of]
            np.add.at(edge, c.start[later], 1)
            np.add.at(edge, c.start[later] + c.size[later], -1)
            some = some[~later]
        mine = spans[c.class_of[some]]
        inner = np.arange(mine.sum()) - np.repeat(np.cumsum(mine) - mine, mine)
        start = (np.repeat(c.start[some], mine) + inner)[hit[np.repeat(begin[c.class_of[some]], mine) + inner]]
        begins = np.append(True, start[1:] != start[:-1] + 1)[: len(start)]
        np.add.at(edge, start[begins], 1)
        np.add.at(edge, start[np.append(begins[1:], True)[: len(start)]] + length, -1)
    return np.cumsum(edge[:-1], dtype=np.int32, out=edge[:-1]) > 0


def remove_windows(docs: DataFrame, windows: Windows, compare, between_docs: bool, render, out: StructType, name: str) -> DataFrame:
    """Find repeated windows and hand each chunk's covered tokens to ``render(tokens, covered) -> arrays of columns``.

    ``between_docs``: a window counts if it starts in a row with a smaller id; else if it starts anywhere else.
    Returns ``_id``, the columns ``out`` and ``_rest``.
    """
    chunks = chunk_table(docs, name=name)
    n = text_shards(chunks)
    narrow = chunks.select("_chunk", "_id", "_text")
    asked = per_chunk(narrow, _first_ask(windows, n, between_docs), _ASK)
    first = settle(per_shard(asked, _first_answer, _ASKED), f"{name}_shared")
    pieces = per_chunk_with(narrow, first, _second_ask(windows, n, between_docs), _PIECE)
    second = per_shard(pieces, _second_answer(windows, compare), _TOLD)
    answers = first.selectExpr("_chunk", "-1 AS kind", "shard", "picks", "verdicts", "CAST(NULL AS BINARY) AS told").unionByName(
        second.selectExpr("_chunk", "kind", "shard", "CAST(NULL AS BINARY) AS picks", "CAST(NULL AS BINARY) AS verdicts", "told")
    )
    schema = StructType([StructField("_id", LongType()), *out.fields, chunks.schema["_rest"]])

    def finish(key, table: pa.Table, told: pa.Table) -> pa.Table:
        texts = Texts(table)
        tokens = Tokens(texts, windows.unit)
        kind = np.array(told.column("kind").to_pylist(), dtype=np.int64)
        c = Candidates(tokens, windows, n, told.take(pa.array(np.flatnonzero(kind < 0))))
        covered = _cover(texts, c, n, told.take(pa.array(np.flatnonzero(kind >= 0))), between_docs)
        del c
        made = render(tokens, covered)
        columns = {"_id": table.column("_id"), **dict(zip(out.names, made, strict=True)), "_rest": table.column("_rest")}
        return pa.table([columns[x] for x in schema.names], names=schema.names)

    return per_chunk_with(chunks, answers, finish, schema)


def spans_array(covered: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Maximal covered runs of each text as lists of (start, end) within the text, and their number."""
    begins, finishes = covered.copy(), covered.copy()
    begins[1:] &= ~covered[:-1]
    finishes[:-1] &= ~covered[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(covered))]
    begins[edges] = covered[edges]
    finishes[edges - 1] = covered[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    at = np.searchsorted(starts, offsets)
    base = np.repeat(offsets[:-1], np.diff(at))
    struct = pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base)], names=["start", "end"])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), struct), np.diff(at)
