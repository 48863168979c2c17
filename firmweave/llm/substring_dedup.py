"""Substring dedup: words covered by a 35-word window that occurs anywhere else, found with suffix automata.

Suffix automata of reference shards: all texts are reference to each other, so the reference grows with the corpus and cannot be
broadcast whole. Each shard gets the pieces that can hold a repeated window of its anchors (``repeats``), builds one suffix
automaton over them with the number of places of each state, and streams the pieces through it for matching statistics.
A window is repeated if the state of its last 35 words has two places or more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from firmweave.llm.repeats import Tokens, Windows, remove_windows, spans_array

_OUT = StructType(
    [
        StructField("kept", BinaryType()),
        StructField("n_words", LongType()),
        StructField("n_removed", LongType()),
        StructField("spans", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))),
    ]
)


class SuffixAutomaton:
    """Automaton of all substrings of the texts added, with the weighted number of places of each."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.places: list[int] = [0]

    def _state(self, length: int, moves: dict) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(0)
        self.places.append(0)
        return len(self.next) - 1

    def _split(self, p: int, q: int, token) -> int:
        clone = self._state(self.length[p] + 1, self.next[q].copy())
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def add(self, tokens: list, weight: int) -> None:
        last = 0
        for token in tokens:
            p, q = last, self.next[last].get(token)
            if q is not None:
                last = q if self.length[q] == self.length[p] + 1 else self._split(p, q, token)
            else:
                last = self._state(self.length[p] + 1, {})
                while p >= 0 and token not in self.next[p]:
                    self.next[p][token] = last
                    p = self.link[p]
                if p >= 0:
                    q = self.next[p][token]
                    self.link[last] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, token)
            self.places[last] += weight

    def close(self) -> None:
        """Pass the places of each state on to its suffixes."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                self.places[self.link[state]] += self.places[state]

    def ends(self, tokens: list, length: int) -> list[int]:
        """For each end position, the places of the last ``length`` words; 0 if fewer words match there."""
        out = []
        state = matched = 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            state = self.next[state].get(token, 0)
            matched = matched + 1 if state else 0
            while state and self.length[self.link[state]] >= length:
                state = self.link[state]
                matched = length
            out.append(self.places[state] if matched >= length else 0)
        return out


def _places(length: int):
    def compare(tokens: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> np.ndarray:
        words, numbers = np.unique(tokens, return_inverse=True)
        numbers = numbers.tolist()
        cut = np.concatenate([[0], np.cumsum(lengths)]).tolist()
        automaton = SuffixAutomaton()
        for k, weight in enumerate(owners.tolist()):
            automaton.add(numbers[cut[k] : cut[k + 1]], weight)
        automaton.close()
        out: list[int] = []
        for k in range(len(lengths)):
            out += automaton.ends(numbers[cut[k] : cut[k + 1]], length)[length - 1 :]
        return np.array(out, np.int64) > 1

    return compare


def joined_words(tokens: Tokens, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space, as bytes."""
    data = tokens.texts.data.copy()
    starts, ends, offsets = tokens.starts[keep], tokens.ends[keep], tokens.texts.offsets
    at = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])[tokens.offsets]
    last = np.zeros(len(starts), bool)
    last[at[1:][np.diff(at) > 0] - 1] = True
    data[ends[~last]] = 0x20
    edge = np.zeros(len(data) + 1, np.int32)
    edge[starts] += 1
    np.add.at(edge, ends + ~last, -1)
    mask = np.cumsum(edge[:-1]) > 0
    cut = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])[offsets]
    buffers = [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(data[mask].tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).cast(pa.binary())


def _render(tokens: Tokens, covered: np.ndarray):
    offsets = tokens.offsets
    at = np.concatenate([[0], np.cumsum(covered, dtype=np.int64)])[offsets]
    spans, _ = spans_array(covered, offsets)
    return joined_words(tokens, ~covered), pa.array(np.diff(offsets)), pa.array(np.diff(at)), spans


def remove_repeated_words(docs: DataFrame, length: int = 35, gram: int = 8) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and any others) without words covered by a window that starts anywhere else too.

    A window is ``length`` consecutive words of one document, words being runs of anything but ASCII white space. Windows
    are judged on the input. Adds ``kept`` (the remaining words joined by one space, UTF-8), ``n_words``, ``n_removed`` and ``spans``
    (maximal removed runs, in words).

    Null texts have no words. Rows may repeat an id or have none: each row is a document of its own. Documents of fewer words
    stay whole. An empty table gives an empty result. Other columns pass through; an added column wins over one of its name.
    """
    if gram < 1 or length < gram:
        raise ValueError("1 <= gram <= length is needed")
    found = remove_windows(docs, Windows("word", length, gram), _places(length), False, _render, _OUT, "substring")
    added = _OUT.names
    others = [F.col("_rest").getField(c).alias(c) for c in docs.columns if c not in ("doc_id", "text", *added)]
    return found.select(F.col("_id").alias("doc_id"), *others, *added)
