"""Token counts of whole texts, huge ones by overlapping chunks that are spliced where they agree.

A space before a character that is no white space begins a pre-token of byte-level BPE whatever stands round it: the
pattern has no branch that passes it, and no special token holds a space. So such a boundary is *stable*: both sides can be
encoded alone. Texts of usual size are cut there, and each different piece is encoded once a worker. Huge texts are encoded in
overlapping chunks with offsets; two chunks are spliced at the last stable boundary in their overlap at which both
begin a token, and the overlap is widened until there is one.

Chunks also take other boundaries, so that texts without spaces have them: the pattern's branches hold letters, digits, other signs or white
space alone, but for a space before any of these and for an apostrophe before letters, and look ahead from white space only. So
a boundary after a character that is no white space is stable where the kind changes, unless that character is an apostrophe or an added
token of the tokenizer lies across. Kinds are those on which Unicode 3.2 and Python's present tables agree; other characters
have none. Only a run of one kind (or of such characters) has to be encoded whole, as the library does.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from firmweave.llm.memo import Memo
from firmweave.llm.tables import bound_batches, per_batch

# Characters: texts from HUGE on are chunked; chunks of CHUNK with OVERLAP shared.
HUGE = 1 << 16
CHUNK = 1 << 15
OVERLAP = 1 << 9
# Pieces a worker remembers.
_MEMO = 600_000

# White space of Python covers that of the tokenizer's pattern, so each split is at a stable boundary.
_STABLE = re.compile(r"(?= \S)")


def has_stable_spaces(spec: dict) -> bool:
    """Whether the proof above holds for a tokenizer file: byte-level pattern alone, nothing added that has white space."""
    before = spec.get("pre_tokenizer") or {}
    added = spec.get("added_tokens") or []
    plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]) for t in added)
    level = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    return bool(level and plain and not spec.get("normalizer") and spec.get("model", {}).get("type") == "BPE")


@lru_cache(maxsize=1 << 16)
def kind(char: str) -> str | None:
    """L (letter), N (digit), S (white space) or O (other) where old and present tables agree, else None."""
    if char.isspace():
        return "S" if char in " \t\n\r" else None  # other white space is told differently by different libraries
    then, now = unicodedata.ucd_3_2_0.category(char), unicodedata.category(char)
    kinds = {c[0] if c[0] in "LN" else "O" for c in (then, now)}
    return kinds.pop() if len(kinds) == 1 and "Cn" not in (then, now) and "Z" not in (then[0], now[0]) else None


class Counter:
    """Counts tokens as ``Tokenizer.encode(text, add_special_tokens=False)`` does."""

    def __init__(self, tokenizer, stable: bool, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP):
        self.tokenizer, self.stable = tokenizer, stable
        self.huge, self.chunk, self.overlap = huge, chunk, overlap
        self.memo = Memo(_MEMO, group="tokens")
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    @classmethod
    def load(cls, path: str, **sizes) -> Counter:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = file.read()
        tokenizer = Tokenizer.from_str(spec)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return cls(tokenizer, has_stable_spaces(json.loads(spec)), **sizes)

    def _encode(self, texts: list[str]):
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def _sizes(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        if not self.stable:
            return self._sizes(texts)
        split = [None if len(t) >= self.huge else _STABLE.split(t) for t in texts]
        strings = set().union(*[p for p in split if p])
        get = self.memo.lookup(strings, self._sizes).__getitem__
        return [self.spliced(t) if p is None else sum(map(get, p)) for t, p in zip(texts, split, strict=True)]

    def spliced(self, text: str) -> int:
        """Tokens of one text, by overlapping chunks."""
        total = begin = start = 0  # tokens before ``begin`` are counted; the chunk begins at ``start`` <= ``begin``
        stop = min(len(text), self.chunk)
        heads = self._heads(text, start, stop)
        while stop < len(text):
            cut = None
            # The overlap is widened to the last place that can be spliced before the next chunk is encoded.
            at = self._last_stable(text, heads, begin, stop)
            overlap = self.overlap
            while at is not None and cut is None:
                while stop - overlap >= at:
                    overlap *= 2
                low = max(begin + 1, stop - overlap)
                if low >= at:
                    low = begin  # counted up to there: a proven boundary, or the start
                right_stop = min(len(text), stop + self.chunk)
                right = self._heads(text, low, right_stop)
                cut = self._common(text, heads, right, low, stop)
                if low <= begin + 1:
                    break
                overlap *= 2
            if cut is None:  # a run without such places: the chunk takes in as much again
                stop = min(len(text), stop + max(self.chunk, stop - start))
                heads = self._heads(text, start, stop)
                continue
            total += int(((heads >= begin) & (heads < cut)).sum())
            begin, start, stop, heads = cut, low, right_stop, right
        return total + int((heads >= begin).sum())

    def is_stable(self, text: str, at: int) -> bool:
        """Whether both sides of the boundary before ``at`` can be encoded alone."""
        before, after = kind(text[at - 1]), kind(text[at])
        if text[at] == " " and not text[at + 1].isspace():
            fits = True
        else:
            fits = before is not None and after is not None and before not in ("S", after) and text[at - 1] != "'"
        return fits and not any(text.find(t, max(0, at - len(t) + 1), at + len(t) - 1) >= 0 for t in self.added)

    def _last_stable(self, text: str, heads: np.ndarray, begin: int, stop: int) -> int | None:
        """The last stable place among the tokens' beginnings between ``begin`` and stop - 1."""
        for at in np.unique(heads[(heads > begin) & (heads < stop - 1)])[::-1].tolist():
            if self.is_stable(text, at):
                return at
        return None

    def _heads(self, text: str, start: int, stop: int) -> np.ndarray:
        """Where the tokens of a chunk begin."""
        offsets = self._encode([text[start:stop]])[0].offsets
        return np.array([a for a, _ in offsets], np.int64) + start

    def _common(self, text: str, left: np.ndarray, right: np.ndarray, low: int, stop: int) -> int | None:
        """The last place within low + 1 .. stop - 2 that is stable and begins a token on both sides."""
        return self._last_stable(text, np.intersect1d(left, right), low, stop)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, huge: int = HUGE) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit``) of the whole ``text``.

    ``path``: a tokenizers file that every worker can read. No special tokens are added; special strings within texts count
    as the library reads them by default. Null and empty texts have none. Rows are counted one by one, so repeated rows and ids
    do not matter; other columns pass through, added ones win over their namesakes.
    """
    bound_batches(docs.sparkSession)
    schema = StructType([*[f for f in docs.schema if f.name != "n_tokens"], StructField("n_tokens", LongType())])
    held: list[Counter] = []

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if not held:
            held.append(_counter(path, huge))
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.names.index("text")).to_pylist()]
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "n_tokens"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(held[0].counts(texts), pa.int64())], names=schema.names)

    counted = per_batch(docs, run, schema)
    others = [c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    return counted.select(
        *[F.col(f"`{c}`") for c in others],
        F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )


_COUNTERS: dict[tuple, Counter] = {}


def _counter(path: str, huge: int) -> Counter:
    """One counter a worker process, so that pieces learnt in one task serve the next."""
    if (path, huge) not in _COUNTERS:
        _COUNTERS[path, huge] = Counter.load(path, huge=huge)
    return _COUNTERS[path, huge]
