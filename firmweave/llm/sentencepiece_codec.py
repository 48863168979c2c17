"""SentencePiece encoding and decoding with the tokenizers library as backend.

The model protobuf is parsed here; from it come the normaliser, the metaspace marker, unigram scores or BPE merges, and byte
fallback. No piece of such models has the marker after another character (checked), so words can be encoded one by one, each
different word once a worker and batches of new words multithreaded.
"""

from __future__ import annotations

import os
import re
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from firmweave.llm.memo import Memo
from firmweave.llm.tables import bound_batches, per_batch

MARK = "▁"
# Piece types and model types of the protobuf format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
# Words a worker remembers.
_MEMO = 500_000
_WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


@dataclass(frozen=True)
class Model:
    pieces: list[tuple[str, float, int]]
    model_type: int
    charsmap: bytes
    dummy_prefix: bool
    remove_spaces: bool
    escape: bool

    @property
    def byte_fallback(self) -> bool:
        return any(kind == BYTE for _, _, kind in self.pieces)


def _fields(data: bytes):
    """(number, value) of each field of a protobuf message: ints, floats as 4 raw bytes, or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError("not a SentencePiece model")
            size = varint()
        yield tag >> 3, data[at : at + size]
        at += size


def parse_model(data: bytes) -> Model:
    """Read a ModelProto: pieces (1), trainer_spec (2) with model_type (3), normalizer_spec (3)."""
    pieces, model_type, norm = [], UNIGRAM, {2: b"", 3: 1, 4: 1, 5: 1}
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            pieces.append((piece, score, kind))
        elif number == 2:
            model_type = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            norm |= dict(_fields(value))
    if model_type not in (UNIGRAM, BPE):
        raise ValueError(f"model type {model_type} is neither unigram nor BPE")
    return Model(pieces, model_type, norm[2], bool(norm[3]), bool(norm[4]), bool(norm[5]))


def _merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, best score first."""
    rank = {p: k for k, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, k in rank.items():
        for i in range(1, len(piece)):
            left, right = piece[:i], piece[i:]
            if left in rank and right in rank:
                found.append((-pieces[k][1], k, rank[left], rank[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build_backend(model: Model):
    """A ``tokenizers.Tokenizer`` with the model's normaliser, marker, scores or merges, and byte fallback."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = next(i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN)
    if model.model_type == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, model.byte_fallback)
    else:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocab, _merges(model.pieces), unk_token=model.pieces[unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    tokenizer = Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if words_are_separate(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
    strip = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
    return tokenizer


def words_are_separate(model: Model) -> bool:
    """Whether no piece has the marker after another character, so that encoding splits before each run of markers."""
    return model.escape and not any(kind in (NORMAL, USER_DEFINED) and MARK in p.lstrip(MARK) for p, _, kind in model.pieces)


class Codec:
    def __init__(self, model: Model):
        self.model = model
        self.tokenizer = build_backend(model)
        self.separate = words_are_separate(model)
        self.memo = Memo(_MEMO, group="codec")
        unknown = " ⁇ "  # what the format writes for the unknown piece (fixed value)
        surface = []
        for piece, _, kind in model.pieces:
            if kind == BYTE:
                surface.append(bytes([int(piece[3:5], 16)]))
            elif kind == CONTROL:
                surface.append(b"")
            else:
                surface.append((unknown if kind == UNKNOWN else piece.replace(MARK, " ")).encode())
        self.sizes = np.array([len(s) for s in surface], np.int64)
        self.at = np.cumsum(self.sizes) - self.sizes
        self.surface = np.frombuffer(b"".join(surface), np.uint8)

    @classmethod
    def load(cls, path: str) -> Codec:
        with open(path, "rb") as file:
            return cls(parse_model(file.read()))

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.int32).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if not self.separate:
            return [np.frombuffer(b, np.int32) for b in self._ids(texts)]
        normal = self.tokenizer.normalizer
        slow = self.model.charsmap or self.model.remove_spaces
        prefix = MARK if self.model.dummy_prefix else ""
        split = [_WORDS.findall(normal.normalize_str(t) if slow else t and prefix + t.replace(" ", MARK)) for t in texts]
        # The words are in normal form already: the same backend without its normaliser encodes them.
        get = self.memo.lookup(set().union(*split), self._plain).__getitem__
        return [np.frombuffer(b"".join(map(get, words)), np.int32) for words in split]

    def _plain(self, words: list[str]) -> list[bytes]:
        if not hasattr(self, "_bare"):
            from tokenizers import Tokenizer

            self._bare = Tokenizer(self.tokenizer.model)
        return [np.array(e.ids, np.int32).tobytes() for e in self._bare.encode_batch_fast(words, add_special_tokens=False)]

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Texts of id sequences: surfaces and fallback bytes one after the other, the dummy prefix taken off."""
        lengths = [len(i) for i in ids]
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        sizes = self.sizes[flat]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        inner = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
        data = self.surface[np.repeat(self.at[flat], sizes) + inner].tobytes()
        cut = ends[np.concatenate([[0], np.cumsum(lengths)])].tolist() if lengths else [0]
        texts = [data[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        if self.model.dummy_prefix:
            texts = [t[1:] if t[:1] == b" " else t for t in texts]
        return [t.decode("utf-8", "replace") for t in texts]


_CODECS: dict[str, Codec] = {}


def _codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec.load(path)
    return _CODECS[path]


def _prepare(threads: int) -> None:
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"


def encode_texts(docs: DataFrame, path: str, threads: int = 2) -> DataFrame:
    """``docs`` with ``ids``, the ids of the whole ``text``, without begin or end.

    ``path``: a SentencePiece model that every worker can read; ``threads`` of the backend a task. A null or empty text has no ids. Each
    row is encoded by itself; other columns pass through, an ``ids`` column already there is replaced. Of a unigram model's
    segmentations the one with the greatest sum of scores in double precision is taken; where two differ by less than float32
    rounding, a library that sums in float32 may take the other. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    others = [f for f in docs.schema if f.name != "ids"]
    schema = StructType([*others, StructField("ids", ArrayType(IntegerType()))])

    def run(batches):
        _prepare(threads)
        codec = _codec(path)
        for batch in batches:
            at = batch.schema.names.index("text")
            ids = codec.encode([t or "" for t in batch.column(at).to_pylist()])
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "ids"]
            yield pa.RecordBatch.from_arrays([*kept, lists], names=schema.names)

    return per_batch(docs, run, schema)


def decode_ids(encoded: DataFrame, path: str, out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ``ids`` in column ``out``; null ids give null. Ids outside the model are an error."""
    bound_batches(encoded.sparkSession)
    others = [f for f in encoded.schema if f.name != out]
    schema = StructType([*others, StructField(out, StringType())])

    def run(batches):
        codec = _codec(path)
        for batch in batches:
            column = batch.column(batch.schema.names.index("ids"))
            flat = column.flatten().to_numpy(zero_copy_only=False)
            if column.flatten().null_count or (len(flat) and (flat.min() < 0 or flat.max() >= len(codec.sizes))):
                raise ValueError("ids outside the model")
            sizes = pa.compute.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
            texts = codec.decode(np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else [])
            made = pa.array(texts, pa.string(), mask=column.is_null().to_numpy(zero_copy_only=False))
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != out]
            yield pa.RecordBatch.from_arrays([*kept, made], names=schema.names)

    return per_batch(encoded, run, schema)
