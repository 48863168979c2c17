"""Intermediate tables in the shared folder, and the exchange between text chunks and key shards.

Operators that compare every text with every other one work in three steps:

* ``chunk_table`` writes the texts once, in chunks of bounded size. The table is bucketed by chunk, so that later passes
  over a chunk need no shuffle of texts.
* Each chunk *asks*: it sends what it holds of each key once, whatever the number of its rows (a hot key costs one
  entry per chunk, not one per row), packed in arrays, to the shard of the key.
* Each shard *answers* the chunks that asked, by position in what they sent.
"""

from __future__ import annotations

import ctypes
import math
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from firmweave.llm.memo import forget
from firmweave.session import ensure_checkpoint_dir

# Text bytes of a chunk, and bytes of an Arrow batch: layout only, results do not depend on them.
CHUNK_BYTES = 6 << 20
BATCH_BYTES = 1 << 20
MAX_BUCKETS = 100_000
# What a shard holds, about: the keys of so many bytes of text, or rows of so many bytes. Layout only, too.
SHARD_BYTES = 32 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's bound of Arrow batches to BATCH_BYTES: workers hold many times a batch, and texts may be long."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(key).rstrip("bB")) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def shards(spark: SparkSession, filled: float) -> int:
    """Number of shards for what fills ``filled`` of them: a shard is held whole by one task, so they grow in number, not in size.

    At least four for each shuffle partition, so that small inputs spread as well.
    """
    return max(4 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), math.ceil(filled))


def text_shards(chunks: DataFrame, size: int = CHUNK_BYTES) -> int:
    """Shards for the keys of a ``chunk_table`` written in chunks of ``size``: reads the chunk numbers, which need no shuffle."""
    chunk_count = chunks.agg(F.count_distinct("_chunk")).first()[0]
    return shards(chunks.sparkSession, chunk_count * size / SHARD_BYTES)


def row_shards(rows: DataFrame, dealt: Column) -> int:
    """Shards for what ``rows`` are dealt as; ``dealt`` is its bytes for each row."""
    total = rows.agg(F.coalesce(F.sum(dealt), F.lit(0))).first()[0]
    return shards(rows.sparkSession, total / SHARD_BYTES)


def give_back() -> None:
    """Hand freed memory back to the system: workers live on, and their executor's memory is shared with the JVM."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def _lightly(fn, *args) -> pa.Table:
    """The result of a task's function; memos of operators before are emptied first, freed memory is handed back after."""
    forget()
    result = fn(*args)
    give_back()
    return result


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def _folder(spark: SparkSession, name: str) -> tuple[str, str]:
    table = f"{name}_{uuid.uuid4().hex}"
    return table, f"{ensure_checkpoint_dir(spark)}/llm/{table}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: one computation for several uses, safe from lost executors."""
    spark = df.sparkSession
    _, path = _folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunk_table(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "chunks", size: int = CHUNK_BYTES
) -> DataFrame:
    """``docs`` in chunks: ``_chunk``, ``_id``, ``_text`` and ``_rest``, a struct of all other columns.

    A chunk closes at ``size`` bytes of text, so it holds more only if one text is longer.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    packed = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").alias("_text"), rest.alias("_rest")
    )
    schema = StructType([StructField("_chunk", LongType())] + [StructField(f.name, f.dataType) for f in packed.schema])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            lengths = pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
            at = np.empty(len(lengths), dtype=np.int64)
            for i, n in enumerate(lengths.tolist()):
                if filled and filled + n > size:
                    chunk, filled = chunk + 1, 0
                filled += n + 8
                at[i] = chunk
            yield pa.RecordBatch.from_arrays([pa.array(at), *batch.columns], names=schema.names)

    buckets = min(MAX_BUCKETS, max(1, 2 * docs.rdd.getNumPartitions()))
    table, path = _folder(spark, name)
    writer = per_batch(packed, number, schema).write.option("path", path).option("compression", "zstd")
    writer.bucketBy(buckets, "_chunk").sortBy("_chunk").saveAsTable(table)
    return spark.table(table)


# Functions go in as plain lambdas, since Spark reads the hints of what it is given.
Rows = Callable[[tuple, pa.Table], pa.Table]


def per_batch(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``fn(batches)`` for each partition."""

    def run(batches):
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


def per_chunk(chunks: DataFrame, fn: Rows, schema: str | StructType) -> DataFrame:
    """``fn(key, rows)`` for each chunk."""
    return chunks.groupBy("_chunk").applyInArrow(lambda key, rows: _lightly(fn, key, rows), schema)


def per_chunk_with(chunks: DataFrame, answers: DataFrame, fn, schema: str | StructType) -> DataFrame:
    """``fn(key, rows, answers)`` for each chunk; only the answers are shuffled."""
    return chunks.groupBy("_chunk").cogroup(answers.groupBy("_chunk")).applyInArrow(
        lambda key, rows, told: _lightly(fn, key, rows, told), schema
    )


def per_shard(asked: DataFrame, fn: Rows, schema: str | StructType) -> DataFrame:
    """``fn(key, rows)`` for each shard."""
    return asked.groupBy("shard").applyInArrow(lambda key, rows: _lightly(fn, key, rows), schema)


def shard_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Shards of 64-bit keys, ascending with the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def cuts(shard: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` shards begins in ascending ``shard``, and the end."""
    return np.searchsorted(shard, np.arange(n + 1, dtype=shard.dtype))


def blobs(column: pa.ChunkedArray, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=dtype) for x in column]


class Texts:
    """The texts of a chunk as one byte array with offsets; null texts are empty."""

    def __init__(self, table: pa.Table):
        column = table.column("_text")
        array = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.large_binary())
        array = array.fill_null(b"")
        _, offsets, data = array.buffers()
        n = len(array)
        at = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        self.data = raw[at[0] : at[-1]]
        self.offsets = at - at[0]
        ids = table.column("_id").combine_chunks()
        # A row without id comes after all others and is nobody's earlier row.
        self.ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False).astype(np.int64)
        self.null_text = column.is_null().to_numpy() if n else np.zeros(0, bool)

    def __len__(self) -> int:
        return len(self.offsets) - 1


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as the first one and differences of as few bytes as the largest needs."""
    if not len(values):
        return b""
    steps = np.diff(values)
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + values[:1].tobytes() + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def unpack_sorted(data) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    width = int(raw[0])
    steps = np.zeros(((len(raw) - 9) // width + 1, 8), np.uint8)
    steps[0] = raw[1:9]
    steps[1:, :width] = raw[9:].reshape(-1, width)
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)
