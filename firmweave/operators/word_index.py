"""A word index of a text column: which rows hold a word, without reading the texts.

A word's postings are the ascending row numbers that hold it, packed, in blocks of a fixed range of numbers, so the postings of a word that
most rows hold are many rows of the index. Words lie in folders by a hash, sorted by word, so a search reads the folders of its words, and in
them the row groups that may hold them. Several words are intersected block by block, shortest postings first.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Row numbers of a block, and words and rows (together) that a folder holds, about.
BLOCK = 1 << 20
FOLDER_ROWS = 1 << 20
_PARTS = "word_bucket"
_SCHEMA = f"word string, block bigint, rows bigint, ids binary, {_PARTS} int"


def words_of(text: Column) -> Column:
    """Different lower-cased words, split at other characters, no stemming."""
    return F.array_distinct(F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != ""))


def _pack(ids: np.ndarray, size: int) -> bytes:
    """Ascending numbers of one block of ``size`` as offsets within it, in three bytes each."""
    return np.ascontiguousarray((ids % size).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


def _unpack(data: bytes, first: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, 3)
    wide = np.zeros((len(raw), 4), np.uint8)
    wide[:, :3] = raw
    return wide.view("<u4").ravel().astype(np.int64) + first


def intersect(lists: list[np.ndarray]) -> np.ndarray:
    """Numbers that all ascending lists hold: the shortest one is looked up in the others, each time by what is left."""
    lists = sorted(lists, key=len)
    left = lists[0]
    for other in lists[1:]:
        at = np.searchsorted(other, left)
        left = left[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] == left)] if len(other) else other
    return left


def _packed(key, table: pa.Table, size: int) -> pa.Table:
    """The postings of a folder's words that fall in one block of row numbers."""
    # Dealt by (folder, block): one pass over sorted (word, number), a row of the index for each word.
    table = table.sort_by([("word", "ascending"), ("id", "ascending")])
    words = table.column("word").combine_chunks().dictionary_encode()
    codes = (words if isinstance(words, pa.DictionaryArray) else words.combine_chunks()).indices.to_numpy(zero_copy_only=False)
    ids = table.column("id").to_numpy()
    heads = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(ids) else np.zeros(0, np.int64)
    ends = np.append(heads[1:], len(ids))
    lists = [np.unique(ids[a:b]) for a, b in zip(heads, ends)]
    folder, block = key[0].as_py(), key[1].as_py()
    out = {"word": table.column("word").take(pa.array(heads)), "block": pa.array([block] * len(heads), pa.int64())}
    out |= {"rows": pa.array([len(x) for x in lists], pa.int64()), "ids": pa.array([_pack(x, size) for x in lists], pa.binary())}
    return pa.table(out | {_PARTS: pa.array([folder] * len(heads), pa.int32())})


def build_index(df: DataFrame, path: str, text: str, number: str = "id", folders: int | None = None) -> int:
    """Write the index of column ``text`` under ``path``; returns the number of folders.

    ``number`` is a column of different whole numbers from 0. Null texts and numbers are not indexed. Folders are as many as keep each
    at about FOLDER_ROWS postings, so what one word's search reads does not grow with the table.
    """
    held = df.select(F.col(number).cast("bigint").alias("id"), F.explode(words_of(F.col(text))).alias("word")).where("id IS NOT NULL")
    if folders is None:
        folders = max(1, -(-held.count() // FOLDER_ROWS))
    bucket = F.pmod(F.xxhash64("word"), F.lit(folders)).cast("int")
    dealt = held.select("word", "id", bucket.alias(_PARTS), F.floor(F.col("id") / BLOCK).cast("bigint").alias("block"))
    # A folder's block holds at most the words of BLOCK rows; a hot word is dealt by its blocks.
    size = BLOCK  # goes along to the tasks
    packed = dealt.groupBy(_PARTS, "block").applyInArrow(lambda key, rows: _packed(key, rows, size), _SCHEMA)
    laid = packed.repartition(F.col(_PARTS), F.col("block")).sortWithinPartitions(_PARTS, "word", "block")
    laid.write.mode("overwrite").option("parquet.block.size", 1 << 20).partitionBy(_PARTS).parquet(path)
    return folders


def search(spark: SparkSession, path: str, words: Sequence[str], folders: int) -> DataFrame:
    """``id`` of the rows that hold all ``words`` (any case); none if there are no words."""
    wanted = sorted({w.lower() for w in words})
    if not wanted:
        return spark.createDataFrame([], "id bigint")
    index = spark.read.schema(_SCHEMA).parquet(path)
    # Folders as literals: others are not even listed to be read.
    places = [r[0] for r in spark.createDataFrame([(w,) for w in wanted], "word string").select(F.pmod(F.xxhash64("word"), F.lit(folders)).cast("int")).collect()]
    found = index.where(F.col(_PARTS).isin(*places) & F.col("word").isin(*wanted)).select("word", "block", "ids")
    n, size = len(wanted), BLOCK

    def meet(key, table):
        first = key[0].as_py() * size
        lists: dict[str, list[np.ndarray]] = {}
        for word, ids in zip(table.column("word").to_pylist(), table.column("ids").to_pylist(), strict=True):
            lists.setdefault(word, []).append(_unpack(ids, first))
        left = intersect([np.concatenate(x) for x in lists.values()]) if len(lists) == n else np.zeros(0, np.int64)
        return pa.table({"id": pa.array(left)})

    return found.groupBy("block").applyInArrow(lambda key, rows: meet(key, rows), "id bigint")
