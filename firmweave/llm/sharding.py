"""Sharding by weighted rendezvous hashing of record keys.

Each shard draws a number for each key from a hash of both, and the key goes to the shard that draws highest; the draw of shard i
is -weight / ln(u), with u even in (0, 1), so a shard wins keys in proportion to its weight. A draw depends on nothing but key, shard and weight,
so a further shard (or a raised weight) takes rows only into itself, and a shard that leaves hands out only its own.

The hash is one MD5 of the key and, for each shard, a few multiplications of 32-bit numbers: column expressions only, and any SQL engine can
do the same. Places within a shard come from a range-sorted layout and the counts of its parts, so a shard of any size, or one key
that a third of all rows hold, is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmweave.llm.tables import settle

# Multipliers below 2 ** 31, so that products of 32-bit numbers stay in 64 bits; any odd ones with well-mixed bits would do.
_M1, _M2, _SALT = 0x45D9F3B, 0x2C1B3C6D, 0x3C6EF372
_LOW = 0xFFFFFFFF


def stir(x: int) -> int:
    """The mixing step on plain numbers; makes the constant of each shard."""
    for m in (_M1, _M2):
        x ^= x >> 16
        x = (x * m) & _LOW
    return x ^ (x >> 15)


def _stir(x: Column) -> Column:
    for m in (_M1, _M2):
        x = x.bitwiseXOR(F.shiftright(x, 16))
        x = (x * F.lit(m)).bitwiseAND(F.lit(_LOW))
    return x.bitwiseXOR(F.shiftright(x, 15))


def shard_salt(shard: int) -> int:
    return stir((shard + 1) * _SALT & _LOW)


def _key_bits(keys: Sequence[Column]) -> tuple[Column, Column]:
    """Two 32-bit numbers of the key. Parts are told apart by their lengths, and nulls from empty strings."""
    if len(keys) == 1:
        text = F.coalesce(keys[0].cast("string"), F.lit(""))
    else:
        text = F.concat(*[F.concat_ws(":", F.coalesce(F.char_length(k.cast("string")), F.lit(-1)), F.coalesce(k.cast("string"), F.lit(""))) for k in keys])
    digest = F.md5(text)
    return tuple(F.conv(F.substring(digest, at, 8), 16, 10).cast("bigint") for at in (1, 9))


def _draw(a: Column, b: Column, shard: int, weight: float) -> Column:
    mixed = _stir(a.bitwiseXOR(F.lit(shard_salt(shard)).cast("bigint")))
    mixed = _stir((mixed + b).bitwiseAND(F.lit(_LOW)))
    u = (mixed.cast("double") + 0.5) / float(1 << 32)
    return F.lit(-float(weight)) / F.log(u)


def shard_of_key(keys: Sequence[Column], weights: Sequence[float]) -> tuple[list[Column], callable]:
    """Columns to be made first (two numbers of the key), and from their names the shard (int) as a column.

    Shards are numbered 0, 1, … as ``weights`` are listed; a weight of 0 takes no rows. Of equal draws the lower shard wins, so a further
    shard never takes a row by a tie.
    """
    used = [(i, w) for i, w in enumerate(weights) if w > 0]
    if not used or any(w < 0 for w in weights):
        raise ValueError("weights are not negative, and at least one is positive")
    a, b = _key_bits(keys)

    def shard(a_name: str, b_name: str) -> Column:
        draws = [F.struct(_draw(F.col(a_name), F.col(b_name), i, w).alias("draw"), F.lit(-i).alias("place")) for i, w in used]
        best = F.greatest(*draws) if len(draws) > 1 else draws[0]
        return (-best["place"]).cast("int")

    return [a, b], shard


def assign_shards(docs: DataFrame, weights: Sequence[float], keys: Sequence[str] = ("doc_id",), out: str = "shard") -> DataFrame:
    """``docs`` with column ``out``, the shard (0 to ``len(weights)`` - 1) of each row by its ``keys``.

    Key and weights alone decide: rows of one key share a shard, whatever else they hold. Null keys are one key, which of a
    single key column is the same as the empty string. Rows are neither moved nor dropped; a column that is named like ``out`` is replaced.
    An empty table gives an empty result.
    """
    (a, b), shard = shard_of_key([F.col(f"`{k}`") for k in keys], weights)
    kept = [c for c in docs.columns if c != out]
    # Names that no column of the input has, whatever they are.
    fresh = [f"{n}{max((len(c) for c in docs.columns), default=0) * '_'}" for n in ("_a", "_b")]
    made = docs.withColumns(dict(zip(fresh, (a, b), strict=True)))
    return made.select(*[F.col(f"`{c}`") for c in kept], shard(*fresh).alias(out))


def number_slots(sharded: DataFrame, order: Sequence[str] = ("doc_id",), shard: str = "shard", out: str = "slot") -> DataFrame:
    """``sharded`` with column ``out``: places 0, 1, … without gaps within each ``shard``, in the order of the ``order`` columns (nulls first).

    Rows that tie in ``order`` take neighbouring places in no stated order. Ranges of (shard, order) go to tasks, and ties are dealt over several. The
    layout is written once to the shared folder, so counts and places see the same one, also after executors are lost; the counts have as many rows
    as parts and shards together. A column that is named like ``out`` is replaced. An empty table gives an empty result.
    """
    kept = [c for c in sharded.columns if c != out]
    safe = {c: f"_c{i}" for i, c in enumerate(kept)}
    rows = sharded.select(*[F.col(f"`{c}`").alias(safe[c]) for c in kept], F.monotonically_increasing_id().alias("_tie"))
    rows = settle(rows, "unplaced")  # ranges are sampled before rows are moved: ``sharded`` is computed once for both
    by = [safe[shard], *[safe[c] for c in order], "_tie"]
    laid = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    laid = settle(laid.withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), "slots")
    counts = laid.groupBy("_part", F.col(safe[shard]).alias("_shard")).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", "_shard", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = laid.join(F.broadcast(starts), (laid["_part"] == starts["_part"]) & laid[safe[shard]].eqNullSafe(starts["_shard"]))
    return placed.select(*[F.col(safe[c]).alias(c) for c in kept], (F.col("_row") + F.col("_shift")).alias(out))


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], keys: Sequence[str] = ("doc_id",), rows_per_file: int = 1_000_000) -> None:
    """Write whole rows of ``docs`` as Parquet under ``path``, one folder ``shard=<i>`` for each shard that has rows.

    Rows are dealt by (shard, salt), so a shard's files come from several tasks and none holds more than ``rows_per_file`` rows.
    """
    sharded = assign_shards(docs, weights, keys)
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(16))
    writer = sharded.repartition(F.col("shard"), salt).write.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy("shard").parquet(path)
