"""Similarity join of two sets of distinct names, without comparing all pairs.

Every pair whose similarity reaches the floor is found (no loss); other pairs are
thrown out by conditions that Spark evaluates inside the join:

* Two names that reach the floor have at least L matched characters, in at most
  ``1 + gaps`` runs. A run of n characters gives n - 1 common bigrams (n unigrams),
  so the pair has at least ``need`` common tokens at compatible positions.
* Prefix filter: with tokens in one global order, such a pair must share a token among
  the first (tokens - need + 1) of each side. Tokens that would bring the fewest pairs
  together come first (those that one side lacks bring none).
* Lengths, positions, ranks and the count of shared characters are checked in
  the join condition, as integers.

The edit measure at floors from ``LEAST_FLOOR`` up goes through segments of names instead (``segment_join``).

Token frequencies are held in a fixed number of hash buckets, so what the driver
sees does not grow with the data. The same counts give the fan-out of hot tokens.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmweave.functions.matching_blocks import ratios
from firmweave.functions.similarity import (
    EPSILON,
    MASKS,
    count_masks,
    edit_similarity,
    ratio,
    shared_characters,
)
from firmweave.operators.segment_join import LEAST_FLOOR, probe_rows, segment_rows, within_floor
from firmweave.session import cut_lineage

BUCKETS = 1024
# Tokens of one kind that may meet in one task, on either side.
GROUP_ROWS = 20_000
# Tasks among which the pairs of one site may be divided.
SHARES = 8
# Segments of a register whose hashes (8 bytes each) every task may hold, to drop what matches none; larger registers do without.
FEW_ROWS = 1_000_000


@dataclass(frozen=True)
class Measure:
    """What a similarity floor implies for a pair of lengths.

    ``floor`` holds for all pairs; a site may have a higher one of its own, its ``low``.
    ``least`` is the least number of matched characters, as a real number: integers are
    compared with it directly, so the join condition needs no rounding and no division.
    """

    name: str
    floor: float

    def least(self, left: str, right: str) -> Column:
        """``left`` is the site, whose floor counts."""
        a, b = F.col(f"{left}.len"), F.col(f"{right}.len")
        total = a + b if self.name == "ratio" else F.greatest(a, b)
        return total * F.col(f"{left}.part") - F.lit(EPSILON)

    def may_match(self, left: str, right: str, q: int) -> Column:
        """Lengths, positions and ranks of a shared token that a matching pair can have."""
        a, b = F.col(f"{left}.len"), F.col(f"{right}.len")
        least = self.least(left, right)
        ahead = F.col(f"{left}.pos") - F.col(f"{right}.pos")
        # Characters left unmatched on a side limit how far tokens can drift apart.
        if self.name == "ratio":
            drift = (ahead <= a - least) & (-ahead <= b - least)
            need = (2 * q - 1) * least - (q - 1) * (1 + a + b)
        else:
            longer = F.greatest(a, b)
            drift = F.abs(ahead) <= longer - least
            need = q * least - (q - 1) * (1 + longer)
        ranks = (F.col(f"{left}.rank") <= a - (q - 1) - need) & (F.col(f"{right}.rank") <= b - (q - 1) - need)
        return (a >= least) & (b >= least) & drift & ranks

    def bound(self, shared: Column, left: str, right: str) -> Column:
        """Upper bound of the similarity, given an upper bound of the shared characters."""
        a, b = F.col(f"{left}.len"), F.col(f"{right}.len")
        return 2 * shared / (a + b) if self.name == "ratio" else shared / F.greatest(a, b)

    def tighter(self, bound: Column) -> Column:
        """The bound, lowered by the edit distance: each edit leaves a character unmatched."""
        a, b = F.col("site_name"), F.col("register_name")
        edits = F.levenshtein(a, b)
        if self.name == "ratio":
            return F.least(bound, 1 - edits / (F.length(a) + F.length(b)))
        return F.least(bound, 1 - edits / F.greatest(F.length(a), F.length(b)))

    def least_need(self, length: Column, q: int, f: Column) -> Column:
        """Lower bound, over all partners that fit the floor ``f``, of the tokens a pair must share."""
        if self.name == "ratio":
            shortest = length * (1 + f / (2 - f))
            low = shortest * (f / 2 - (q - 1) * (1 - f)) - F.lit(q - 1)
        else:
            low = length * (f - (q - 1) * (1 - f)) - F.lit(q - 1)
        return F.greatest(F.lit(1), F.ceil(low - F.lit(1e-6)).cast("int"))

    def token_size(self) -> int:
        """2 (bigrams) when every fitting pair must share one, else 1."""
        f = self.floor
        for a in range(1, 120):
            for b in range(a, 160):
                if self.name == "ratio":
                    fits, matched = 2 * a >= f * (a + b) - EPSILON, math.ceil((a + b) / 2 * f - EPSILON)
                    gaps = a + b - 2 * matched
                else:
                    fits, matched = a >= f * b - EPSILON, math.ceil(b * f - EPSILON)
                    gaps = b - matched
                # One-character names can only be equal; the exact tier has those.
                if fits and b > 1 and matched - (1 + gaps) < 1:
                    return 1
        return 2

    def score(self) -> Column:
        """Similarity of a pair that came through ``tighter``, which is exact for edit distance."""
        return ratio(F.col("site_name"), F.col("register_name")) if self.name == "ratio" else F.col("bound")


def _bucket(token: Column) -> Column:
    return F.pmod(F.hash(token), F.lit(BUCKETS))


def _grams(name: Column, q: int) -> Column:
    last = F.length(name) - (q - 1)
    positions = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(positions, lambda p: F.substring(name, p, q))


def token_counts(sites: DataFrame, register: DataFrame) -> tuple[list[int], list[int]]:
    """Frequencies of column ``token`` on both sides by hash bucket: at most 2 x BUCKETS numbers."""
    sides = [df.select(F.lit(side).alias("side"), "token") for side, df in ((0, sites), (1, register))]
    rows = (
        sides[0]
        .unionByName(sides[1])
        .groupBy("side", _bucket(F.col("token")).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .collect()
    )
    counts = ([0] * BUCKETS, [0] * BUCKETS)
    for row in rows:
        counts[row["side"]][row["bucket"]] = row["rows"]
    return counts


def name_tokens(names: DataFrame, q: int) -> DataFrame:
    return names.select(F.explode(_grams(F.col("name"), q)).alias("token"))


def bucket_value(values: list[int], token: Column) -> Column:
    table = F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    return F.element_at(table, _bucket(token) + 1)


def fan_out(counts: list[int], group_rows: int) -> list[int]:
    return [max(1, math.ceil(count / group_rows)) for count in counts]


def prefix_rows(names: DataFrame, q: int, measure: Measure, order: list[int]) -> DataFrame:
    """One row for each token in the prefix of a name, with all that the join checks."""
    masks, over = count_masks("name")
    low = F.col("low") if "low" in names.columns else F.lit(measure.floor)
    measured = names.select("name", F.length("name").alias("len"), low.cast("double").alias("low")).withColumns(masks).withColumn("over", over)
    measured = measured.withColumn("part", F.col("low") / (2 if measure.name == "ratio" else 1))
    size = F.col("len") - (q - 1)
    positions = F.when(size >= 1, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))

    def token(p: Column) -> Column:
        gram = F.substring(F.col("name"), p, q)
        return F.struct(bucket_value(order, gram).alias("rows"), gram.alias("token"), p.alias("pos"))

    ordered = F.array_sort(F.transform(positions, token))
    taken = F.slice(ordered, F.lit(1), F.greatest(F.lit(0), size - measure.least_need(F.col("len"), q, F.col("low")) + 1))
    # The outer form spares the filter that Spark would add, which sorts the tokens twice.
    exploded = measured.withColumn("_taken", taken).select(
        "name", "len", "low", "part", *MASKS, "over", F.posexplode_outer("_taken").alias("rank", "_t")
    )
    return exploded.select(
        "name", "len", "low", "part", *MASKS, "over", "rank", F.col("_t.token").alias("token"), F.col("_t.pos").alias("pos")
    ).filter(F.col("token").isNotNull())


def _salts(rows: DataFrame, own: str, other: str, own_fan: list[int], other_fan: list[int]) -> DataFrame:
    """Grid of salts for hot tokens: a row holds its own salt and meets every salt of the other side."""
    if max(own_fan) == 1 and max(other_fan) == 1:
        return rows.withColumns({own: F.lit(0), other: F.lit(0)})
    mine = F.pmod(F.xxhash64("name"), bucket_value(own_fan, F.col("token"))).cast("int")
    theirs = F.sequence(F.lit(0), (bucket_value(other_fan, F.col("token")) - 1).cast("int"))
    return rows.withColumn(own, mine).withColumn(other, F.explode(theirs))


def candidate_pairs(
    sites: DataFrame,
    register: DataFrame,
    measure: Measure,
    first_letter: bool = False,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Pairs (site_name, register_name, low, bound, share) that may reach the site's floor; none that does is missing.

    ``bound`` is an upper bound of the similarity. Pairs are laid out by site and ``share``, a
    hash of the register name, so that a site with very many pairs is scored by several tasks.

    Both inputs hold distinct, non-empty names in column ``name``; ``sites`` may hold floors of their
    own in ``low``, not below the measure's. ``first_letter``
    asks for equal first letters in addition (a documented shortcut that loses pairs).
    """
    if measure.name == "edit" and measure.floor >= LEAST_FLOOR:
        return segment_pairs(sites, register, measure, first_letter, group_rows)
    q = measure.token_size()
    if q == 1:
        return bag_pairs(sites, register, measure, first_letter, group_rows)
    site_counts, register_counts = token_counts(name_tokens(sites, q), name_tokens(register, q))
    order = [a * b for a, b in zip(site_counts, register_counts)]
    left, right = prefix_rows(sites, q, measure, order), prefix_rows(register, q, measure, order)
    if max(site_counts) > group_rows or max(register_counts) > group_rows:
        # Some token may be hot; what counts is how often it stands in a prefix.
        site_counts, register_counts = token_counts(left, right)
    site_fan, register_fan = fan_out(site_counts, group_rows), fan_out(register_counts, group_rows)
    left = _salts(left, "salt_s", "salt_r", site_fan, register_fan)
    right = _salts(right, "salt_r", "salt_s", register_fan, site_fan)
    return meeting_pairs(left, right, measure, q, first_letter)


def _bag_tokens(bag: Column) -> Column:
    """Each character of a bag with its number among its kind: two bags share as many tokens as characters."""
    kinds = F.split(bag, "")
    return F.transform(kinds, lambda c, i: F.concat(c, (i + 2 - F.array_position(kinds, c)).cast("string")))


def bag_rows(bags: DataFrame, measure: Measure, order: list[int]) -> DataFrame:
    """One row for each token in the prefix of a bag (``name``, with the ``low`` of its names), with all that the join checks."""
    masks, over = count_masks("name")
    measured = bags.select("name", "low", F.length("name").alias("len")).withColumns(masks).withColumn("over", over)
    measured = measured.withColumn("part", F.col("low") / (2 if measure.name == "ratio" else 1))
    ordered = F.array_sort(F.transform(_bag_tokens(F.col("name")), lambda t: F.struct(bucket_value(order, t).alias("rows"), t.alias("token"))))
    taken = F.slice(ordered, F.lit(1), F.greatest(F.lit(0), F.col("len") - measure.least_need(F.col("len"), 1, F.col("low")) + 1))
    held = ["name", "len", "low", "part", *MASKS, "over"]
    exploded = measured.withColumn("_taken", taken).select(*held, F.posexplode_outer("_taken").alias("rank", "_t"))
    return exploded.select(*held, "rank", F.col("_t.token").alias("token")).filter(F.col("token").isNotNull())


def bag_pairs(sites: DataFrame, register: DataFrame, measure: Measure, first_letter: bool = False, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``candidate_pairs`` at floors where no pair needs a common bigram: only the characters that names hold can be compared.

    Names that hold the same characters (their *bag*) are compared once; the names of the pairs of bags that are left meet the
    edit-distance bound where they come together, before they are shuffled.
    """

    def bagged(names: DataFrame) -> DataFrame:
        low = F.col("low") if "low" in names.columns else F.lit(measure.floor)
        return names.select("name", low.cast("double").alias("low"), F.array_join(F.array_sort(F.split("name", "")), "").alias("bag"))

    def bags(names: DataFrame) -> DataFrame:
        return names.groupBy(F.col("bag").alias("name")).agg(F.min("low").alias("low"))

    def tokens(rows: DataFrame) -> DataFrame:
        return rows.select(F.explode(_bag_tokens(F.col("name"))).alias("token"))

    site_names, register_names = bagged(sites), bagged(register)
    site_bags, register_bags = cut_lineage(bags(site_names)), cut_lineage(bags(register_names))
    site_counts, register_counts = token_counts(tokens(site_bags), tokens(register_bags))
    order = [a * b for a, b in zip(site_counts, register_counts)]
    left, right = bag_rows(site_bags, measure, order), bag_rows(register_bags, measure, order)
    if max(site_counts) > group_rows or max(register_counts) > group_rows:
        site_counts, register_counts = token_counts(left, right)
    site_fan, register_fan = fan_out(site_counts, group_rows), fan_out(register_counts, group_rows)
    left = _salts(left, "salt_s", "salt_r", site_fan, register_fan)
    right = _salts(right, "salt_r", "salt_s", register_fan, site_fan)
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["token", "salt_s", "salt_r"]
    left, right = left.repartition(tasks, *keys).alias("s"), right.repartition(tasks, *keys).alias("r")
    shared, least = shared_characters("s", "r"), measure.least("s", "r")
    a, b = F.col("s.len"), F.col("r.len")
    condition = (a >= least) & (b >= least) & (F.col("s.rank") <= a - least) & (F.col("r.rank") <= b - least) & (shared >= least)
    for key in keys:
        condition = condition & (F.col(f"s.{key}") == F.col(f"r.{key}"))
    met = left.join(right, condition, "inner").select(
        F.col("s.name").alias("site_bag"), F.col("r.name").alias("register_bag"), measure.bound(shared, "s", "r").alias("bound")
    )
    # A pair of bags is found once for each token it shares; the bound is the same each time.
    met = met.repartition(tasks, "site_bag", "register_bag").groupBy("site_bag", "register_bag").agg(F.max("bound").alias("bound"))
    named = met.join(register_names.select(F.col("bag").alias("register_bag"), F.col("name").alias("register_name")), "register_bag")
    named = named.repartition(tasks, "site_bag").join(
        site_names.select(F.col("bag").alias("site_bag"), F.col("name").alias("site_name"), "low"), "site_bag"
    )
    if first_letter:
        named = named.where(F.left(F.col("site_name"), F.lit(1)) == F.left(F.col("register_name"), F.lit(1)))
    named = named.where(F.col("bound") >= F.col("low") - EPSILON)
    pairs = named.select(
        "site_name", "register_name", "low", measure.tighter(F.col("bound")).alias("bound"), F.pmod(F.xxhash64("register_name"), F.lit(SHARES)).alias("share")
    )
    return pairs.where(F.col("bound") >= F.col("low") - EPSILON).repartition(tasks, "site_name", "share")


def segment_pairs(sites: DataFrame, register: DataFrame, measure: Measure, first_letter: bool = False, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``candidate_pairs`` for the edit measure, through segments; the bound is the similarity itself."""
    tasks = int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Names are few bytes and many rows, which AQE would give to few tasks; by a hash of its own, or the layout that is there would do.
    left, right = probe_rows(sites.repartition(tasks, F.xxhash64("name")), measure.floor), cut_lineage(segment_rows(register, measure.floor))
    register_counts = token_counts(left.limit(0), right)[1]
    if sum(register_counts) <= FEW_ROWS:
        # Most places of most names hold no segment: they go where they are made, before any shuffle.
        left = left.join(F.broadcast(right.select("token").distinct()), "token", "left_semi")
    # Each site asks at many places, so their rows are made once.
    left = cut_lineage(left)
    site_counts = token_counts(left, right.limit(0))[0]
    site_fan, register_fan = fan_out(site_counts, group_rows), fan_out(register_counts, group_rows)
    left = _salts(left, "salt_s", "salt_r", site_fan, register_fan)
    right = _salts(right, "salt_r", "salt_s", register_fan, site_fan)
    keys = ["token", "salt_s", "salt_r"]
    left, right = left.repartition(tasks, *keys).alias("s"), right.repartition(tasks, *keys).alias("r")
    shared = shared_characters("s", "r")
    condition = (shared >= F.greatest("s.len", "r.len") * F.col("s.low") - EPSILON) & within_floor("s", "r")
    if first_letter:
        condition = (F.left(F.col("s.name"), F.lit(1)) == F.left(F.col("r.name"), F.lit(1))) & condition
    for key in keys:
        condition = (F.col(f"s.{key}") == F.col(f"r.{key}")) & condition
    pairs = left.join(right, condition, "inner").select(
        F.col("s.name").alias("site_name"),
        F.col("r.name").alias("register_name"),
        F.col("s.low").alias("low"),
        edit_similarity(F.col("s.name"), F.col("r.name")).alias("bound"),
        F.pmod(F.xxhash64("r.name"), F.lit(SHARES)).alias("share"),
    )
    # Few pairs are left, found once for each segment they share. The bound comes from the aggregate, so that no filter
    # on it is moved into the join, before the cheaper conditions.
    return pairs.groupBy("site_name", "register_name", "share").agg(F.max("bound").alias("bound"), F.max("low").alias("low"))


def meeting_pairs(left: DataFrame, right: DataFrame, measure: Measure, q: int, first_letter: bool) -> DataFrame:
    """The pairs of ``candidate_pairs`` from salted prefix rows of sites and register."""
    # A fixed number of tasks: partitions of few bytes can still mean many pairs, and AQE
    # would merge them by bytes.
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["token", "salt_s", "salt_r"]
    left, right = left.repartition(tasks, *keys).alias("s"), right.repartition(tasks, *keys).alias("r")

    shared = shared_characters("s", "r")
    condition = measure.may_match("s", "r", q) & (shared >= measure.least("s", "r"))
    for key in keys:
        condition = condition & (F.col(f"s.{key}") == F.col(f"r.{key}"))
    if first_letter:
        condition = condition & (F.left(F.col("s.name"), F.lit(1)) == F.left(F.col("r.name"), F.lit(1)))
    pairs = left.join(right, condition, "inner").select(
        F.col("s.name").alias("site_name"),
        F.col("r.name").alias("register_name"),
        F.col("s.low").alias("low"),
        measure.bound(shared, "s", "r").alias("bound"),
        F.pmod(F.xxhash64("r.name"), F.lit(SHARES)).alias("share"),
    )
    # A pair is found once for each token it shares; the bound is the same each time. Taking it
    # from the aggregate also keeps Spark from testing scores before pairs are distinct.
    once = (
        pairs.repartition(tasks, "site_name", "share")
        .groupBy("site_name", "register_name", "share")
        .agg(F.max("bound").alias("bound"), F.max("low").alias("low"))
    )
    return once.withColumn("bound", measure.tighter(F.col("bound"))).filter(
        F.col("bound") >= F.col("low") - EPSILON
    )


def similar_pairs(
    sites: DataFrame,
    register: DataFrame,
    measure: Measure,
    first_letter: bool = False,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """All pairs (site_name, register_name, similarity) at or above the floor."""
    pairs = candidate_pairs(sites, register, measure, first_letter, group_rows)
    scored = pairs.select("site_name", "register_name", measure.score().alias("similarity"))
    return scored.filter(F.col("similarity") >= measure.floor)


def best_pairs(pairs: DataFrame, measure: Measure, k: int, below: float | None = None, scored: Accumulator | None = None) -> DataFrame:
    """Pairs (site_name, register_name, similarity) among which are the k best of every site, ties included.

    Takes what ``candidate_pairs`` gives. Each task goes through the pairs of a site by falling
    bound, in waves over all its sites, and leaves out those whose bound is lower than the k-th best similarity
    so far: they cannot be results. Only pairs within floor and ``below`` are kept and counted. ``scored``
    counts the pairs whose similarity is computed.
    """
    floor = measure.floor
    if measure.name != "ratio":
        done = pairs.select("site_name", "register_name", F.col("bound").alias("similarity"))
        usable = F.col("similarity") >= floor
        return done.filter(usable if below is None else usable & (F.col("similarity") < below))

    def score(batches):
        last, carried = None, np.full(k, -1.0)
        for batch in batches:
            site, other, bound = (batch[c].to_numpy() for c in ("site_name", "register_name", "bound"))
            if not len(site):
                continue
            new = np.ones(len(site), bool)
            new[1:] = site[1:] != site[:-1]
            heads = np.flatnonzero(new)
            ends = np.append(heads[1:], len(site))
            best = np.full((len(heads), k), -1.0)
            if site[0] == last:
                best[0] = carried
            values, at, wave = np.full(len(site), -1.0), heads.copy(), max(2, k)
            while True:
                # Sites with pairs left whose bound still reaches their k-th best.
                going = np.flatnonzero(at < ends)
                going = going[bound[at[going]] >= best[going, -1] - EPSILON]
                if not len(going):
                    break
                sizes = np.minimum(wave, ends[going] - at[going])
                owner = np.repeat(going, sizes)
                rows = np.repeat(at[going], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                fine = bound[rows] >= best[owner, -1] - EPSILON
                owner, rows = owner[fine], rows[fine]
                found = ratios(site[rows].tolist(), other[rows].tolist())
                if scored is not None:
                    scored.add(len(rows))
                found[(found < floor) | (found >= (np.inf if below is None else below))] = -1.0
                values[rows] = found
                # The k best of each site: those it had and the best of the wave.
                order = np.lexsort((-found, owner))
                owner, found = owner[order], found[order]
                place = np.arange(len(owner)) - np.searchsorted(owner, owner)
                top = place < k
                more = np.full((len(heads), k), -1.0)
                more[owner[top], place[top]] = found[top]
                best[going] = -np.sort(-np.concatenate([best[going], more[going]], axis=1), axis=1)[:, :k]
                at[going] += sizes
                wave *= 2
            last, carried = site[-1], best[-1]
            kept = values >= 0
            yield pd.DataFrame({"site_name": site[kept], "register_name": other[kept], "similarity": values[kept]})

    fields = [("site_name", T.StringType()), ("register_name", T.StringType()), ("similarity", T.DoubleType())]
    schema = T.StructType([T.StructField(name, kind) for name, kind in fields])
    ordered = pairs.select("site_name", "register_name", "bound").sortWithinPartitions("site_name", F.desc("bound"))
    return ordered.mapInPandas(score, schema)
