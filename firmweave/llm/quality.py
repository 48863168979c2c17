"""Quality classifier by hierarchical empirical Bayes: evidence of the document, shrunk posteriors of its site and path.

Two traits are judged alike: low quality and toxicity. A document's evidence is a log-likelihood ratio: the logit of a regression on
the features it has, less the log odds of the sample. Labelled documents of a path (here ``source`` and ``lang``) give its rate of the trait, shrunk toward the rate of its site, which is
shrunk toward the global rate; how strongly is estimated from how much sites (paths) differ. The document is rejected where
evidence and prior together make a trait likely enough.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from firmweave.llm.memo import Memo
from firmweave.llm.tables import bound_batches, per_batch, settle

TRAITS = ("low", "toxic")
# Labels that the document classifier is fitted on, about (those with the smallest hash of their id), and bound of its features
# (the most telling). Rates of sites and paths are counted over all labelled documents.
MAX_LABELLED = 20_000
MAX_FEATURES = 20_000
# A feature must be in so many labelled documents, and tell so much (G statistic; 15 is one in ten thousand by chance).
LEAST_DOCUMENTS = 5
# A document goes from this probability of a trait on: a bad one kept costs more than a good one lost.
THRESHOLD = 0.2
LEAST_G = 15.0

_EDGES = "".join(chr(c) for c in range(0x20, 0x7F) if not chr(c).isalnum()) + "«»„“”‘’…–—¿¡"
_RUN = re.compile(r"(.)\1+")
_SHARES = (0.0, 0.02, 0.1, 0.3)
# Pull of the weights toward none, and steps of the fit.
_RIDGE = 0.2
_STEPS = 150
# Words a worker remembers, and features it counts before it passes them on.
_MEMO = 300_000
_HELD = 300_000


class _Kinds(dict):
    """Kind of each character, for ``str.translate``."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return kind


_KINDS = _Kinds()


@lru_cache(1 << 14)
def _closed_up(kinds: str) -> str:
    return _RUN.sub(r"\1", kinds)[:6]


def shape(word: str) -> str:
    """Kinds of characters in order, repeats closed up: letters as A or a, digits as 0, others as they are."""
    return _closed_up(word[:40].translate(_KINDS))


def word_features(word: str) -> list[str]:
    core = word.strip(_EDGES).lower()
    if not core:
        return []
    return [f"w {core}", *(f"b{n} {core[:n]}" for n in (4, 5) if len(core) > n)]


def _steps(name: str, value: float, cuts: tuple[float, ...] = (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)) -> list[str]:
    return [f"{name} {c}" for c in cuts if value >= c]


def text_features(words: list[str], counts: Counter, text: str) -> list[str]:
    """Features of the text as a whole: its length, how much repeats, and what its characters are."""
    out = [f"length {int(math.log2(len(words) + 1))}"]
    if words:
        out += _steps("same word again", sum(map(operator.eq, words, words[1:])) / len(words))
        out += _steps("different words", len(counts) / len(words))
        out += _steps("commonest word", max(counts.values()) / len(words))
        out += _steps("upper case", sum(map(str.isupper, words)) / len(words))
        lines = text.split("\n")
        out += _steps("same lines", 1 - len(set(lines)) / len(lines))
        out += [f"word length {int(len(text) / len(words))}"]
    return out


def shape_features(shapes: dict[str, int], total: int) -> list[str]:
    return [f"s{least} {s}" for s, n in shapes.items() for least in _SHARES if n >= least * total]


_SEEN = Memo(_MEMO, group="quality")


def _word(words: list[str]) -> list[tuple]:
    return [(word_features(w), shape(w)) for w in words]


def features(text: str | None) -> set[str]:
    words = (text or "").split()
    counts = Counter(words)
    get = _SEEN.lookup(set(counts), _word).__getitem__
    shapes: dict[str, int] = {}
    out = set(text_features(words, counts, text or ""))
    for word, n in counts.items():
        known, s = get(word)
        out.update(known)
        shapes[s] = shapes.get(s, 0) + n
    out.update(shape_features(shapes, len(words)))
    return out


def telling_features(labelled: DataFrame, max_features: int = MAX_FEATURES) -> list[str]:
    """The features that labelled documents (``text`` and the traits, 0 or 1) show to tell a trait best."""

    def run(batches):
        counts = [Counter() for _ in range(1 + len(TRAITS))]

        def told():
            found = list(counts[0])
            columns = [pa.array([c[f] for f in found], pa.int64()) for c in counts]
            return pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *columns], names=["f", "n", *TRAITS])

        for batch in batches:
            for text, *traits in zip(*(batch.column(c).to_pylist() for c in ("text", *TRAITS)), strict=True):
                found = features(text)
                for counter, has in zip(counts, (1, *traits), strict=True):
                    if has:
                        counter.update(found)
            if len(counts[0]) > _HELD:
                yield told()
                counts = [Counter() for _ in counts]
        yield told()

    totals = labelled.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TRAITS]).first()
    counted = per_batch(labelled, run, "f string, n bigint, low bigint, toxic bigint").groupBy("f")
    counted = counted.agg(*[F.sum(c).alias(c) for c in ("n", *TRAITS)]).where(F.col("n") >= LEAST_DOCUMENTS)
    tells = [F.lit(0.0)]
    for t in TRAITS:
        rate = totals[t] / max(1, totals["n"])
        if 0 < rate < 1:
            yes, no = F.col(t).cast("double"), (F.col("n") - F.col(t)).cast("double")
            parts = [F.when(x > 0, x * F.log(x / (F.col("n") * r))).otherwise(0.0) for x, r in ((yes, rate), (no, 1 - rate))]
            tells.append(2 * (parts[0] + parts[1]))
    rows = counted.select("f", F.greatest(F.lit(0.0), *tells).alias("g")).where(F.col("g") >= LEAST_G)
    return [r.f for r in rows.orderBy(F.desc("g"), "f").limit(max_features).collect()]


def fit_weights(labelled: DataFrame, max_features: int = MAX_FEATURES) -> dict[str, list[float]]:
    """Weights of the telling features, and of "" for all texts: logistic regression, less the log odds of the sample.

    Of each labelled document (MAX_LABELLED about) the driver gets the numbers of its telling features, not the text.
    """
    bound_batches(labelled.sparkSession)
    labelled = labelled.select("text", *TRAITS)
    names = telling_features(labelled, max_features)
    if not names:
        return {"": [0.0] * len(TRAITS)}
    sent = labelled.sparkSession.sparkContext.broadcast({f: [k] for k, f in enumerate(names)})

    def run(batches):
        scorer = Scorer(sent.value)
        for batch in batches:
            found = [sorted(k for f in fs for k in sent.value[f]) for fs in scorer.found(batch.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1), batch.column(2)], names=["found", *TRAITS])

    table = per_batch(labelled, run, "found array<int>, low int, toxic int").toArrow()
    column = table.column("found").combine_chunks()
    flat = column.flatten().to_numpy()
    rows = np.repeat(np.arange(len(column)), pa.compute.list_value_length(column).to_numpy())
    fitted = [_logistic(flat, rows, len(names), table.column(t).to_numpy()) for t in TRAITS]
    return {f: [float(w[k]) for w in fitted] for k, f in enumerate([*names, ""])}


def _logistic(flat: np.ndarray, rows: np.ndarray, n: int, y: np.ndarray) -> np.ndarray:
    """Weights of ``n`` binary features and a constant, the log odds of ``y`` taken off it."""
    m = len(y)
    if not 0 < y.sum() < m:
        return np.zeros(n + 1)
    odds = math.log(y.sum() / (m - y.sum()))
    w = np.zeros(n + 1)
    mean, square = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, _STEPS + 1):
        logit = odds + w[n] + np.bincount(rows, w[flat], m)
        off = 1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y
        slope = np.append(np.bincount(flat, off[rows], n), off.sum()) + _RIDGE * w
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        w -= 0.1 * (1 - step / (_STEPS + 1)) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w


class Scorer:
    """Telling features of texts, and the sums of their weights; what a word shows is remembered."""

    def __init__(self, weights: dict[str, list[float]]):
        self.weights = weights
        # Shares of each shape that tell, with their features; and the weights by trait.
        self.shapes: dict[str, list[tuple[float, str]]] = {}
        for s in {f.split(" ", 1)[1] for f in weights if f[:1] == "s" and " " in f}:
            self.shapes[s] = [(least, f) for least in _SHARES if (f := f"s{least} {s}") in weights]
        self.by_trait = [{f: w[i] for f, w in weights.items()} for i in range(len(TRAITS))] if "" in weights else []
        self.memo = Memo(_MEMO, group="quality")

    def _of(self, words: list[str]) -> list[tuple]:
        out = []
        for word in words:
            known = tuple(f for f in word_features(word) if f in self.weights)
            s = shape(word)
            out.append((known, s if s in self.shapes else None))
        return out

    def found(self, texts: list[str | None]) -> list[set[str]]:
        split = [(t or "").split() for t in texts]
        counted = [Counter(w) for w in split]
        get = self.memo.lookup(set().union(*counted), self._of).__getitem__
        out = []
        for words, counts, text in zip(split, counted, texts, strict=True):
            found = {f for f in text_features(words, counts, text or "") if f in self.weights}
            shapes: dict[str, int] = {}
            known = list(map(get, counts))
            found.update(*[features for features, _ in known])
            for (_, s), n in zip(known, counts.values(), strict=True):
                if s is not None:
                    shapes[s] = shapes.get(s, 0) + n
            for s, n in shapes.items():
                found.update([f for least, f in self.shapes[s] if n >= least * len(words)])
            out.append(found)
        return out

    def evidence(self, texts: list[str | None]) -> list[list[float]]:
        out = []
        for found in self.found(texts):
            found.add("")
            # ``fsum`` is exact, so features come in any order.
            out.append([math.fsum(map(weights.__getitem__, found)) for weights in self.by_trait])
        return out


def add_evidence(docs: DataFrame, weights: dict[str, list[float]]) -> DataFrame:
    """``docs`` with ``evidence_low`` and ``evidence_toxic`` of the whole ``text``."""
    spark = docs.sparkSession
    bound_batches(spark)
    sent = spark.sparkContext.broadcast(weights)  # at most MAX_FEATURES
    names = [f"evidence_{t}" for t in TRAITS]
    schema = StructType([*[f for f in docs.schema if f.name not in names], *[StructField(n, DoubleType()) for n in names]])
    held: list[Scorer] = []

    def run(batches):
        if not held:
            held.append(Scorer(sent.value))
        for batch in batches:
            got = held[0].evidence(batch.column(batch.schema.names.index("text")).to_pylist())
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n not in names]
            columns = np.array(got, float).reshape(-1, len(TRAITS)).T
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, columns)], names=schema.names)

    return per_batch(docs, run, schema)


def _strength(rates: DataFrame, trait: str, prior: Column) -> Column:
    """How many labelled documents the prior is worth, by the method of moments over groups (``n``, ``trait``)."""
    n, hits = F.col("n").cast("double"), F.col(trait).cast("double")
    # Excess of the squared distance from the prior over what chance alone gives; no excess: the prior is worth very much.
    chance = F.sum(n * prior * (1 - prior))
    excess = F.sum((hits - n * prior) * (hits - n * prior)) - chance
    room = F.sum(n * (n - 1) * prior * (1 - prior))
    share = F.coalesce(F.try_divide(excess, room), F.lit(0.0))
    return F.least(F.greatest(1 / F.greatest(share, F.lit(1e-4)) - 1, F.lit(1.0)), F.lit(1e4)).alias(f"worth_{trait}")


def site_posteriors(labelled: DataFrame) -> DataFrame:
    """``site``, ``path``, ``n``, and rates ``rate_low``, ``rate_toxic`` of each path, shrunk toward its site, toward all.

    ``labelled``: ``site``, ``path`` and the traits, one row a labelled document. Also a row for each site with a null
    ``path`` and one with both null, for paths and sites without labels.
    """
    counts = [F.sum(t).alias(t) for t in TRAITS]
    paths = labelled.groupBy("site", "path").agg(F.count(F.lit(1)).alias("n"), *counts)
    paths = settle(paths, "paths")
    sites = paths.groupBy("site").agg(F.sum("n").alias("n"), *counts)
    whole = sites.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.coalesce(F.sum(t), F.lit(0)).alias(t) for t in TRAITS]).first()
    base = {t: (whole[t] + 0.5) / (whole["n"] + 1.0) for t in TRAITS}
    worth = sites.agg(*[_strength(sites, t, F.lit(base[t])) for t in TRAITS]).first()
    strength = {t: worth[f"worth_{t}"] or 1e4 for t in TRAITS}
    shrunk = [((F.col(t) + strength[t] * base[t]) / (F.col("n") + strength[t])).alias(f"rate_{t}") for t in TRAITS]
    sites = settle(sites.select("site", "n", *shrunk), "sites")
    placed = paths.join(sites.drop("n"), "site")
    worth = placed.agg(*[_strength(placed, t, F.col(f"rate_{t}")) for t in TRAITS]).first()
    strength = {t: worth[f"worth_{t}"] or 1e4 for t in TRAITS}
    rates = [((F.col(t) + strength[t] * F.col(f"rate_{t}")) / (F.col("n") + strength[t])).alias(f"rate_{t}") for t in TRAITS]
    nothing = F.lit(None).cast("string")
    top = labelled.sparkSession.range(1).select(
        nothing.alias("site"), nothing.alias("path"), F.lit(whole["n"]).cast("bigint").alias("n"), *[F.lit(base[t]).alias(f"rate_{t}") for t in TRAITS]
    )
    low = placed.select("site", "path", "n", *rates)
    middle = sites.select("site", nothing.alias("path"), "n", *[f"rate_{t}" for t in TRAITS])
    return settle(low.unionByName(middle).unionByName(top), "posteriors")


def _sample(traits: DataFrame, size: int) -> DataFrame:
    """About ``size`` labels, or all if there are no more."""
    total = traits.count()
    if total <= size:
        return traits
    return traits.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * size / total))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    site: str = "source",
    path: str = "lang",
    max_labelled: int = MAX_LABELLED,
    max_features: int = MAX_FEATURES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``docs`` with ``p_low``, ``p_toxic`` and ``rejected`` (either above ``threshold``).

    ``docs``: ``doc_id``, ``text``, ``site`` and ``path`` columns and any others; ``labels``: ``doc_id``, ``quality`` (0: low), ``toxic`` (1:
    toxic). Labels without id or with both values null are not used, a single null value is taken as good; of repeated labels of an
    id the worse counts; a labelled id on several rows labels each of them.

    Null or empty texts have only the evidence of having no words; a null site or path is a site or path of its own name (empty). Without labels
    nothing is rejected. Rows are judged one by one and none is lost; added columns win over their namesakes.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    traits = usable.groupBy("doc_id").agg(
        F.max((F.coalesce("quality", F.lit(1)) == 0).cast("int")).alias("low"), F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic")
    )
    added = ["p_low", "p_toxic", "rejected"]
    names = {c: f"_column{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    rows = docs.withColumnsRenamed(names)
    keys = {"site": F.coalesce(F.col(names[site]).cast("string"), F.lit("")), "path": F.coalesce(F.col(names[path]).cast("string"), F.lit(""))}
    traits = settle(traits, "traits")
    labelled = rows.select("doc_id", *[c.alias(k) for k, c in keys.items()]).join(traits, "doc_id")
    sites = site_posteriors(labelled.select("site", "path", *TRAITS))
    weights = fit_weights(rows.select("doc_id", "text").join(F.broadcast(_sample(traits, max_labelled)), "doc_id"), max_features)
    judged = add_evidence(rows.withColumns(keys), weights)
    rates = [f"rate_{t}" for t in TRAITS]

    def level(where: str, on: list[str], suffix: str) -> DataFrame:
        return sites.where(where).select(*on, *[F.col(r).alias(r + suffix) for r in rates])

    judged = judged.join(level("path IS NOT NULL", ["site", "path"], "_path"), ["site", "path"], "left")
    judged = judged.join(level("path IS NULL AND site IS NOT NULL", ["site"], "_site"), "site", "left")
    base = sites.where("site IS NULL").first()  # one row
    for t in TRAITS:
        rate = F.coalesce(f"rate_{t}_path", f"rate_{t}_site", F.lit(base[f"rate_{t}"]))
        logit = F.col(f"evidence_{t}") + F.log(rate / (1 - rate))
        judged = judged.withColumn(f"p_{t}", 1 / (1 + F.exp(-logit)))
    rejected = ((F.col("p_low") > threshold) | (F.col("p_toxic") > threshold)) if base["n"] else F.lit(False)
    kept = [F.col(names.get(c, c)).alias(c) for c in docs.columns if c not in added]
    return judged.select(*kept, "p_low", "p_toxic", rejected.alias("rejected"))


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that are not rejected; their columns stay as they are."""
    names = {c: f"_doc{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "source", "lang")}
    found = judge(docs.withColumnsRenamed(names), labels, **options).where(~F.col("rejected"))
    return found.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])
