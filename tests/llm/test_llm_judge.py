"""The quality classifier against a plain version of all its steps."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("firmweave.llm")

from firmweave.llm import quality  # noqa: E402

CUTS = (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)


def plain_shape(word: str) -> str:
    kinds = ["A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word[:40]]
    return "".join(k for i, k in enumerate(kinds) if i == 0 or kinds[i - 1] != k)[:6]


def plain_features(text: str | None) -> set[str]:
    text = text or ""
    words = text.split()
    found = {f"length {int(math.log2(len(words) + 1))}"}
    if not words:
        return found
    lines = text.split("\n")
    shares = {
        "same word again": sum(a == b for a, b in zip(words, words[1:])) / len(words),
        "different words": len(set(words)) / len(words),
        "commonest word": max(Counter(words).values()) / len(words),
        "upper case": sum(w.isupper() for w in words) / len(words),
        "same lines": 1 - len(set(lines)) / len(lines),
    }
    found |= {f"{name} {cut}" for name, share in shares.items() for cut in CUTS if share >= cut}
    found.add(f"word length {int(len(text) / len(words))}")
    for word in words:
        core = word.strip(quality._EDGES).lower()
        if core:
            found.add("w " + core)
            found |= {f"b{n} {core[:n]}" for n in (4, 5) if len(core) > n}
    shapes = Counter(map(plain_shape, words))
    return found | {f"s{cut} {s}" for s, n in shapes.items() for cut in quality._SHARES if n >= cut * len(words)}


def telling(found: list[set[str]], traits: np.ndarray) -> list[str]:
    held = defaultdict(list)
    for row, names in enumerate(found):
        for name in names:
            held[name].append(row)
    rates, kept = traits.mean(axis=0), []
    for name, rows in held.items():
        best, n = 0.0, len(rows)
        for t, rate in enumerate(rates):
            if 0 < rate < 1:
                yes = traits[rows, t].sum()
                best = max(best, 2 * sum(x * math.log(x / (n * r)) for x, r in ((yes, rate), (n - yes, 1 - rate)) if x))
        if n >= quality.LEAST_DOCUMENTS and best >= quality.LEAST_G:
            kept.append(name)
    return sorted(kept)


def regression(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The fit over a full matrix whose last column is 1; the constant without the log odds of the sample."""
    w = np.zeros(x.shape[1])
    if not 0 < y.sum() < len(y):
        return w
    odds = math.log(y.mean() / (1 - y.mean()))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, quality._STEPS + 1):
        guess = 1 / (1 + np.exp(-np.clip(odds + x @ w, -40, 40)))
        slope = x.T @ (guess - y) + quality._RIDGE * w
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        rate = 0.1 * (1 - step / (quality._STEPS + 1))
        w = w - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w


def worth(groups: list[tuple[float, float, float]]) -> float:
    """Labels that a prior is worth, from (labels, hits, prior) of each group."""
    room = sum(n * (n - 1) * p * (1 - p) for n, _, p in groups)
    excess = sum((h - n * p) ** 2 - n * p * (1 - p) for n, h, p in groups)
    share = excess / room if room else 0.0
    return min(max(1 / max(share, 1e-4) - 1, 1.0), 1e4)


def plain_judge(docs: list[tuple], labels: list[tuple]) -> list[tuple]:
    """(doc_id, p_low, p_toxic) of each of ``docs`` (doc_id, text, site, path)."""
    traits: dict[int, np.ndarray] = {}
    for i, good, toxic in labels:
        if i is not None and (good is not None or toxic is not None):
            told = np.array([good == 0, toxic == 1], int)
            traits[i] = np.maximum(traits.get(i, told), told)
    known = [k for k, d in enumerate(docs) if d[0] in traits]
    y = np.array([traits[docs[k][0]] for k in known])
    found = [plain_features(d[1]) for d in docs]
    names = telling([found[k] for k in known], y)
    matrix = np.array([[n in f for n in names] + [True] for f in found], float)
    place = [(d[2] or "", d[3] or "") for d in docs]
    evidence, rates = [], []
    for t in range(2):
        evidence.append(matrix @ regression(matrix[known], y[:, t]))
        base = (y[:, t].sum() + 0.5) / (len(known) + 1)
        sites, paths = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
        for k, hit in zip(known, y[:, t], strict=True):
            for group in (sites[place[k][0]], paths[place[k]]):
                group[0] += 1
                group[1] += hit
        pull = worth([(n, h, base) for n, h in sites.values()])
        site = {s: (h + pull * base) / (n + pull) for s, (n, h) in sites.items()}
        pull = worth([(n, h, site[p[0]]) for p, (n, h) in paths.items()])
        path = {p: (h + pull * site[p[0]]) / (n + pull) for p, (n, h) in paths.items()}
        rates.append([path.get(p, site.get(p[0], base)) for p in place])
    chance = [1 / (1 + np.exp(-(e + np.log(np.array(r) / (1 - np.array(r)))))) for e, r in zip(evidence, rates, strict=True)]
    return [(d[0], chance[0][k], chance[1][k]) for k, d in enumerate(docs)]


def test_judge_equals_the_plain_version(spark):
    tables = [spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels")]
    docs = [tuple(r) for r in tables[0].select("doc_id", "text", "source", "lang").collect()]
    docs += [(None, None, None, None), (-1, "", "new site", "en"), (-2, "one two", docs[0][2], "new path"), docs[0]]
    labels = [tuple(r) for r in tables[1].select("doc_id", "quality", "toxic").collect()]
    labels += [(None, 0, 1), (-1, None, None), (-2, None, 0), labels[0]]
    got = quality.judge(
        spark.createDataFrame(docs, "doc_id long, text string, source string, lang string").repartition(4),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    ).collect()
    key = lambda r: (r[0] is not None, r[0], r[1])
    want = sorted(plain_judge(docs, labels), key=key)
    have = sorted(((r.doc_id, r.p_low, r.p_toxic, r.rejected) for r in got), key=key)
    assert [h[0] for h in have] == [w[0] for w in want]
    assert np.allclose([h[1:3] for h in have], [w[1:] for w in want], atol=1e-4)
    clear = [(h[3], max(w[1:]) > quality.THRESHOLD) for h, w in zip(have, want, strict=True) if abs(max(w[1:]) - quality.THRESHOLD) > 1e-3]
    assert all(a == b for a, b in clear) and len({a for a, _ in clear}) == 2
