"""Plain versions of the operators, and odd documents to run them on."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SYLLABLES = ["the", "an", "on", "Re", "tion", "ér", "ß", "日", "of", "in", "x9", "-", "."]


def prose(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", "  ", "\n", " \t"]) for w in words)


def odd_documents(seed: int = 1) -> list[tuple]:
    """(doc_id, text): copies, shared passages, edits, repeats within a text, nulls, empty and long texts."""
    rng = random.Random(seed)
    passage, line = prose(rng, 80), prose(rng, 12)
    docs = [(i, prose(rng, rng.randint(0, 150))) for i in range(40)]
    docs += [(40 + i, prose(rng, 30) + passage + prose(rng, 30)) for i in range(8)]
    docs += [(60 + i, docs[5][1]) for i in range(5)]
    docs += [(70 + i, docs[42][1].replace("the", "THE", 1) + " end") for i in range(3)]
    docs += [(80, passage * 3), (81, "a" * 400), (82, "ab" * 90), (83, None), (84, ""), (85, " \n"), (86, line), (87, line)]
    docs += [(88, prose(rng, 6000)), (3, docs[3][1]), (3, passage), (None, passage), (None, None), (90, "\x00 \x1c x " + passage[:200])]
    docs += [(-5, docs[7][1]), (91, prose(rng, 34)), (92, prose(rng, 35))]
    rng.shuffle(docs)
    return docs


def frame(spark, docs: list[tuple]):
    """The documents with extra columns named like internal and added ones."""
    schema = "doc_id long, text string, _chunk string, shard int, kept string, n_words int, _rest string, _id int, spans string"
    return spark.createDataFrame([(*d, "c", 1, "k", 2, "r", 3, None) for d in docs], schema).repartition(5)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def substring_dedup(docs, length: int = 35) -> Counter:
    split = [(i, words(t)) for i, t in docs]
    seen = Counter(tuple(w[p : p + length]) for _, w in split for p in range(len(w) - length + 1))
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - length + 1):
            if seen[tuple(w[p : p + length])] > 1:
                gone.update(range(p, p + length))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone).encode())))
    return Counter(out)


def suffix_dedup(docs, length: int = 50) -> Counter:
    data = [(i, (t or "").encode()) for i, t in docs]
    least: dict[bytes, int] = {}
    for i, b in data:
        for p in range(len(b) - length + 1):
            if i is not None:
                w = b[p : p + length]
                least[w] = min(i, least.get(w, i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            first = least.get(b[p : p + length])
            if first is not None and (i is None or first < i):
                gone[p : p + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return Counter(out)


def roots(n: int, links) -> list[int]:
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def simhash(text: str | None) -> int:
    import xxhash

    w = words((text or "").translate(LOWER))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
