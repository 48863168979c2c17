"""Chat formatting against a plain version."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from firmweave.llm import chat_format


def first_null(value):
    return (value is not None, value if value is not None else 0)


def plain_format(turns) -> Counter:
    by: dict[int, set] = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            by.setdefault(conv, set()).add((turn, role, text))
    ordered = {}
    for conv, rows in by.items():
        rows = sorted(rows, key=lambda r: (first_null(r[0]), (r[1] is not None, r[1] or ""), (r[2] is not None, r[2] or "")))
        ordered[conv] = tuple((role, text) for _, role, text in rows)
    copies = Counter(ordered.values())
    shorter = {v[:k] for v in ordered.values() for k in range(1, len(v))}
    out = []
    for value, n in copies.items():
        if value not in shorter:
            conv = min(c for c, v in ordered.items() if v == value)
            out.append((conv, len(value), n, "".join(f"<|{r or ''}|>\n{t or ''}\n<|end|>\n" for r, t in value)))
    return Counter(out)


def test_snapshots_collapse(spark):
    rng = random.Random(1)
    turns = []
    for conv in range(60):
        base = rng.choice(["p", "q", "r"])
        for k in range(rng.randint(1, 12)):
            text = f"{base}{k}" if rng.random() < 0.97 else rng.choice([None, "", "other"])
            turns.append((conv, k * 2, rng.choice(["user"]) if k % 2 == 0 else None, text))
    turns += turns[:10]  # repeated rows
    turns += [(100, 0, "user", "p0"), (101, None, "user", "x"), (101, 5, "user", "x"), (102, 0, "", "x"), (103, 0, None, "x"), (104, 0, "user", None), (105, 0, "user", "")]
    turns += [(106, 1, "a", "tie 2"), (106, 1, "a", "tie 1"), (106, 1, "b", "tie 0"), (None, 0, "user", "lost")]
    rng.shuffle(turns)
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("k", F.lit("x")).repartition(6)
    got = Counter(tuple(r) for r in chat_format.render_conversations(df).collect())
    assert got == plain_format(turns)


def test_long_conversation_over_several_parts(spark):
    """One conversation over many sorted parts, and its prefixes as conversations of their own."""
    turns = [(1, k, "user", f"t{k}") for k in range(3000)]
    turns += [(2, k, "user", f"t{k}") for k in range(2999)] + [(3, k, "user", f"t{k}") for k in range(1000)] + [(4, k, "user", f"t{k}") for k in range(1, 900)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r.n_turns for r in chat_format.render_conversations(df).collect()}
    assert got == {1: 3000, 4: 899}


def test_no_turns(spark):
    assert chat_format.render_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
