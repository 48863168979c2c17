"""Conversation repair: plain dynamic programme over whole trails, long conversations over several parts, odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

from checks.compare import duck  # noqa: E402
from firmweave.llm import conversation_repair as repair  # noqa: E402
from firmweave.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(key.encode()) % 20
        if hit == 1:
            text = ""
        elif hit == 2:
            text = re.sub("[.!?]", "", text)
        elif hit == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    return out


def plain_trail(rows):
    """(cost, trail, lines) of the least edits of rows (role, text, fault); of each state only the least (cost, trail) is kept."""

    def with_inserts(best):
        for source, target, name in ((0, 2, "user"), (1, 2, "user"), (3, 2, "user"), (2, 3, "assistant"), (3, 2, "user")):
            if source in best:
                cost, trail, lines = best[source]
                new = (cost + 2, trail + "I", (*lines, f"{name}:"))
                best[target] = min(best.get(target, new), new)
        return best

    best = with_inserts({0: (0, "", ())})
    for role, text, fault in rows:
        new = {}

        def put(state, entry, new=new):
            new[state] = min(new.get(state, entry), entry)

        for state, (cost, trail, lines) in best.items():
            put(state, (cost + 3, trail + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = cost + (fault == "truncated")
            keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, role[:1]))
            if keep:
                put(keep, (more, trail + "K", (*lines, f"{role}:{text}")))
            name, target = ("assistant", 3) if state == 2 else ("user", 2)
            put(target, (more + 2, trail + "R", (*lines, f"{name}:{text}")))
        best = with_inserts(new)
    return min(best[q] for q in (0, 3) if q in best)


def plain_repair(turns, ids):
    out = {}
    for conv in set(ids):
        rows = [(t, r, x) for c, t, r, x in turns if c == conv]
        rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
        rows.sort(key=lambda v: (v[0] is not None, v[0] or 0, hashlib.md5(f"{len(v[1])}:{v[1]}{v[2]}".encode()).hexdigest()))
        seen, told = set(), []
        for _, role, text in rows:
            shown = VISIBLE.findall(text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            told.append((role, text, fault))
        numbers = {t for t, _, _ in rows if t is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        counts = Counter(f for _, _, f in told)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(told, told[1:], strict=False))
        cost, trail, lines = plain_trail(told)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, trail, digest)
    return out


def odd_turns(seed: int = 3):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "assistant", "user", "tool", "", None]
    texts = ["Yes.", "No!", "so what", "", " \n", "Why? ", "é日.", None, "x" * 50]
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            role = roles[turn % 2 + 1] if rng.random() < 0.6 else rng.choice(roles)
            text = rng.choice(texts) if rng.random() < 0.5 else f"own {conv} {turn}" + rng.choice(".!?x")
            rows.append((None if conv == 7 else conv, None if rng.random() < 0.05 else turn + rng.randint(0, 2), role, text))
    rows += rows[10:20]
    # One conversation holds more than a third of all rows, and equal rows of one turn among them.
    rows += [(1000, i, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice(["same.", f"t{i}", f"t{i}!", f"t{i}."])) for i in range(900)]
    rows += [(1000, 5, "user", "again.")] * 100 + [(1001, 0, "system", "s.")] + [(1002, 3, "user", " ")]
    return rows


@pytest.mark.parametrize("block", [256, 3])
def test_least_paths(monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    faults = {0: "", repair._CUT: "truncated", repair._BLANK: "blank", repair._COPY: "duplicate"}
    for _ in range(60):
        runs = [[(rng.choice("xsuuaa"), rng.choice([0, 0, 0, *faults])) for _ in range(rng.randint(1, 14))] for _ in range(rng.randint(1, 6))]
        code = np.array([" suaa".index(r) % 4 + f if r != "x" else f for run in runs for r, f in run])
        heads = np.cumsum([0] + [len(r) for r in runs[:-1]])
        n = len(runs)
        ways, _ = repair.least_paths(code, heads, np.tile(repair._BEGIN, (n, 1)), np.tile(repair._FINISH, (n, 1)), np.ones(n, bool))
        for head, run in zip(heads, runs, strict=True):
            edits = "".join(repair.EDITS[w] for w in ways[head : head + len(run), 0])
            cost, trail, _ = plain_trail([(r, "", faults[f]) for r, f in run])
            assert edits.translate(repair._TRAIL) == trail
            assert cost == sum(repair._COSTS[e] for e in edits) + sum(f == repair._CUT and repair.EDITS[w].strip("ua") != "D" for (_, f), w in zip(run, ways[head:, 0], strict=False))


def test_repair_equals_plain(spark):
    rows = odd_turns()
    schema = "conv_id long, turn int, role string, text string, part string, row string, code string, _tie string"
    df = spark.createDataFrame([(*r, "p", "q", "c", "t") for r in rows], schema).repartition(7)
    ids = df.unionByName(spark.createDataFrame([(5000, 0, "user", "gone", "", "", "", "")], schema))
    got = {r.conv_id: tuple(r) for r in repair.repair_conversations(df, ids).collect()}
    want = plain_repair(rows, [r[0] for r in rows] + [5000])
    assert got == want
    lines: dict = {}
    for r in repair.repaired_turns(df).orderBy("row", "place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert (r.turn is None or r.edit != "I") and r.edit in "KRI"
    for conv, row in want.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == row[-1]


def test_damage(spark):
    rows = odd_turns(4)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    assert Counter(tuple(r) for r in repair.damaged(df).collect()) == Counter(plain_damage(rows))


def test_no_turns(spark):
    empty = spark.createDataFrame([], "conv_id string, turn long, role string, text string")
    assert repair.repair_conversations(repair.damaged(empty), empty).count() == 0
    assert repair.repaired_turns(empty).count() == 0
    one = spark.createDataFrame([("c", 1, "user", "Hi.")], empty.schema)
    assert [r.audit for r in repair.repair_conversations(one).collect()] == [plain_trail([("user", "Hi.", "")])[1]]


def test_query(spark):
    got = queries.QUERIES["op12_conversation_repair"](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    turns = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(rows) == sorted(plain_repair(plain_damage(turns), [t[0] for t in turns]).values())
    cursor = duck(SF).execute(queries.ORACLES["op12_conversation_repair"])
    names = [d[0] for d in cursor.description]
    at = [got.columns.index(n) for n in names]
    assert sorted(names) == sorted(got.columns) and Counter(cursor.fetchall()) == Counter(tuple(r[i] for i in at) for r in rows)
