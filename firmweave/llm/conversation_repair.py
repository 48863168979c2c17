"""Repair of conversation structure: the cheapest edits that make roles a legal sequence, and of these the least audit trail.

A row is kept, given another role or deleted, and empty turns may be inserted, so that the initials of the roles left read
``(s?(ua)+)?``. Nodes of a conversation are (rows passed, what was put out last): nothing, the system turn, a user turn or an assistant turn. A
row is a step between layers of four nodes, so any run of rows is a 4 x 4 matrix of costs, and runs combine.

1. Rows are range-sorted into parts, written once; a long conversation lies in several.
2. Each part gives the matrix of its first and last conversation. From the matrices of a conversation's parts follow
   the costs before and after each part (``_edges``): one small row a part and conversation that crosses its border.
3. Cost DP in each part: least costs from the start and to the end for all nodes. Arcs on cheapest paths are *optimal*; their
   letters (D, I, K, R) differ at a node. Nodes are ranked by the first 1, 2, 4, … letters of the least trail that starts there, each
   rank from two ranks half as long by a pointer that is doubled too. Of a node's optimal arcs the one of the least letter and target rank is taken; the
   doubled pointers mark the nodes on the path from each state a part can be entered in.
4. The state in which each part is entered follows from the exits of the parts before it; a part's edits of that state count.
5. Digests of repaired texts are running hashes over a conversation's rows in order, row by row in constant memory.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from firmweave.llm.tables import bound_batches, per_batch, settle

# White space of the contract, and what ends a sentence (fixed values).
WHITE = " \t\n\x0b\x0c\r"
STOPS = ".!?"
# Rows of a part, and of a block within it: layout only.
PART_ROWS = 100_000
BLOCK = 256

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_OTHER, _S, _U, _A = range(4)
_BLANK, _CUT, _COPY = 4, 8, 16
_FAR = 1 << 40
_DELETE, _CHANGE, _INSERT = 3, 2, 2
# Where an insert leads from each state.
_INSERTED = np.array([_USER, _USER, _ASSISTANT, _USER])
# Letters of a trail in ASCII order, and the end of it.
_D, _I, _K, _R, _STOP = range(5)

# Edits of a row as text: inserted turns (u, a) before it, what becomes of it (K kept, D deleted, U and A its new role), inserted turns after
# the last row. Trails write I for u and a, R for U and A.
_PUT = ["", "u", "a", "ua"]
_BECOMES = ["K", "D", "U", "A"]
EDITS = [before + becomes + after for after in _PUT for becomes in _BECOMES for before in _PUT]

_MATRIX = [f"m{i}" for i in range(16)]


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` after a reproducible damage: CRC-32 of ``conv_id:turn`` modulo 20 drops a row (0), empties its
    text (1), removes its sentence ends (2), repeats it (3) or makes it the user's (4). Null roles, texts and parts of the key are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_fault"))
    rows = rows.where(F.col("_fault") != 0)
    text = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    role = F.when(F.col("_fault") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def _laid(turns: DataFrame) -> DataFrame:
    """Rows in order of (conversation, turn, digest of role and text), with the part and place each has."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    digest = F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    trimmed = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", _S).when(initial == "u", _U).when(initial == "a", _A).otherwise(_OTHER)
    code = code + F.when(trimmed == "", _BLANK).when(F.right(trimmed, F.lit(1)).isin(*STOPS), 0).otherwise(_CUT)
    rows = rows.withColumns({"digest": digest, "code": code.cast("int"), "_tie": F.monotonically_increasing_id()})
    spark = turns.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns.count() // PART_ROWS))
    order = ["conv_id", "turn", "digest", "_tie"]
    laid = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("_tie")
    laid = laid.withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id())
    return settle(laid, "repair_rows")


def _marked(laid: DataFrame) -> DataFrame:
    """``conv_id``, ``part``, ``row``, ``code``: copies of an earlier row of the conversation are told, one row a text and conversation is looked up."""
    narrow = laid.select("conv_id", "part", "row", "code", "digest")
    texts = narrow.where(F.col("code").bitwiseAND(_BLANK) == 0).groupBy("conv_id", "digest")
    firsts = texts.agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    joined = narrow.join(firsts, narrow["conv_id"].eqNullSafe(firsts["c"]) & (narrow["digest"] == firsts["d"]), "left")
    copy = F.when(F.col("row") > F.col("first"), _COPY).otherwise(0)
    return settle(joined.select("conv_id", "part", "row", F.col("code").bitwiseOR(copy).alias("code")), "repair_codes")


def _charges(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cost of putting a row out as system, user and assistant turn."""
    who = code & 3
    base = np.where(code & (_BLANK | _COPY), _FAR, np.where(code & _CUT, 1, 0))
    return np.where(who == _S, base, _FAR), base + np.where(who == _U, 0, _CHANGE), base + np.where(who == _A, 0, _CHANGE)


def _forward(v: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Costs (…, 4) of the nodes before a row, inserts included, to those after it."""
    system, user, assistant = (c.reshape(c.shape + (1,) * (v.ndim - 2)) for c in _charges(code))
    out = v + _DELETE
    out[..., _SYSTEM] = np.minimum(out[..., _SYSTEM], v[..., _START] + system)
    either = np.minimum(np.minimum(v[..., _START], v[..., _SYSTEM]), v[..., _ASSISTANT])
    out[..., _USER] = np.minimum(out[..., _USER], either + user)
    out[..., _ASSISTANT] = np.minimum(out[..., _ASSISTANT], v[..., _USER] + assistant)
    return _with_inserts(out)


def _with_inserts(v: np.ndarray) -> np.ndarray:
    least = np.minimum(np.minimum(v[..., _START], v[..., _SYSTEM]), v[..., _ASSISTANT])
    v[..., _USER] = np.minimum(v[..., _USER], least + _INSERT)
    v[..., _ASSISTANT] = np.minimum(v[..., _ASSISTANT], v[..., _USER] + _INSERT)
    return v


def _backward(v: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Costs to the end from the nodes after a row to those before it."""
    system, user, assistant = _charges(code)
    out = v + _DELETE
    out[:, _START] = np.minimum(out[:, _START], v[:, _SYSTEM] + system)
    for q in (_START, _SYSTEM, _ASSISTANT):
        out[:, q] = np.minimum(out[:, q], v[:, _USER] + user)
    out[:, _USER] = np.minimum(out[:, _USER], v[:, _ASSISTANT] + assistant)
    user_first = np.minimum(out[:, _USER], out[:, _ASSISTANT] + _INSERT)
    out[:, _ASSISTANT] = np.minimum(out[:, _ASSISTANT], out[:, _USER] + _INSERT)
    out[:, _USER] = user_first
    for q in (_START, _SYSTEM):
        out[:, q] = np.minimum(out[:, q], user_first + _INSERT)
    return out


def _times(v: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """(min, +) product of rows ``v`` (n, 4) and matrices (n, 4, 4)."""
    return (v[:, :, None] + matrix).min(axis=1)


_BEGIN = _with_inserts(np.array([[0, _FAR, _FAR, _FAR]], np.int64))[0]
# From the last layer: done after nothing or after an assistant turn, else one or two inserts away.
_FINISH = np.array([0, 2 * _INSERT, _INSERT, 0], np.int64)


class Blocks:
    """Runs of rows (of conversations or parts of them) cut into blocks; all blocks advance together, row by row."""

    def __init__(self, code: np.ndarray, heads: np.ndarray):
        self.code, self.heads = code, heads
        self.sizes = np.diff(np.append(heads, len(code)))
        self.counts = -(-self.sizes // BLOCK)
        self.first = np.cumsum(self.counts) - self.counts
        run = np.repeat(np.arange(len(heads)), self.counts)
        self.place = np.arange(len(run)) - self.first[run]
        self.start = heads[run] + self.place * BLOCK
        self.size = np.minimum(BLOCK, self.sizes[run] - self.place * BLOCK)
        self.run = run
        order = np.argsort(-self.size, kind="stable")
        self.order, self.falling = order, self.size[order]

    def _active(self, t: int) -> np.ndarray:
        return self.order[: np.searchsorted(-self.falling, -t, side="left")]

    def matrices(self) -> np.ndarray:
        out = np.full((len(self.start), 4, 4), _FAR, np.int64)
        out[:, np.arange(4), np.arange(4)] = 0
        for t in range(int(self.size.max(initial=0))):
            at = self._active(t)
            out[at] = np.minimum(_forward(out[at], self.code[self.start[at] + t]), _FAR)
        return out

    def whole(self) -> np.ndarray:
        """The matrix of each run."""
        blocks = self.matrices()
        out = blocks[self.first]
        for j in range(1, int(self.counts.max(initial=0))):
            more = np.flatnonzero(self.counts > j)
            out[more] = np.minimum((out[more][:, :, :, None] + blocks[self.first[more] + j][:, None, :, :]).min(axis=2), _FAR)
        return out

    def costs(self, begin: np.ndarray, finish: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least costs from the start and to the end for each layer: that before row r of run g is layer r + g, one more ends the run."""
        blocks = self.matrices()
        ahead = np.zeros((len(self.start), 4), np.int64)
        behind = np.zeros((len(self.start), 4), np.int64)
        deepest = int(self.counts.max(initial=0))
        now = begin.copy()
        for j in range(deepest):
            more = np.flatnonzero(self.counts > j)
            at = self.first[more] + j
            ahead[at] = now[more]
            now[more] = _times(now[more], blocks[at])
        now = finish.copy()
        for j in range(deepest - 1, -1, -1):
            more = np.flatnonzero(self.counts > j)
            at = self.first[more] + j
            behind[at] = now[more]
            past = np.minimum((blocks[at] + now[more][:, None, :]).min(axis=2), _FAR)
            # The matrix has no inserts before its first row.
            user = np.minimum(past[:, _USER], past[:, _ASSISTANT] + _INSERT)
            past[:, _ASSISTANT] = np.minimum(past[:, _ASSISTANT], past[:, _USER] + _INSERT)
            past[:, _USER] = user
            past[:, [_START, _SYSTEM]] = np.minimum(past[:, [_START, _SYSTEM]], user[:, None] + _INSERT)
            now[more] = past
        layers = len(self.code) + len(self.heads)
        f, b = np.zeros((layers, 4), np.int64), np.zeros((layers, 4), np.int64)
        layer = self.start + self.run
        f[layer] = ahead
        b[layer + self.size] = behind
        for t in range(int(self.size.max(initial=0))):
            at = self._active(t)
            f[layer[at] + t + 1] = np.minimum(_forward(f[layer[at] + t], self.code[self.start[at] + t]), _FAR)
            # From the back, blocks end at different places.
            end = layer[at] + self.size[at] - t
            b[end - 1] = np.minimum(_backward(b[end], self.code[self.start[at] + self.size[at] - t - 1]), _FAR)
        return f, b


def least_paths(code: np.ndarray, heads: np.ndarray, begin: np.ndarray, finish: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edits (index in ``EDITS``, -1 if none) of each row for each state its run can be entered in, and the state each entry leaves in.

    ``last``: whether a run ends its conversation, so that inserts may follow its last row.
    """
    blocks = Blocks(code, heads)
    f, b = blocks.costs(begin, finish)
    rows, runs = len(code), len(heads)
    run = np.repeat(np.arange(runs), blocks.sizes)
    layers = rows + runs
    run_of = np.repeat(np.arange(runs), blocks.sizes + 1)
    end = heads + blocks.sizes + np.arange(runs)
    total = (f[end] + finish).min(axis=1)[run_of]
    before = np.arange(rows) + run  # the layer before each row
    is_end = np.zeros(layers, bool)
    is_end[end] = True
    node = np.arange(layers * 4).reshape(layers, 4)
    # Optimal arcs: for each letter whether the node has one, and where it leads.
    has = np.zeros((4, layers, 4), bool)
    to = np.tile(node, (4, 1, 1))
    inserting = ~is_end
    inserting[end[last]] = True
    has[_I] = (f + _INSERT + b[:, _INSERTED] == total[:, None]) & inserting[:, None]
    to[_I] = node[:, _INSERTED]
    ahead, after, goal = f[before], b[before + 1], total[before][:, None]
    has[_D, before] = ahead + _DELETE + after == goal
    to[_D, before] = node[before + 1]
    charge = np.stack(_charges(code), axis=1)
    put = np.array([_USER, _USER, _ASSISTANT, _USER])
    fits = np.array([[_S, _U], [_U, -1], [_A, -1], [_U, -1]])
    who = code & 3
    for q in range(4):
        for kept in fits[q]:
            if kept < 0:
                continue
            same = who == kept
            right = same & (ahead[:, q] + charge[:, kept - 1] + after[:, kept] == goal[:, 0])
            has[_K, before[right], q] = True
            to[_K, before[right], q] = node[before[right] + 1, kept]
        other = put[q]
        right = (who != other) & (ahead[:, q] + charge[:, other - 1] + after[:, other] == goal[:, 0])
        has[_R, before[right], q] = True
        to[_R, before[right], q] = node[before[right] + 1, other]
    has, to = has.reshape(4, -1), to.reshape(4, -1)
    rank, steps = _ranked(has, to)
    letter, step = _least(has, to, rank)
    return _edits(steps, letter, step, heads, blocks.sizes, end, last, before, rows, layers)


def _least(has: np.ndarray, to: np.ndarray, rank: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Of each node's optimal arcs that of the least letter and, for one letter, of the target ranked least."""
    n = has.shape[1]
    ranks = np.zeros(n, np.int64) if rank is None else rank
    key = np.where(has, np.arange(4)[:, None] * (n + 1) + ranks[to], np.iinfo(np.int64).max)
    letter = key.argmin(axis=0)
    none = ~has.any(axis=0)
    step = to[letter, np.arange(n)]
    step[none] = np.flatnonzero(none)
    letter[none] = _STOP
    return letter, step


def _ranked(has: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of nodes by the least trail from them, and pointers 1, 2, 4, … letters on.

    Letters at a node differ, so the least letter names one arc; each round ranks pairs of ranks, for twice the letters.
    """
    rank, pointer = _least(has, to, None)
    n = len(rank)
    steps = [pointer]
    while True:
        rank = np.unique(rank * (n + 1) + rank[pointer], return_inverse=True)[1]
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            return rank, steps
        pointer = further
        steps.append(pointer)


def _edits(steps, letter, step, heads, sizes, end, last, before, rows, layers) -> tuple[np.ndarray, np.ndarray]:
    first_layer = heads + np.arange(len(heads))
    ways = np.full((rows, 4), -1, np.int64)
    leaves = np.zeros((len(heads), 4), np.int64)
    steps = [step, *steps[1:]]
    for entry in range(4):
        origin = first_layer * 4 + entry
        on = np.zeros(layers * 4, bool)
        on[origin] = True
        for pointer in reversed(steps):
            on[pointer[np.flatnonzero(on)]] = True
        puts = (on & (letter == _I)).reshape(layers, 4)
        inserted = (puts[:, _START] | puts[:, _SYSTEM] | puts[:, _ASSISTANT]) + 2 * puts[:, _USER]
        chosen = on & ((letter == _D) | (letter == _K) | (letter == _R))
        at = np.flatnonzero(chosen)
        becomes = np.full(layers, -1, np.int64)
        target = step[at] % 4
        becomes[at // 4] = np.where(letter[at] == _K, 0, np.where(letter[at] == _D, 1, np.where(target == _USER, 2, 3)))
        ways[:, entry] = np.where(becomes[before] >= 0, inserted[before] + 4 * becomes[before], -1)
        final = heads + sizes - 1
        late = last & (ways[final, entry] >= 0)
        ways[final[late], entry] += 16 * inserted[end[late]]
        # Where the path stands after the last row, before inserts that belong to what follows.
        tail = origin
        for pointer in reversed(steps):
            tail = pointer[tail]
        tail = np.where(tail // 4 == end, tail, origin)
        leaves[:, entry] = tail % 4
    return ways, leaves


def _runs(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows of a part in order, and where its conversations begin."""
    table = table.sort_by("row")
    conv = table.column("conv_id").combine_chunks().dictionary_encode()
    ids = (conv.indices if isinstance(conv, pa.DictionaryArray) else conv.combine_chunks().indices).fill_null(-1).to_numpy(zero_copy_only=False)
    new = np.ones(len(ids), bool)
    new[1:] = ids[1:] != ids[:-1]
    return table, np.flatnonzero(new)


def _border(key, table: pa.Table) -> pa.Table:
    """The matrices of the first and the last conversation of a part."""
    table, heads = _runs(table)
    code = table.column("code").to_numpy()
    tails = np.append(heads[1:], len(code))
    picked = sorted({0, len(heads) - 1})
    pieces = np.concatenate([code[heads[g] : tails[g]] for g in picked])
    begins = np.cumsum([0] + [tails[g] - heads[g] for g in picked[:-1]])
    whole = Blocks(pieces, np.asarray(begins)).whole().reshape(len(picked), 16)
    out = {"conv_id": table.column("conv_id").take(pa.array(heads[picked])), "part": pa.array([key[0].as_py()] * len(picked), pa.int32())}
    return pa.table(out | {m: pa.array(whole[:, i]) for i, m in enumerate(_MATRIX)})


def _edges(key, table: pa.Table) -> pa.Table:
    """Of a conversation's parts: costs from the start (f) to each and from each to the end (b), and whether it is the last."""
    table = table.sort_by("part")
    matrices = np.stack([table.column(m).to_numpy() for m in _MATRIX], axis=1).reshape(-1, 4, 4)
    n = len(matrices)
    f, b = np.zeros((n, 4), np.int64), np.zeros((n, 4), np.int64)
    now = _BEGIN[None]
    for i in range(n):
        f[i] = now[0]
        now = np.minimum(_times(now, matrices[i : i + 1]), _FAR)
    now = _FINISH
    for i in range(n - 1, -1, -1):
        b[i] = now
        past = np.minimum((matrices[i] + now[None]).min(axis=1), _FAR)
        user = min(past[_USER], past[_ASSISTANT] + _INSERT)
        past[_ASSISTANT] = min(past[_ASSISTANT], past[_USER] + _INSERT)
        past[_USER] = user
        past[[_START, _SYSTEM]] = np.minimum(past[[_START, _SYSTEM]], user + _INSERT)
        now = past
    out = {"conv_id": table.column("conv_id"), "part": table.column("part"), "ends": pa.array(np.arange(n) == n - 1)}
    return pa.table(out | {f"f{q}": pa.array(f[:, q]) for q in range(4)} | {f"b{q}": pa.array(b[:, q]) for q in range(4)})


def _solve(key, table: pa.Table, edges: pa.Table) -> pa.Table:
    """The edits of each row of a part, for each state its conversation can come in."""
    table, heads = _runs(table)
    code = table.column("code").to_numpy()
    begin, finish = np.tile(_BEGIN, (len(heads), 1)), np.tile(_FINISH, (len(heads), 1))
    last = np.ones(len(heads), bool)
    told = {r["conv_id"]: r for r in edges.to_pylist()}
    ids = table.column("conv_id")
    border = {g: told[ids[int(heads[g])].as_py()] for g in {0, len(heads) - 1}}
    for g, r in border.items():
        begin[g], finish[g], last[g] = [r[f"f{q}"] for q in range(4)], [r[f"b{q}"] for q in range(4)], r["ends"]
    ways, leaves = least_paths(code, heads, begin, finish, last)
    exits: list = [None] * len(code)
    tails = np.append(heads[1:], len(code)) - 1
    for g in border:
        exits[int(tails[g])] = leaves[g].tolist()
    out = {"row": table.column("row"), "part": table.column("part"), "conv_id": ids, "code": table.column("code")}
    out |= {f"w{q}": pa.array(ways[:, q].astype(np.int32)) for q in range(4)}
    return pa.table(out | {"exits": pa.array(exits, pa.list_(pa.int64()))})


def _entered(key, table: pa.Table) -> pa.Table:
    """The state in which each of a conversation's parts is entered."""
    table = table.sort_by("part")
    states, now = [], _START
    for leaves in table.column("exits").to_pylist():
        states.append(now)
        now = leaves[now]
    return pa.table({"conv_id": table.column("conv_id"), "part": table.column("part"), "state": pa.array(states, pa.int32())})


def plan_repairs(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``) in order, and the edits of each.

    The first has ``conv_id``, ``turn``, ``role``, ``text`` and ``row``, which ascends in order of (conversation, turn, digest of role and text; nulls first); the second
    ``conv_id``, ``row``, ``code`` (faults) and ``edits`` (see ``EDITS``). Null roles and texts are one space; rows without ``conv_id`` are one conversation.
    """
    laid = _laid(turns)
    marked = _marked(laid)
    conv = marked.schema["conv_id"].dataType.simpleString()
    border = marked.groupBy("part").applyInArrow(lambda key, rows: _border(key, rows), f"conv_id {conv}, part int, " + ", ".join(f"{m} bigint" for m in _MATRIX))
    costs = ", ".join(f"{x}{q} bigint" for x in "fb" for q in range(4))
    edges = settle(border.groupBy("conv_id").applyInArrow(lambda key, rows: _edges(key, rows), f"conv_id {conv}, part int, ends boolean, {costs}"), "repair_edges")
    schema = f"row bigint, part int, conv_id {conv}, code int, w0 int, w1 int, w2 int, w3 int, exits array<bigint>"
    solved = marked.groupBy("part").cogroup(edges.groupBy("part")).applyInArrow(lambda key, a, b: _solve(key, a, b), schema)
    solved = settle(solved, "repair_ways")
    exits = solved.where("exits IS NOT NULL").select("conv_id", "part", "exits")
    states = exits.groupBy("conv_id").applyInArrow(lambda key, rows: _entered(key, rows), f"conv_id {conv}, part int, state int")
    # One row a part and border conversation: twice the number of parts at most.
    states = F.broadcast(states.where(f"state <> {_START}").select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "state"))
    joined = solved.join(states, (solved["part"] == states["p"]) & solved["conv_id"].eqNullSafe(states["c"]), "left")
    way = F.element_at(F.array("w0", "w1", "w2", "w3"), F.coalesce("state", F.lit(_START)) + 1)
    edits = F.element_at(F.array(*[F.lit(e) for e in EDITS]), way + 1)
    return laid.select("conv_id", "turn", "role", "text", "row"), joined.select(solved["conv_id"], "row", "code", edits.alias("edits"))


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``row``, ``place`` (both give the order), ``role``, ``text``, ``edit`` (K, R or I), ``turn`` (null if inserted)."""
    rows, plan = plan_repairs(turns)
    both = rows.join(plan.drop("conv_id", "code"), "row")
    letters = F.split("edits", "")
    both = both.select("*", F.posexplode(letters).alias("place", "letter")).where("letter NOT IN ('', 'D')")
    role = F.when(F.col("letter") == "K", F.col("role")).when(F.lower("letter") == "u", "user").otherwise("assistant")
    inserted = F.col("letter").isin("u", "a")
    edit = F.when(F.col("letter") == "K", "K").when(inserted, "I").otherwise("R")
    return both.select("conv_id", "row", "place", F.when(~inserted, F.col("turn")).alias("turn"), role.alias("role"), F.when(inserted, "").otherwise(F.col("text")).alias("text"), edit.alias("edit"))


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_LEGAL = {"su", "ua", "au"}
_TRAIL = str.maketrans("uaUA", "IIRR")
_NAMES = {"u": "user", "U": "user", "a": "assistant", "A": "assistant"}
_COSTS = {"K": 0, "D": _DELETE, "U": _CHANGE, "A": _CHANGE, "u": _INSERT, "a": _INSERT}


class Summary:
    """Counts, trail and digest of a conversation, row by row."""

    def __init__(self, conv):
        self.conv, self.n = conv, dict.fromkeys(_COUNTS, 0)
        self.low = self.turn = self.before = None
        self.different = 0
        self.trail: list[str] = []
        self.hash, self.lines = hashlib.sha256(), 0

    def add(self, turn, role: str, text: str, code: int, edits: str) -> None:
        n = self.n
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.turn, self.different = turn, self.different + 1
        for fault, bit in (("blank", _BLANK), ("duplicate", _COPY), ("truncated", _CUT)):
            if code & bit:
                n[fault] += 1
                break
        initial = role[:1]
        if self.before is not None and self.before + initial not in _LEGAL:
            n["illegal"] += 1
        self.before = initial
        self.trail.append(edits.translate(_TRAIL))
        for letter in edits:
            n["cost"] += _COSTS[letter]
            if letter in "KUA":
                n["cost"] += bool(code & _CUT)
                self._line(role if letter == "K" else _NAMES[letter], text)
            elif letter != "D":
                self._line(_NAMES[letter], "")

    def _line(self, role: str, text: str) -> None:
        self.hash.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def done(self) -> tuple:
        if self.low is not None:
            self.n["gaps"] = self.turn - self.low + 1 - self.different
        return (self.conv, *[self.n[c] for c in _COUNTS], "".join(self.trail), self.hash.hexdigest())


def repair_conversations(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row for each conversation of ``turns`` (``conv_id``, ``turn``, ``role``, ``text``), its faults and its cheapest repair.

    Returns ``conv_id``, ``gaps`` (missing numbers between the least and the greatest turn), ``blank``, ``duplicate``, ``truncated`` (first fault of
    each row), ``illegal`` (neighbouring roles that may not follow each other), ``cost``, ``audit`` (letters of the edits; of equal costs the
    least in ASCII order) and ``repaired_sha256`` (of the repaired ``role:text`` lines). ``repaired_turns`` gives the repaired rows themselves.

    Rows are taken by turn (nulls first), those of one turn by a digest of role and text, so copies are neighbours. Null roles and texts are one space. Rows
    without ``conv_id`` are one conversation. Ids of ``conversations`` that have no rows get zeros, an empty audit and the digest of nothing. Other columns are not
    read. An empty table gives an empty result. A conversation may lie in many parts; only its digest is made in one task, in constant memory.
    """
    spark = turns.sparkSession
    bound_batches(spark)
    rows, plan = plan_repairs(turns)
    conv = rows.schema["conv_id"].dataType
    told = plan.select("conv_id", "row", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"), F.col("edits").alias("text"), "code")
    held = rows.select("conv_id", "row", F.lit(1).alias("kind"), "turn", "role", "text", F.lit(None).cast("int").alias("code"))
    # A row's edits come right before its text: one shuffle of texts, no join.
    laid = told.unionByName(held).repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "row", "kind")
    schema = StructType([StructField("conv_id", conv), *[StructField(c, LongType()) for c in _COUNTS], StructField("audit", StringType()), StructField("repaired_sha256", StringType())])

    def run(batches):
        now, plan_row, done = None, None, []

        def out():
            columns = list(zip(*done, strict=True))
            types = [None, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
            types[0] = id_type
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for batch in batches:
            id_type = batch.column(0).type
            for conv_id, _, kind, turn, role, text, code in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or now.conv != conv_id:
                    if now is not None:
                        done.append(now.done())
                    now = Summary(conv_id)
                if kind == 0:
                    plan_row = (code, text)
                else:
                    now.add(turn, role, text, *plan_row)
            if len(done) > 1000:
                yield out()
        if now is not None:
            done.append(now.done())
        if done:
            yield out()

    found = per_batch(laid, run, schema)
    if conversations is None:
        return found
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    both = ids.join(found, ids["_id"].eqNullSafe(found["conv_id"]), "left")
    nothing = hashlib.sha256().hexdigest()
    return both.select(F.col("_id").alias("conv_id"), *[F.coalesce(c, F.lit(0)).alias(c) for c in _COUNTS], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
