"""Dedup operators against plain versions, on small odd documents and vectors."""

from __future__ import annotations

import math
import random
import sys
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import plain  # noqa: E402

from firmweave.llm import embedding_dedup, repeats, simhash_dedup, substring_dedup, suffix_array_dedup, tables  # noqa: E402
from firmweave.llm.components import components  # noqa: E402


def counted(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def docs(spark):
    rows = plain.odd_documents()
    return rows, plain.frame(spark, rows)


def test_substring_dedup(spark, docs):
    rows, df = docs
    got = substring_dedup.remove_repeated_words(df)
    assert counted(got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))) == plain.substring_dedup(rows)
    first = got.where("n_removed > 0").first()
    assert sum(s["end"] - s["start"] for s in first.spans) == first.n_removed and got.columns.count("n_words") == 1


def test_suffix_array_dedup(spark, docs):
    rows, df = docs
    got = suffix_array_dedup.remove_repeated_bytes(df)
    assert counted(got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))) == plain.suffix_dedup(rows)


def test_hot_anchors_give_the_same(spark):
    """More runs round one anchor than HOT_RUNS: its windows are dealt one by one."""
    rng = random.Random(3)
    shared = " ".join(f"{rng.choice(plain.SYLLABLES)}{k}" for k in range(40))
    rows = [(i, plain.prose(rng, 20) + shared + " " + plain.prose(rng, 20)) for i in range(repeats.HOT_RUNS + 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = suffix_array_dedup.remove_repeated_bytes(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert counted(got) == plain.suffix_dedup(rows)
    got = substring_dedup.remove_repeated_words(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert counted(got) == plain.substring_dedup(rows)


def test_small_windows_and_blocks(monkeypatch):
    """Runs that block boundaries cut are joined again."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc ") for _ in range(rng.randint(0, 900))) for _ in range(12)]
    import pyarrow as pa

    table = pa.table({"_id": pa.array(range(12), pa.int64()), "_text": pa.array(texts)})
    windows = repeats.Windows("byte", 20, 9)
    whole = repeats.Anchors(repeats.Tokens(tables.Texts(table), "byte"), windows)
    monkeypatch.setattr(repeats, "_BLOCK", 64)
    cut = repeats.Anchors(repeats.Tokens(tables.Texts(table), "byte"), windows)
    for name in ("key", "pos", "first", "last", "run"):
        assert np.array_equal(np.sort(getattr(whole, name)), np.sort(getattr(cut, name))), name
    covered = sorted((f, l) for f, l in zip(whole.first, whole.last, strict=True))
    assert sum(l - f + 1 for f, l in covered) == sum(max(0, len(t) - 19) for t in texts)


def test_window_classes_equal_strings():
    rng = random.Random(2)
    for length in (8, 9, 16, 17, 33, 50, 70):
        data = np.array([rng.choice(b"ab") for _ in range(200)] * 3 + [rng.choice(b"ab") for _ in range(300)], np.uint8)
        starts = np.arange(len(data) - length + 1)
        got = suffix_array_dedup.window_classes(data, starts, length).tolist()
        strings = [data[s : s + length].tobytes() for s in starts]
        assert len(set(zip(got, strings, strict=True))) == len(set(got)) == len(set(strings)), length


def shard_pieces(windows, passages: int, docs: int):
    """What two chunks of documents put together from shared passages send to one shard."""
    import pyarrow as pa

    rng = random.Random(8)
    shared = [plain.prose(rng, 9) for _ in range(passages)]
    texts = [" ".join(f"{rng.choice(shared)} {plain.prose(rng, 1)}" for _ in range(6)) for _ in range(docs)]
    half = len(texts) // 2
    tabs = [pa.table({"_id": pa.array(range(lo, lo + half), pa.int64()), "_text": texts[lo : lo + half]}) for lo in (0, half)]
    asked = pa.concat_tables([repeats._first_ask(windows, 1, True)((pa.scalar(i),), t) for i, t in enumerate(tabs)])
    first = repeats._first_answer((pa.scalar(0),), asked)
    chosen = [first.filter(pa.array([c == i for c in first.column("_chunk").to_pylist()])) for i in range(2)]
    return pa.concat_tables([repeats._second_ask(windows, 1, True)((pa.scalar(i),), t, c) for i, (t, c) in enumerate(zip(tabs, chosen, strict=True))])


def test_shards_compare_in_parts():
    """A shard never holds all its pieces for sorting at once, equal windows meet, and answers are bits."""
    import pyarrow as pa

    windows = repeats.Windows("byte", 50, 24)
    pieces = shard_pieces(windows, 60, 80)
    seen = []

    def compare(tokens, lengths, owners):
        cut = np.cumsum(lengths) - lengths
        seen.append([tokens[b + i : b + i + 50].tobytes() for b, n in zip(cut, lengths, strict=True) for i in range(n - 49)])
        return np.zeros(len(seen[-1]), np.uint8)

    told = repeats._second_answer(windows, compare)((pa.scalar(0),), pieces)
    everything = [w for part in seen for w in part]
    assert len(everything) > 5000 and max(map(len, seen)) < len(everything) / 4
    assert sum(len(set(part)) for part in seen) == len(set(everything))
    assert sum(map(len, told.column("told").to_pylist())) < len(everything) / 4


def test_shards_sort_in_little_memory():
    """Sorting a shard's pieces takes a few times their bytes, not over 100 times."""
    import pyarrow as pa

    windows = repeats.Windows("byte", 50, 24)
    pieces = shard_pieces(windows, 4000, 4000)
    sent = sum(map(len, pieces.column("tokens").to_pylist()))
    answer = repeats._second_answer(windows, suffix_array_dedup._earlier(50))
    tracemalloc.start()
    try:
        answer((pa.scalar(0),), pieces)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sent > 1_000_000 and most < 12 * sent, (sent, most)


def test_classes_refine_beyond_one_word():
    """Keys of two pointers and a place that no machine word holds are sorted whole."""
    rng = np.random.default_rng(3)
    pointers = rng.integers(0, 1 << 23, 300_000).astype(np.int32)
    later = rng.integers(0, 3, 300_000).astype(np.int32) << 22
    pointers[::2] = pointers[1::2]
    parts = suffix_array_dedup.refine(suffix_array_dedup.bucket_pointers(pointers.astype(np.uint64), 23), later)
    assert len(set(parts.tolist())) == len(set(zip(pointers.tolist(), later.tolist(), strict=True)))


def test_suffix_automaton_counts():
    rng = random.Random(4)
    texts = [[rng.randint(0, 2) for _ in range(rng.randint(0, 30))] for _ in range(12)]
    automaton = substring_dedup.SuffixAutomaton()
    for k, t in enumerate(texts):
        automaton.add(t, k + 1)
    automaton.close()
    for n in (1, 3, 5):
        want = Counter()
        for k, t in enumerate(texts):
            for p in range(len(t) - n + 1):
                want[tuple(t[p : p + n])] += k + 1
        for t in [*texts, [0, 1, 9, 0, 1, 2, 2]]:
            assert automaton.ends(t, n) == [want[tuple(t[e - n + 1 : e + 1])] if e >= n - 1 else 0 for e in range(len(t))]


def test_clean_texts_keep_whole_characters(spark):
    rows = [(1, "é" * 40), (2, "x" + "é" * 40 + "z"), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long"))
    got = {r.doc_id: (r.text, r.n_chars) for r in suffix_array_dedup.clean_texts(df).collect()}
    assert got == {1: ("é" * 40, 40), 2: ("xz", 2), 3: (None, 0), 4: ("", 0)}


def test_stages_keep_clashing_columns(spark):
    """Columns named like added or internal ones come through each stage with their own values."""
    import corpus_pipeline

    names = "_null n_bytes n_removed n_spans spans kept _rest _chunk ids n_tokens round_trip decoded n_words n_hit items code component_id _column0".split()
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)
    rows = [(i, "word " * i + f"own {i}", *[f"{n}{i}" for n in names]) for i in range(30)]
    df = spark.createDataFrame(rows, schema)
    sf = "/root/testdata/sf0.001"
    for stage in (corpus_pipeline.simhash_near_dedup, corpus_pipeline.suffix_array_dedup, corpus_pipeline.benchmark_decontamination):
        out = stage(spark, df, sf)
        assert out.columns == df.columns
        got = {r.doc_id: r for r in out.collect()}
        assert got and all(r[n] == f"{n}{i}" for i, r in got.items() for n in names)
    coded = corpus_pipeline.sentencepiece_coding(spark, df, sf)
    added = ("ids", "n_tokens", "round_trip")
    assert coded.columns == [f"source_{c}" if c in added else c for c in df.columns] + list(added)
    assert all(r[f"source_{n}" if n in added else n] == f"{n}{r.doc_id}" for r in coded.collect() for n in names)


@pytest.mark.parametrize("call", [substring_dedup.remove_repeated_words, suffix_array_dedup.remove_repeated_bytes, simhash_dedup.near_duplicates, suffix_array_dedup.clean_texts])
def test_empty_tables(spark, call):
    assert call(spark.createDataFrame([], "doc_id long, text string, extra int")).count() == 0


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(150)] + [(k, k + 1) for k in range(500, 560)] + [(600, k) for k in range(601, 700)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = plain.roots(700, links)
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: want[x] for x in nodes}


def test_fingerprints(spark, docs):
    rows, df = docs
    got = simhash_dedup.near_duplicates(df)
    want = [plain.simhash(t) for _, t in rows]
    near = [(a, b) for a in range(len(rows)) for b in range(a) if (want[a] ^ want[b]).bit_count() <= 3]
    root = plain.roots(len(rows), near)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    expected = Counter((i, f"{want[k]:016x}", least.get(root[k])) for k, (i, _) in enumerate(rows))
    assert counted(got.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")), "component_id")) == expected


def test_first_of_groups_keeps_columns(spark, docs):
    rows, df = docs
    kept = simhash_dedup.first_of_groups(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 5 in ids and not {60, 61, 62, 63, 64} & set(ids) and ids.count(None) == 2


@pytest.mark.parametrize("part", [1024, 7])
def test_all_near_fingerprints_are_linked(spark, monkeypatch, part):
    """Dense groups, cut into parts or not: the same components as all pairs give."""
    monkeypatch.setattr(simhash_dedup, "PART", part)
    rng = random.Random(part)
    centres = [rng.getrandbits(64) for _ in range(5)]
    codes = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(60)} | {rng.getrandbits(64) for _ in range(200)}
    codes = sorted(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "code long")
    links = [(signed.index(r.a), signed.index(r.b)) for r in simhash_dedup.fingerprint_links(df).collect()]
    pairs = [(a, b) for a in range(len(codes)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= 3]
    assert plain.roots(len(codes), links) == plain.roots(len(codes), pairs)


def vectors(seed: int = 1) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1):
        for _ in range(6):
            centre = rng.standard_normal(16)
            rows += [(centre + 0.05 * rng.standard_normal(16), label) for _ in range(8)]
        rows += [(rng.standard_normal(16), label) for _ in range(60)]
    rows += [(rows[0][0], 0)] * 5 + [(rows[0][0], 1), (rows[0][0], None), (np.zeros(16), 0), (np.zeros(16), 0), (rows[3][0][:8], 0), (rows[3][0][:8] * 2, 0)]
    out = [(k, [float(x) for x in v], lab) for k, (v, lab) in enumerate(rows)]
    n = len(out)
    out += [(n, None, 0), (n + 1, [], 0), (n + 2, [1.0, None], 0), (n + 3, [math.nan, 1.0], 0), (n + 4, [math.inf, 1.0], 0), (n + 5, [1.0, 1.0], 0), (n + 6, [2.0, 2.0], 0), (None, [2.0, 2.0], 0)]
    return out


def plain_links(rows, threshold: float = 0.98) -> Counter:
    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    pairs = []
    for a in range(n):
        for b in range(a):
            (i, u, x), (j, v, y) = rows[a], rows[b]
            if x is None or x != y or None in (i, j) or not usable(u) or not usable(v) or len(u) != len(v):
                continue
            if np.dot(u, v) / np.linalg.norm(u) / np.linalg.norm(v) >= threshold:
                pairs.append((a, b))
    degree = Counter(x for p in pairs for x in p)
    root = plain.roots(n, pairs)
    least: dict[int, int] = {}
    for k, r in enumerate(root):
        if rows[k][0] is not None:
            least[r] = min(rows[k][0], least.get(r, rows[k][0]))
    return Counter((r[0], degree[k], None if r[0] is None else least[root[k]], r[0] is None or r[0] == least[root[k]]) for k, r in enumerate(rows))


@pytest.mark.parametrize("block", [1024, 3])
def test_embedding_links(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("cid", F.lit(1)).repartition(3)
    assert counted(embedding_dedup.link_embeddings(df)) == plain_links(rows)


def test_embedding_recall_with_narrow_windows(spark, monkeypatch):
    """Pairs are still found when the window holds a small part of a label."""
    monkeypatch.setattr(embedding_dedup, "SEGMENT", 64)
    rng = np.random.default_rng(9)
    rows = []
    for k in range(400):
        v = rng.standard_normal(32)
        rows += [(2 * k, v.tolist(), 1), (2 * k + 1, (v + 0.1 * rng.standard_normal(32)).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.link_embeddings(df, window=8)
    want = plain_links(rows)
    linked = sum(n for (_, d, _, _), n in want.items() if d)
    found = sum(n for row, n in counted(got).items() if row[1] and row in want)
    assert found >= 0.9 * linked > 300


def test_embeddings_of_an_alike_label(spark, monkeypatch):
    """All links are found where a label's vectors share a direction, whatever the windows hold."""
    monkeypatch.setattr(embedding_dedup, "SEGMENT", 64)
    monkeypatch.setattr(embedding_dedup, "REST_BLOCK", 100)
    rng = np.random.default_rng(4)
    rows, shared = [], 3 * rng.standard_normal(32) / np.sqrt(32)
    for k in range(120):
        v = shared + rng.standard_normal(32) / np.sqrt(32)
        rows += [(2 * k, v.tolist(), 1), (2 * k + 1, (v + 0.6 * rng.standard_normal(32) / np.sqrt(32)).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = plain_links(rows)
    assert sum(n for (_, d, _, _), n in want.items() if d) > 100
    assert counted(embedding_dedup.link_embeddings(df, passes=2, window=2)) == want


def test_embeddings_empty(spark):
    assert embedding_dedup.link_embeddings(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
