"""The number of shards follows the bytes and changes no result."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
pytest.importorskip("firmweave.llm")

from pyspark.sql import functions as F  # noqa: E402

import plain  # noqa: E402
from firmweave.llm import embedding_dedup, kneser_ney, simhash_dedup, substring_dedup, suffix_array_dedup, tables  # noqa: E402
from test_llm_dedup import counted, plain_links, vectors  # noqa: E402


@pytest.fixture(params=[1, 3, 300])
def number(request, monkeypatch):
    monkeypatch.setattr(tables, "shards", lambda spark, filled: request.param)
    return request.param


def test_repeats(spark, number):
    rows = plain.odd_documents(4)
    df = plain.frame(spark, rows)
    got = substring_dedup.remove_repeated_words(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert counted(got) == plain.substring_dedup(rows)
    got = suffix_array_dedup.remove_repeated_bytes(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert counted(got) == plain.suffix_dedup(rows)


def test_fingerprints_and_embeddings(spark, number):
    rows = plain.odd_documents(4)
    got = simhash_dedup.near_duplicates(plain.frame(spark, rows)).select("doc_id", "component_id")
    want = [plain.simhash(t) for _, t in rows]
    root = plain.roots(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (want[a] ^ want[b]).bit_count() <= 3])
    least = {r: min((i for k, (i, _) in enumerate(rows) if root[k] == r and i is not None), default=None) for r in root}
    assert counted(got) == Counter((i, least[root[k]]) for k, (i, _) in enumerate(rows))
    vecs = vectors(2)
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>, label int")
    assert counted(embedding_dedup.link_embeddings(df)) == plain_links(vecs)


def test_language_model(spark, number):
    from test_llm_text import plain_scores

    rows = [r for r in plain.odd_documents(4) if r[0] is not None]
    held = [i % 3 == 1 for i, _ in rows]
    got = kneser_ney.score_texts(plain.frame(spark, rows), F.pmod("doc_id", F.lit(3)) == 1, 3)
    have = sorted((r.doc_id, r.n_tokens, r.n_known, round(r.score, 6)) for r in got.collect())
    want = sorted((i, s[0], s[1], round(s[4], 6)) for (i, _), s in zip(rows, plain_scores(rows, held, 3), strict=True))
    assert [h[:3] for h in have] == [w[:3] for w in want]
    assert [h[3] for h in have] == pytest.approx([w[3] for w in want], abs=1e-5)


def test_number_follows_the_bytes(spark, monkeypatch):
    least = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 200).alias("text")).coalesce(1)
    chunks = tables.chunk_table(docs, size=1 << 12)
    assert tables.text_shards(chunks, 1 << 12) == least
    monkeypatch.setattr(tables, "SHARD_BYTES", 100)
    assert tables.text_shards(chunks, 1 << 12) >= 50 * 1000 / 100
    assert tables.row_shards(spark.range(1000), F.col("id") * 0 + 80) == 800
    assert tables.row_shards(spark.range(0), F.col("id")) == least
