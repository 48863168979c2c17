"""The pipeline's stages, each on what the one before has kept, against plain versions on the smallest tables."""

from __future__ import annotations

import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

import plain  # noqa: E402
import pytest  # noqa: E402
from test_llm_text import plain_contamination  # noqa: E402

import corpus_pipeline  # noqa: E402
from firmweave.llm.queries import ORACLES, QUERIES, tokenizer_file  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    frames = [spark.read.parquet(f"{SF}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, frames[-1], SF).write.parquet(str(folder / str(i)))
        frames.append(spark.read.parquet(str(folder / str(i))))
    return frames


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(stages):
    assert all(f.columns == stages[0].columns for f in stages[1:-1])
    assert set(stages[0].columns) < set(stages[-1].columns)


def test_quality_stage_drops_toxic_labels(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = stages[1].join(labels, "doc_id")
    assert stages[1].count() < stages[0].count()
    good = labels.where("quality = 1 AND toxic = 0")
    # Eleven toxic labels are few to learn from; held-out rates are tested on more.
    assert kept.where("toxic = 1").count() <= 0.5 * labels.where("toxic = 1").count()
    assert good.join(stages[1], "doc_id").count() >= 0.9 * good.count()


def test_simhash_stage_keeps_the_first(stages):
    docs = texts(stages[1])
    codes = [plain.simhash(t) for _, t in docs]
    near = [(a, b) for a in range(len(docs)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= 3]
    least: dict[int, int] = {}
    root = plain.roots(len(docs), near)
    for k, (i, _) in enumerate(docs):
        least[root[k]] = min(i, least.get(root[k], i))
    assert Counter(i for i, _ in texts(stages[2])) == Counter(least.values())


def test_suffix_stage_cuts_repeats(stages):
    before, after = dict(texts(stages[2])), dict(texts(stages[3]))
    assert before.keys() == after.keys()
    removed = {i: n for i, _, n, _, _ in plain.suffix_dedup(before.items())}
    # Whole characters go, so a little more than the bytes themselves.
    for i, text in before.items():
        cut = len(text.encode()) - len(after[i].encode())
        assert removed[i] <= cut <= removed[i] + 6 * (removed[i] > 0) * 20 and (cut > 0) == (removed[i] > 0)
    assert all(r.n_chars == len(r.text) for r in stages[3].collect())


def test_decontamination_stage(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = Counter(i for i, _, hit, _ in plain_contamination(texts(stages[3]), items).elements() if not hit)
    assert Counter(i for i, _ in texts(stages[4])) == clean


def test_coding_stage(stages):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    for r in stages[5].collect():
        assert r.ids == library.encode(r.text) and r.n_tokens == len(r.ids) and r.round_trip == (library.decode(r.ids) == r.text)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
