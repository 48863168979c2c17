"""Documents to token ids: judge, drop near copies, cut repeats, drop leaks, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmweave.llm.decontaminate import clean_documents
from firmweave.llm.quality import accepted
from firmweave.llm.queries import read, tokenizer_file
from firmweave.llm.sentencepiece_codec import decode_ids, encode_texts
from firmweave.llm.simhash_dedup import first_of_groups
from firmweave.llm.suffix_array_dedup import clean_texts
from firmweave.llm.tables import settle


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged neither of low quality nor toxic."""
    return accepted(docs, read(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group linked by fingerprint: three-word shingles, three bits at most."""
    return first_of_groups(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what an earlier document holds."""
    return clean_texts(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return clean_documents(docs, read(spark, sf_dir, "benchmark"))


def sentencepiece_coding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ids; ``round_trip`` tells whether decoding gives the text back.

    A column that is there already under the name of an added one is kept as ``source_<name>``.
    """
    path = tokenizer_file("piece_bpe_32k.model")
    added = ["ids", "n_tokens", "round_trip"]
    names = [f"source_{c}" if c in added else c for c in docs.columns]
    safe = {c: c if c == "text" else f"_column{i}" for i, c in enumerate(docs.columns)}
    coded = decode_ids(encode_texts(docs.toDF(*safe.values()), path), path)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    kept = [F.col(safe[c]).alias(n) for c, n in zip(docs.columns, names, strict=True)]
    return coded.select(*kept, "ids", F.size("ids").cast("bigint").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_coding),
]

# Fingerprints, sampled weights and subword ids have no SQL form; tests compare with plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = settle(docs, f"pipeline_{i}")
    return docs
