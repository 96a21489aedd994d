"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again.

Toxic documents go; lines that three documents or more share stay only in the one with the largest id; one document
of each group of near-duplicates stays; documents with passages of the benchmark go; the rest is encoded. Each stage
judges what the one before has kept. Null texts pass as they are and have no tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlift.llm import bpe_codec, decontaminate, line_dedup, minhash_dedup, toxicity
from chartlift.runtime import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, trained on their labelled part, does not reject."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with fewer lines; n_chars, where there is such a column, follows the text."""
    kept = line_dedup.drop_repeated_lines(docs)
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(kept.schema["n_chars"].dataType))
    return kept


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group."""
    return minhash_dedup.keep_first_of_groups(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of ids and decoded text."""
    return bpe_codec.encode_decode(docs, with_ids=True)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]

# A trained machine and merges cannot be written in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
