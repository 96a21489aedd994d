"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chartlift.llm import bpe_codec, chat_format, decontaminate, line_dedup, minhash_dedup, oracles, quality_model, quality_rules, spelling, suffix_dedup, token_alignment, token_counts, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_token_counts")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"))


@query("op2_bpe_codec")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_codec.encode_decode(table(spark, folder, "documents"))


@query("op4_decontaminate", oracles.DECONTAMINATE)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.find_contamination(documents, benchmark, with_spans=False)


@query("op7_line_dedup", oracles.LINES)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, folder, "documents"), with_text=False)


@query("op9_quality_rules", oracles.quality_rules())
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, folder, "documents")).drop("char_divergence", "word_divergence")


@query("op10_minhash_dedup", oracles.NEAR_DUPLICATES)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, folder, "documents"))


@query("op3_suffix_dedup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents")).drop("spans")


@query("op5_toxicity")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_quality_model")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_chat_format")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.format_chats(table(spark, folder, "conversations"))


@query("op11_warc_archives", oracles.ARCHIVED_PAGES)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(table(spark, folder, "pages")).drop("url")


@query("op12_token_alignment")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.alignment(table(spark, folder, "documents"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
