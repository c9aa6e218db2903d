"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from gridcast.llm import (
    chat_format,
    exact_search,
    fill_middle,
    filter_audit,
    license_scan,
    mixing,
    ngram_join,
    passage_dedup,
    piece_sampling,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    toxicity,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = exact_search.vectors_of(_table(spark, sf_dir, "embeddings"))
    return exact_search.search(vectors, vectors.where("vec_id % 100 = 0"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.fit(license_scan.sample_lines(docs)))


def op3_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.round_trip(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.clean_documents(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lines_removed", "lost_chars", "kept"
    )


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k and 2k + 1 as the chosen and the rejected one of pair k."""
    turns = _table(spark, sf_dir, "conversations")
    return chat_format.preference_pairs(turns, F.floor(F.col("conv_id") / 2), F.col("conv_id") % 2 == 0)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(_table(spark, sf_dir, "documents"))


def op10_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passage_dedup.remove_passages(_table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_in_middle(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_search": op1_exact_search,
    "op2_license_scan": op2_license_scan,
    "op3_piece_sampling": op3_piece_sampling,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_chat_format": op6_chat_format,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_mixing": op8_mixing,
    "op9_ngram_join": op9_ngram_join,
    "op10_passage_dedup": op10_passage_dedup,
    "op11_toxicity": op11_toxicity,
    "op12_filter_audit": op12_filter_audit,
    "op13_fill_middle": op13_fill_middle,
    "pipeline": pipeline,
}
