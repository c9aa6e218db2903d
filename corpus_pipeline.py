"""The corpus pipeline: stages over documents, each built on one operator of gridcast.llm.

A stage is a function of (session, the documents that the stage before it kept, folder of the given tables). What it
returns is written as Parquet and read again as the next stage's documents. All but the last return the columns of
documents; the last returns one row per document with its sampled pieces.

Rows without an id pass the joins of a stage by a null-safe comparison. A text of null is a text without words.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridcast.llm import mixing, ngram_join, piece_sampling, quality_classifier, suffix_dedup
from gridcast.session import shared_dir

# A stage that hands whole rows to Python takes them in batches of so many bytes.
BATCH_BYTES = "4m"

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking, learnt from their labels, puts at or above its threshold."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    ranking = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.score_documents(docs.select(*COLUMNS), ranking).where("_score >= 0.5").drop("_score")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the least id (null ids last) and then the least hash of its
    text; documents without words all stay. The classes are those of the texts: rows may share an id or have none."""
    rows = docs.select(*COLUMNS, F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"), ngram_join.text_hash().alias("_hash"))
    words = F.rlike(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]"))
    # Rows with one id and text are copies too. The limit to the first row works per task, before the shuffle.
    first = Window.partitionBy("_none", "_id", "_hash").orderBy("lang", "source", "n_chars")
    single = rows.where(words).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    leader = F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"), F.col("text_hash").alias("_hash")
    kept = single.join(ngram_join.leaders(docs).select(*leader), ["_none", "_id", "_hash"], "left_semi")
    return kept.select(*COLUMNS).unionByName(rows.where(~words).select(*COLUMNS))


def trim(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that documents with smaller ids have; n_chars follows the text. A document of
    which nothing is left goes, unless it had no text before."""
    carry = ("_null", "lang", "source", "n_chars")
    cut = suffix_dedup.remove_repeats(docs.select(*COLUMNS, F.col("text").isNull().alias("_null")), keep_text=True, carry=carry)
    text = F.when(F.col("_c__null"), F.lit(None)).otherwise(F.col("kept_text"))
    left = cut.where((F.col("n_removed") == 0) | (F.col("kept_text") != ""))
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("_c_n_chars"))
    return left.select("doc_id", text.alias("text"), F.col("_c_lang").alias("lang"), F.col("_c_source").alias("source"), n_chars.alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: rows repeat up to `mixing.MAX_REPEATS` times, or go."""
    return mixing.mix_rows(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, pieces, n_pieces, lossless: a sampled segmentation of each document."""
    return piece_sampling.round_trip(docs)


STAGES = [
    ("quality classifier", classify),
    ("n-gram Jaccard join", deduplicate),
    ("suffix-array dedup", trim),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

#: The classifier's arithmetic and the sampled pieces are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; what they hand on lies in the folder the cluster shares."""
    folder = f"{shared_dir(spark)}/gridcast/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
