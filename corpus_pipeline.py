"""From raw documents to token ids: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadlens.llm import bpe, decontaminate, language_id, near_dedup, quality
from threadlens.llm.common import fold, table
from threadlens.sources.scratch import materialize


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; it learns from the rows of this stage that are not held out."""
    network = language_id.fit(docs.where(fold() != 1))
    judged = language_id.identify(docs, network, into="__language")
    return judged.where(language_id.trusted(F.col("__language"))).drop("__language")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above the quality cut."""
    ranker = quality.fit(docs.where(fold() != 1), table(spark, sf_dir, "labels").where(fold() != 1))
    return docs.withColumn("__score", quality.score_column(F.col("text"), ranker)).where("__score >= 0.5").drop("__score")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of every group of near duplicates."""
    kept = near_dedup.near_duplicates(docs, percent=80).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi")


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(found, F.col("doc_id").eqNullSafe(F.col("__id")), "left_anti")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and character offsets of every document, and whether decoding gives the text back."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode_column(docs, path, public_tokenizers.PATTERN, decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "starts", "ends",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language ID", known_language), ("quality classifier", good_quality), ("near-duplicates", one_of_each),
          ("decontamination", no_benchmark), ("byte-level BPE", token_ids)]

# Fitted models and a vocabulary decide here, so no SQL states the rows; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
