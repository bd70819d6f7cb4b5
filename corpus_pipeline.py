"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from creditloom.llm import decontamination, language_id, ngram_join, secret_scan, source_mixing
from creditloom.llm.text import table
from creditloom.session import shared_folder


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID (7): texts without a known language go."""
    return language_id.in_known_language(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (5): the document with the smallest id of each group stays."""
    return ngram_join.one_of_each_group(docs)


def without_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination (3): documents that hold a benchmark item go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def with_masked_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans (4): documents stay, their secrets are masked and n_chars follows."""
    return secret_scan.masked(docs)


def mixed_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights (6): the sampled documents and their probability."""
    mixed = source_mixing.mix(docs)
    return mixed.where("sampled").select("doc_id", "source", "lang", "topic", "n_tokens", "factor", "probability")


STAGES = [
    ("language ID", in_a_language),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark_items),
    ("secret scans", with_masked_secrets),
    ("mixing sources to target weights", mixed_to_targets),
]

# Viterbi labels, edit distances and raked weights are beyond SQL; tests hold run() against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline/{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
