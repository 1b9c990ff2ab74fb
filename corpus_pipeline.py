"""Training-data pipeline over ``documents``: filter languages, near duplicates and leaked benchmarks, hide secrets, pack.

Every stage reads all rows that the one before it wrote, and what it decides takes effect: documents that it rejects
are gone, texts that it changes are changed, languages that were missing are filled in.  All but the last return the
columns of ``documents``.  A null text has no language and goes in the first stage; repeated rows are copies, of which
the second stage keeps one; an empty table passes through every stage; further columns of ``documents`` pass through
all but the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontam, language_id, near_duplicates, packing, secret_scan
from tablewright.llm.common import documents, shared_dir

# Models, hashes and tokenizers are beyond SQL; tests hold run() against brute-force versions.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is determined, by filters learned from those that are not held out, and fill in
    the languages that are missing."""
    filters = language_id.learn(docs.where(~language_id.held_out()))
    return language_id.settle(docs, filters)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest id, of each group of near duplicates."""
    return near_duplicates.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item."""
    return decontam.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace the secrets in the texts; n_chars follows."""
    return secret_scan.redact(docs, secret_scan.learn(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs.select(F.col("doc_id"), F.col("text")))


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_each),
    ("benchmark_decontamination", without_benchmark),
    ("secret_scan", without_secrets),
    ("lexical_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are a Parquet table in the shared folder."""
    docs, folder = documents(spark, sf_dir), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        table = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(table)
        docs = spark.read.parquet(table)
    return docs
