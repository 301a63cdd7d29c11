"""From documents to training files: language, near-duplicates, test sets, mix, token ids.

Each stage takes what the one before kept, written as Parquet and read again; all but the last
give the columns of documents.

Null, empty and letterless texts go with the first stage. Very long texts pass whole. Repeated rows
are copies of one class, of which one row stays; the mix may let documents of rare cells come up to
mixing.REPEATS times, so that the shares hold without dropping common ones. An empty table gives no
rows. Columns of the table stay, whatever their names, up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mailspark.llm import decontamination, language_id, mixing, near_dedup, token_files
from mailspark.llm.common import table, text_session
from mailspark.session import scratch_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without one go."""
    text_session(spark)
    return language_id.keep_identified(docs, language_id.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    text_session(spark)
    return near_dedup.keep_first(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the test sets."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to flattened shares of source, language and topic."""
    text_session(spark)
    return mixing.mix(docs, repeats=mixing.REPEATS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written to files; one row for each document, read back from them."""
    text_session(spark)
    return token_files.through_token_files(docs)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmarks),
    ("mixing", mixture),
    ("token_files", token_ids),
]

# Signatures, indexes and coders are beyond SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
