"""One query per operator, over whole tables with production parameters.

None has an SQL twin: SQL cannot express the merges, signatures, indexes and models, so
tests/llm holds each against a brute-force version, a round trip or held-out accuracy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mailspark.llm.common import table
from mailspark.llm.decontamination import contamination_report
from mailspark.llm.fingerprints import fingerprint_report
from mailspark.llm.language_id import identify, learn
from mailspark.llm.license_scan import scan_licenses
from mailspark.llm.mixing import REPEATS, mixing_report
from mailspark.llm.near_dedup import near_duplicates
from mailspark.llm.packing import pack_documents
from mailspark.llm.periodic_runs import run_report, with_repeats
from mailspark.llm.pii import find_personal_data
from mailspark.llm.secret_scan import scan_secrets
from mailspark.llm.token_alignment import align_tokens
from mailspark.llm.token_counts import count_tokens
from mailspark.llm.token_files import through_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


@query
def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(table(spark, sf_dir, "documents"))


@query
def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_token_files(table(spark, sf_dir, "documents"))


@query
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_report(table(spark, sf_dir, "documents"), repeats=REPEATS)


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).drop("ids")


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(with_repeats(table(spark, sf_dir, "documents")))


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"))
