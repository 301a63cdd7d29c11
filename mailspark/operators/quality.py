"""Counts and checks of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def run_counts(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: all rows, and the rows meeting each named condition."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(c).alias(name) for name, c in conditions.items()],
    )


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def request_report(df: DataFrame, subject: str = "subject", body: str = "body") -> DataFrame:
    """What a scoring request must satisfy: there are rows, and as many subjects as
    bodies."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(subject).alias("subjects"),
        F.count(body).alias("bodies"),
    )
    valid = (F.col("rows") > 0) & (F.col("subjects") == F.col("rows")) & (
        F.col("bodies") == F.col("rows")
    )
    return counted.withColumn("valid", valid)


def require_request(df: DataFrame, subject: str = "subject", body: str = "body") -> DataFrame:
    """The same frame; a row without subject or body fails the job that reads it."""
    whole = F.col(subject).isNotNull() & F.col(body).isNotNull()
    said = F.lit("Subject and Body must have equal length.")
    return df.withColumn(
        subject, F.when(whole, F.col(subject)).otherwise(F.raise_error(said).cast("string"))
    )


def nothing_to_do(df: DataFrame) -> bool:
    """Gate at the edge of a job: reads as little as one row."""
    return df.isEmpty()
