"""The mailbox state as a written table, by day, and the changes a run makes to it.

A run rewrites only the days that hold a changed message. What is purged stays as a row with
purged_at, so a day is never left without rows and a rerun changes nothing; readers do not see
it. Each run's changes are kept in an audit table, in a folder of the run's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailspark.operators.triage import apply_labels
from mailspark.session import scratch_dir

DAY = "day"


def write_state(state: DataFrame, path: str) -> None:
    """A new table; purged_at is added where it is missing."""
    if "purged_at" not in state.columns:
        state = state.withColumn("purged_at", F.lit(None).cast("timestamp"))
    state.withColumn(DAY, F.to_date("received_at")).write.partitionBy(DAY).parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where("purged_at IS NULL").drop("purged_at")


def touched_days(state: DataFrame, ids: DataFrame) -> list:
    """Days that hold any of the ids. The driver gets one value a day."""
    days = state.select("id", DAY).join(ids, "id", "left_semi").select(DAY).distinct()
    return sorted((r[DAY] for r in days.collect()), key=str)


def commit_changes(
    spark: SparkSession,
    path: str,
    trashed: DataFrame,
    purged: DataFrame,
    at: Column,
    audit_path: str,
    run_id: str,
) -> None:
    """Moves `trashed` ids to the trash and purges `purged` ids. An id in both is trashed only:
    a run does not purge what it trashed itself. One writer at a time."""
    trashed = trashed.select("id").distinct()
    purged = purged.select("id").distinct().join(trashed, "id", "left_anti")
    changes = trashed.withColumn("action", F.lit("trashed")).unionByName(
        purged.withColumn("action", F.lit("purged"))
    )
    audit = f"{audit_path}/run_id={run_id}"
    changes.withColumn("at", at).write.mode("overwrite").parquet(audit)
    changes = spark.read.parquet(audit)
    state = spark.read.parquet(path)
    days = touched_days(state, changes.select("id"))
    if not days:
        return
    touched = state.where(F.col(DAY).isin(*[d for d in days if d is not None]) | (
        F.col(DAY).isNull() if None in days else F.lit(False)
    ))
    moved = apply_labels(touched, changes.where("action = 'trashed'"), at)
    gone = changes.where("action = 'purged'").select("id", F.lit(True).alias("gone"))
    new = moved.join(gone, "id", "left").withColumn(
        "purged_at", F.when(F.col("gone"), F.coalesce("purged_at", at)).otherwise(F.col("purged_at"))
    )
    staged = scratch_dir(spark, "state")
    new.select(*state.columns).write.partitionBy(DAY).parquet(staged)
    (
        spark.read.schema(state.schema).parquet(staged)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )
