"""Run-stamped snapshots, stage hand-offs and JDBC tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows per insert statement, and connections.
INSERT_BATCH = 50
CONNECTIONS = 10
ROWS_PER_FILE = 100_000


def write_snapshot(
    df: DataFrame,
    base: str,
    run_ts: dt.datetime,
    label_col: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Gzip JSON below run_ts=dd-MM-yyyy-HH-mm-ss and, if given, the label. One job writes all
    labels. A run owns its folder: running it again replaces it. Gzip cannot be split, so a
    file holds rows_per_file rows at most."""
    writer = df.write.mode("overwrite").option("compression", "gzip")
    writer = writer.option("maxRecordsPerFile", rows_per_file)
    if label_col:
        writer = writer.partitionBy(label_col)
    writer.json(f"{base}/run_ts={run_ts:%d-%m-%Y-%H-%M-%S}")


def read_snapshot(spark: SparkSession, base: str, schema: str, run_ts: str | None = None):
    """`schema` names the columns inside the files and the partition keys wanted."""
    df = spark.read.schema(schema).json(base)
    return df if run_ts is None else df.where(F.col("run_ts") == run_ts)


def write_frame(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def read_frame(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


@dataclass(frozen=True)
class Handoff:
    """Frames passed from one stage of a run to the next, oldest first.

    Each run has a folder of its own, so it never meets the leftovers of another one,
    and pushing a sequence number again replaces it: a retried stage does no harm.
    """

    base: str
    run_id: str

    def _path(self, queue: str) -> str:
        return f"{self.base}/{queue}/run_id={self.run_id}"

    def push(self, queue: str, df: DataFrame, seq: int) -> None:
        df.write.mode("overwrite").parquet(f"{self._path(queue)}/seq={seq}")

    def pop(self, spark: SparkSession, queue: str, after: int = -1) -> DataFrame:
        """The oldest frame pushed after `after`, with its seq."""
        waiting = spark.read.parquet(self._path(queue)).where(F.col("seq") > after)
        oldest = waiting.agg(F.min("seq").alias("seq")).scalar()
        return waiting.where(F.col("seq") == oldest)


def read_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """In one task, unless options name partitionColumn, lowerBound, upperBound and
    numPartitions."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    batch: int = INSERT_BATCH,
    connections: int = CONNECTIONS,
    **options: str,
) -> None:
    df.write.format("jdbc").options(
        url=url, dbtable=table, batchsize=batch, numPartitions=connections, **options
    ).mode("append").save()
