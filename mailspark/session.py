"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # call sites recorded for each column operation cost more than building small plans
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Arrow batches are cut by bytes, because one mail can be far longer than another.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
}


def build_session(app: str = "mailspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def rows_per_batch(spark: SparkSession, most: int):
    """What runs inside sends Python workers at most so many rows at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    # 0 and below mean no bound
    spark.conf.set(key, str(min(int(before), most) if int(before) > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def pin_utc(spark: SparkSession) -> SparkSession:
    """Dates and day boundaries are UTC, whatever zone the host is in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names, so that a lost executor loses no data.

    Only a local master may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    in_use = spark.sparkContext._jsc.sc().getCheckpointDir()
    if in_use.isDefined():
        return named or in_use.get()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="mailspark-")
    spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Reliable checkpoint; never a local one, which dies with its executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
