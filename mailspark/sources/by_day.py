"""Messages as a table with a folder a day, read by ranges of days.

A range asked for with dates prunes folders when the query is planned; a table of ranges prunes
them when it runs, by the days it holds. The newest day is known from the folders' names.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from mailspark.functions.dates import DAY_FORMAT

DAY = "day"


def write_by_day(messages: DataFrame, path: str, at: str = "received_at") -> None:
    """One folder a day. Tasks get ranges of days and, within a day, of hashes of the ids: a day is
    one file or two where days are many, and a busy day is not one task's."""
    (
        messages.withColumn(DAY, F.to_date(at))
        .withColumn("_of_id", F.xxhash64("id"))
        .repartitionByRange(DAY, "_of_id")
        .drop("_of_id")
        .write.partitionBy(DAY).parquet(path)
    )


def read_by_day(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def newest_day(spark: SparkSession, path: str) -> dt.date | None:
    """The last day that has a folder; no file is opened."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = (entry.getPath().getName() for entry in system.listStatus(folder))
    days = (n.partition("=")[2] for n in names if n.startswith(f"{DAY}="))
    return max((dt.date.fromisoformat(d) for d in days if d[:1].isdigit()), default=None)


def in_days(messages: DataFrame, from_date: dt.date, days: int) -> DataFrame:
    """Messages of the `days` days before from_date; other folders are not listed for reading."""
    first = from_date - dt.timedelta(days=days)
    return messages.where((F.col(DAY) >= F.lit(first)) & (F.col(DAY) < F.lit(from_date)))


def in_ranges(messages: DataFrame, ranges: DataFrame) -> DataFrame:
    """Messages with the range (after_date, before_date) of one day they fall into. Only the days
    of `ranges`, a row for each day asked for, are read, where Spark finds the ranges small enough
    to broadcast; if not, the join is a shuffle and gives the same."""
    asked = ranges.select(
        "after_date", "before_date", F.to_date("after_date", DAY_FORMAT).alias(DAY)
    )
    # the comparison makes the ranges selective in the eyes of the planner
    asked = asked.where(F.col(DAY) > F.lit(dt.date(1000, 1, 1)))
    return messages.join(asked, DAY)
