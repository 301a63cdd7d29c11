"""What the operators of this package share.

All of them keep text in Spark partitions: a Python step gets Arrow batches, holds one
batch and bounded tables, and gives Arrow batches back. Nothing is kept on local disk, so a
lost executor costs only the tasks it ran.
"""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from mailspark.session import pin_utc

# Words of the contracts: runs of ASCII letters and digits and of all non-ASCII characters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Texts to a batch. A batch is also cut by bytes, so long texts come in smaller ones.
BATCH_ROWS = 1000
BATCH_BYTES = 16 * 1024 * 1024


def text_session(spark: SparkSession) -> SparkSession:
    """For the queries: UTC, and batches small enough for Python workers of 400 MB."""
    pin_utc(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return text_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def worker_state(key: tuple, make: Callable):
    """A table that lives as long as the Python worker and is made once in it.

    Functions reach the workers by value, so module globals would be new in each task.
    """
    home = sys.modules.setdefault("_mailspark_workers", types.ModuleType("_mailspark_workers"))
    kept = home.__dict__.setdefault("kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def only_state(key: tuple, make: Callable):
    """Like worker_state, but the worker's other tables, left by steps that ran before in the same
    session, are let go first."""
    home = sys.modules.get("_mailspark_workers")
    kept = home.__dict__.get("kept", {}) if home else {}
    others = [other for other in kept if other != key]
    for other in others:
        del kept[other]
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
    return worker_state(key, make)


def latest_state(name: str, key: str, make: Callable):
    """Like worker_state, but only the table of the last key of a name is kept."""
    held = worker_state((name,), dict)
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


class BoundedCache(dict):
    """word -> value by `make`; emptied when it holds `limit` words, so memory is bounded."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def strings(column) -> list[str]:
    """An Arrow column as Python strings; null is empty."""
    return [x or "" for x in column.to_pylist()]


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str
) -> DataFrame:
    """`fn` gives the output columns of each batch as lists or arrays, by the names of
    `schema` (DDL)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                got = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[f.name], type=f.type) for f in target], schema=target
                )

    return df.mapInArrow(run, schema)


def with_id(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, text) and nothing else: other columns, whatever their names, stay behind."""
    return df.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def own_columns(df: DataFrame) -> list:
    """The columns of a table as they are, whatever is in their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def as_rows(df: DataFrame) -> DataFrame:
    """One struct column `__row`, so that no name of the table can clash with others."""
    return df.select(F.struct(*own_columns(df)).alias("__row"))
