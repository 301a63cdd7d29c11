"""The landing table: one row per message id, whatever is sent twice.

A run is a partition. Its rows are written to a folder of their own, bucketed by id, and then the
partition is pointed to it: a reader sees the run as it was or as it is, and a crash in between
leaves it as it was.

Beside each folder lies a Bloom filter for each bucket, built from what was written. A batch asks
the filters first, bucket by bucket, which of its ids may have landed and in which runs. Only those
runs and buckets are opened; ids that no filter knows are new. A filter never misses an id, and one
that it knows by mistake is looked for and not found.

`compact` merges small runs into larger ones, level by level, so folders and filters grow with the
logarithm of the number of runs. A run that was merged is closed: its rows are no longer replaced,
and landing it again adds only ids that are not there.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from mailspark.operators.chunks import one_per_id
from mailspark.schemas import ID_LENGTH
from mailspark.session import scratch_dir

COLUMNS = ("id", "received_at", "subject", "payload")
FILTER = "bucket int, bits binary"
FILTERS = "_filters"
# Bits and probes of a filter for each id: it is wrong about one id in two thousand.
BITS_AN_ID = 16
PROBES = 6
LEAST_BITS = 4096
# So many possibly landed ids are named in the query, so that only their buckets are opened.
NAMED_IDS = 1000
# Runs of a level that are merged at a time, and newest runs that stay open.
FAN = 8
OPEN_RUNS = 8
MERGED = "merged-"
U64 = np.uint64


@dataclass(frozen=True)
class Part:
    """A partition: its run, the folder of its rows, and when it was made."""

    run_id: str
    folder: str
    made: int

    @property
    def level(self) -> int:
        """How often its rows were merged."""
        return int(self.run_id.split("-")[1]) if self.run_id.startswith(MERGED) else 0


def create_landing(
    spark: SparkSession, name: str, path: str, buckets: int | None = None
) -> None:
    """Bucketed by id, so that the check against landed ids shuffles only the batch.

    A bucket is one task's share, so choose `buckets` for the size the table will have,
    and not below spark.sql.shuffle.partitions, or Spark shuffles the table after all.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {name} (
            id STRING NOT NULL, received_at TIMESTAMP, subject STRING, payload STRING,
            run_id STRING)
        USING parquet PARTITIONED BY (run_id)
        CLUSTERED BY (id) INTO {buckets} BUCKETS
        LOCATION '{path}'"""
    )


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _bucket_count(spark: SparkSession, name: str) -> int:
    return int(_described(spark, name)["Num Buckets"])


def _folder(spark: SparkSession, name: str) -> str:
    return _described(spark, name)["Location"].rstrip("/")


def _catalog(spark: SparkSession, name: str):
    state = spark._jsparkSession.sessionState()
    return state.catalog(), state.sqlParser().parseTableIdentifier(name)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def parts_of(spark: SparkSession, name: str) -> list[Part]:
    """The partitions whose rows count, oldest first: not those that were merged already and
    are still to be dropped. From the catalog; no folder is listed."""
    catalog, table = _catalog(spark, name)
    none = spark._jvm.scala.Option.empty()
    found = catalog.listPartitions(table, none)
    parts = [
        Part(p.spec().apply("run_id"), p.location().toString(), p.createTime())
        for p in (found.apply(i) for i in range(found.size()))
    ]
    there = {p.run_id for p in parts}
    gone = {
        run for key, runs in _properties(spark, name).items()
        if key.startswith(MERGED) and key in there for run in runs.split(",")
    }
    return sorted((p for p in parts if p.run_id not in gone), key=lambda p: (p.made, p.run_id))


def _live(spark: SparkSession, name: str, parts: list[Part]) -> DataFrame:
    return spark.table(name).where(F.col("run_id").isin([p.run_id for p in parts]))


def new_rows(batch: DataFrame, landed: DataFrame) -> DataFrame:
    """The batch, one row per id, without the ids that have landed."""
    whole = batch.select(*COLUMNS)
    return one_per_id(whole, order_cols=("received_at",)).join(
        landed.select("id"), "id", "left_anti"
    )


def bucket_of(buckets: int):
    """The bucket Spark writes an id to."""
    return F.pmod(F.hash("id"), F.lit(buckets)).cast("int")


def _hashes(ids) -> np.ndarray:
    """Two 32-bit hashes of each id in one number, by Spark's xxhash64 of the id."""
    return np.asarray(ids).astype(U64)


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each id: PROBES steps of one half of its hash from the other."""
    low, high = hashes & U64(0xFFFFFFFF), (hashes >> U64(32)) | U64(1)
    steps = np.arange(PROBES, dtype=U64)[:, None]
    return ((low + steps * high) % U64(size)).astype(np.int64)


def filters_of(rows: DataFrame, buckets: int) -> DataFrame:
    """FILTER rows of some landed rows: a group is one bucket's ids as numbers."""

    def build(table: pa.Table) -> pa.Table:
        hashes = _hashes(table["h"])
        size = max(LEAST_BITS, -(-BITS_AN_ID * len(hashes) // 8) * 8)
        bits = np.zeros(size, dtype=bool)
        bits[_places(hashes, size).ravel()] = True
        return pa.table({
            "bucket": pa.array([table["bucket"][0].as_py()], pa.int32()),
            "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
        })

    return (
        rows.select(bucket_of(buckets).alias("bucket"), F.xxhash64("id").alias("h"))
        .groupBy("bucket").applyInArrow(build, FILTER)
    )


def may_have_landed(ids: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """(id, part) where the filter of the part's bucket knows the id. `filters` has part."""

    def probe(batch: pa.Table, known: pa.Table) -> pa.Table:
        hashes, names = _hashes(batch["h"]), batch["id"]
        out_ids, out_parts = [], []
        for part, data in zip(known["part"].to_pylist(), known["bits"]):
            bits = np.frombuffer(data.as_py(), dtype=np.uint8)
            at = _places(hashes, 8 * len(bits))
            hit = ((bits[at >> 3] >> (7 - (at & 7))) & 1).all(axis=0)
            found = names.filter(pa.array(hit))
            out_ids.append(found.combine_chunks())
            out_parts += [part] * len(found)
        whole = pa.concat_arrays(out_ids) if out_ids else pa.array([], names.type)
        return pa.table({"id": whole.cast(pa.string()), "part": pa.array(out_parts, pa.string())})

    asked = ids.select("id", bucket_of(buckets).alias("bucket"), F.xxhash64("id").alias("h"))
    return (
        asked.groupBy("bucket")
        .cogroup(filters.groupBy("bucket"))
        .applyInArrow(probe, "id string, part string")
    )


def _filter_folder(folder: str) -> str:
    return f"{folder}{FILTERS}"


def _filters(spark: SparkSession, parts: list[Part]) -> DataFrame | None:
    """(part, bucket, bits) of some parts. A part's folder names it in the files' paths."""
    if not parts:
        return None
    names = F.create_map(*[
        F.lit(x) for p in parts for x in (_filter_folder(p.folder).rpartition("/")[2], p.run_id)
    ])
    read = spark.read.schema(FILTER).parquet(*[_filter_folder(p.folder) for p in parts])
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return read.select(names[folder].alias("part"), "bucket", "bits")


def landed_of(batch_ids: DataFrame, name: str, parts: list[Part]) -> DataFrame | None:
    """The ids of the batch that have landed in some of the parts; None if no filter knows any,
    and then no landed row is read."""
    spark = batch_ids.sparkSession
    filters = _filters(spark, parts)
    if filters is None:
        return None
    path = scratch_dir(spark, "may-have-landed")
    may_have_landed(batch_ids, filters, _bucket_count(spark, name)).write.parquet(path)
    hits = spark.read.parquet(path)
    found = [r["part"] for r in hits.select("part").distinct().collect()]
    if not found:
        return None
    rows = spark.table(name).where(F.col("run_id").isin(found))
    few = [r["id"] for r in hits.select("id").distinct().limit(NAMED_IDS + 1).collect()]
    if len(few) <= NAMED_IDS:
        return rows.where(F.col("id").isin(few)).select("id").distinct()
    return rows.join(hits.select("id").distinct(), "id", "left_semi").select("id").distinct()


def _write_part(rows: DataFrame, name: str, run_id: str) -> str:
    """A new folder of bucketed rows with its filters; the folder."""
    spark = rows.sparkSession
    buckets, mark = _bucket_count(spark, name), uuid.uuid4().hex
    folder = f"{_folder(spark, name)}/parts/{run_id}-{mark}"
    staged = f"landing_{mark}"
    if buckets != int(spark.conf.get("spark.sql.shuffle.partitions")):
        # else the rows lie by id as the buckets do, and each task writes its own bucket
        rows = rows.repartition(buckets, "id")
    (
        rows.select(*COLUMNS)
        .write.format("parquet").bucketBy(buckets, "id").option("path", folder).saveAsTable(staged)
    )
    # the folder stays: the table is external
    filters_of(spark.table(staged), buckets).write.parquet(_filter_folder(folder))
    spark.sql(f"DROP TABLE {staged}")
    return folder


def _point(spark: SparkSession, name: str, run_id: str, folder: str) -> None:
    own = f"PARTITION (run_id = '{run_id}')"
    if spark.sql(f"SHOW PARTITIONS {name} {own}").count():
        spark.sql(f"ALTER TABLE {name} {own} SET LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {name} ADD {own} LOCATION '{folder}'")
    spark.catalog.refreshTable(name)


def land(batch: DataFrame, name: str, run_id: str) -> None:
    """Insert-if-absent. A run owns its partition and replaces it as a whole, so that
    running it again gives the same table, also if it brings nothing.

    run_id must be one run's own: what another run landed under it is lost. A table takes one
    writer at a time; two would each miss the ids of the other.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run_id) or run_id.startswith(MERGED):
        raise ValueError(f"run id {run_id!r} holds more than letters, digits, dots and dashes")
    spark = batch.sparkSession
    fits = F.col("id").isNotNull() & (F.length("id") <= ID_LENGTH)
    said = F.lit(f"id must hold 1 to {ID_LENGTH} characters")
    checked = batch.withColumn(
        "id", F.when(fits, F.col("id")).otherwise(F.raise_error(said).cast("string"))
    )
    path = scratch_dir(spark, "arrived")
    one_per_id(checked.select(*COLUMNS), order_cols=("received_at",)).write.parquet(path)
    rows = spark.read.parquet(path)
    others = [p for p in parts_of(spark, name) if p.run_id != run_id]
    known = landed_of(rows.select("id"), name, others)
    if known is not None:
        rows = rows.join(known, "id", "left_anti")
    _point(spark, name, run_id, _write_part(rows, name, run_id))


def compact(spark: SparkSession, name: str, fan: int = FAN, open_runs: int = OPEN_RUNS) -> int:
    """Merges `fan` runs of a level into one of the next, as often as there are that many; the
    newest `open_runs` runs stay as they are. Gives the number of merges.

    What a merged run replaces is named in the table's properties before it appears, and dropped
    after; in between only one of the two counts. One writer at a time.
    """
    _drop_merged(spark, name)
    merges = 0
    while True:
        by_level = defaultdict(list)
        parts = parts_of(spark, name)
        runs = [p for p in parts if not p.level]
        for part in [p for p in parts if p.level] + runs[: max(0, len(runs) - open_runs)]:
            by_level[part.level].append(part)
        ready = [(level, found) for level, found in sorted(by_level.items()) if len(found) >= fan]
        if not ready:
            return merges
        level, found = ready[0]
        found = found[:fan]
        merged = f"{MERGED}{level + 1}-{uuid.uuid4().hex}"
        folder = _write_part(_live(spark, name, found), name, merged)
        runs = ",".join(p.run_id for p in found)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{merged}' = '{runs}')")
        _point(spark, name, merged, folder)
        _drop_merged(spark, name)
        merges += 1


def _drop_merged(spark: SparkSession, name: str) -> None:
    """Drops partitions that were merged, and what names them. Their folders stay for readers
    that are still at them."""
    catalog, table = _catalog(spark, name)
    found = catalog.listPartitions(table, spark._jvm.scala.Option.empty())
    there = {found.apply(i).spec().apply("run_id") for i in range(found.size())}
    for key, runs in _properties(spark, name).items():
        if not key.startswith(MERGED):
            continue
        if key in there:
            for run in set(runs.split(",")) & there:
                spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (run_id = '{run}')")
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ('{key}')")
    spark.catalog.refreshTable(name)


def landed(spark: SparkSession, name: str) -> DataFrame:
    """The rows, each id once; also while runs are being merged."""
    return _live(spark, name, parts_of(spark, name))


def landed_count(spark: SparkSession, name: str) -> DataFrame:
    return landed(spark, name).agg(F.count(F.lit(1)).alias("rows"))
