"""Structured Streaming forms of the triage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from mailspark.operators import learn, mime, triage
from mailspark.operators.chunks import one_per_id
from mailspark.operators.features import HashingEncoder
from mailspark.session import rows_per_batch
from mailspark.sources import landing

# rows a Python worker of a batch gets at a time: a stream's executors hold the model beside them
BATCH_ROWS = 1_000


def stream_files(
    spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def catch_up(
    stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    """One scheduled run: everything that came since the last run, and nothing twice."""
    (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def append_to(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over what is there into a parquet folder."""
    (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def read_id_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Ids sent to a Kafka topic, from the earliest one; offsets live in the checkpoint."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def ids_of_topic(values: DataFrame) -> DataFrame:
    """Message values to ids. A value is a JSON string, or the stop message
    {"stop_consumer": true}, which carries no id."""
    stop = F.get_json_object("value", "$.stop_consumer")
    return values.where(stop.isNull()).select(
        F.from_json(F.concat(F.lit('{"id":'), F.col("value"), F.lit("}")), "id string")["id"].alias(
            "id"
        )
    )


def arrivals_per_day(messages: DataFrame, at: str = "received_at", late: str = "1 day"):
    """(day, arrived). On a stream a day is final once the watermark has passed it."""
    watched = messages.withWatermark(at, late) if messages.isStreaming else messages
    return (
        watched.groupBy(F.window(at, "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("arrived"))
        .select(F.date_format("w.start", "yyyy/MM/dd").alias("day"), "arrived")
    )


def unique_on_arrival(messages: DataFrame, at: str = "received_at", late: str = "1 day"):
    """Each id once. What comes again after the watermark is caught by the landing table,
    which also shrinks the copies of an id before it shuffles them; so pass only narrow
    columns through here."""
    if messages.isStreaming:
        return messages.withWatermark(at, late).dropDuplicatesWithinWatermark(["id"])
    return one_per_id(messages, order_cols=(at,))


def land_and_score(
    table: str, model, plans_path: str, encoder=HashingEncoder(), compact_every: int = 2 * landing.FAN
):
    """A foreachBatch function over (id, payload): decode, land, score, plan the trash. Every
    `compact_every` batches the landing table's small runs are merged.

    Outputs are written per stream and batch and replaced as a whole, so a batch that is
    run again leaves one copy. A stream is known by the query id that its checkpoint
    keeps: another stream, or the same one with a new checkpoint, starts at batch 0 again
    and must not replace what the first has landed.

    The decoded messages are kept on disk, as they may be more than an executor's memory has room
    for beside the Python workers, and workers get BATCH_ROWS of them at a time.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "by-hand"
        with rows_per_batch(spark, BATCH_ROWS):
            decoded = mime.decode_payload(batch).persist(StorageLevel.DISK_ONLY)
            try:
                landing.land(decoded, table, f"{stream}-{batch_id}")
                if batch_id % compact_every == compact_every - 1:
                    landing.compact(spark, table)
                own = f"stream={stream}/batch_id={batch_id}"
                scores = f"{plans_path}-scores/{own}"
                scored = learn.score_messages(decoded, model, encoder)
                scored.write.mode("overwrite").parquet(scores)
                plan = triage.trash_plan(spark.read.parquet(scores))
                plan.write.mode("overwrite").parquet(f"{plans_path}/{own}")
            finally:
                decoded.unpersist()

    return process
