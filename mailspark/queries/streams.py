"""Streaming forms, run to the end of what is there and read back."""

import datetime as dt

from pyspark.sql import functions as F

from mailspark import staging
from mailspark.operators import triage
from mailspark.queries.base import query, using, with_defaults
from mailspark.queries.learning import whole_model
from mailspark.session import scratch_dir
from mailspark.sources import landing
from mailspark.streaming import retention as timers, streams


def _event_stream(spark, sf):
    schema = staging.table(spark, sf, "events").schema
    return streams.stream_files(spark, sf, schema, "events.parquet").select(
        staging.mail_id(F.col("event_id")).alias("id"),
        F.col("ts").cast("timestamp").alias("received_at"),
    )


@query("str01_incremental_run", using(
    "messages",
    "SELECT id, CASE WHEN lang = 'en' THEN 1 ELSE 2 END::bigint AS run FROM messages"))
def incremental_run(spark, sf):
    inbox, out, mark = (scratch_dir(spark, k) for k in ("inbox", "runs", "mark"))
    messages = staging.messages(spark, sf).select("id", "lang")
    english = F.col("lang") == "en"
    for run, part in enumerate((messages.where(english), messages.where(~english)), start=1):
        part.write.mode("append").parquet(inbox)

        def process(batch, batch_id, run=run):
            batch.withColumn("run", F.lit(run).cast("bigint")).write.mode("overwrite").parquet(
                f"{out}/batch_id={batch_id}"
            )

        streams.catch_up(streams.stream_files(spark, inbox, messages.schema), process, mark)
    return spark.read.parquet(out).select("id", "run")


@query("str02_id_topic", using("state", "SELECT id FROM state"))
def id_topic(spark, sf):
    topic, out, mark = (scratch_dir(spark, k) for k in ("topic", "ids", "mark"))
    state = staging.mailbox_state(spark, sf)
    ids = state.select(F.concat(F.lit('"'), F.col("id"), F.lit('"')).alias("value"))
    stops = state.select("mailbox").distinct().select(
        F.lit('{"stop_consumer":true}').alias("value")
    )
    ids.unionByName(stops).write.parquet(topic)
    values = streams.stream_files(spark, topic, "value string")
    streams.append_to(streams.ids_of_topic(values), out, mark)
    return spark.read.parquet(out)


@query("str03_arrivals_per_day", using(
    "state",
    """SELECT strftime(received_at, '%Y/%m/%d') AS day, count(*) AS arrived FROM state
       GROUP BY 1"""))
def arrivals_per_day(spark, sf):
    out, mark = (scratch_dir(spark, k) for k in ("days", "mark"))
    counted = streams.arrivals_per_day(_event_stream(spark, sf))
    (
        counted.writeStream.outputMode("complete")
        .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out))
        .option("checkpointLocation", mark)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(out)


@query("str03_final_days", using(
    "state",
    """SELECT strftime(received_at, '%Y/%m/%d') AS day, count(*) AS arrived FROM state
       WHERE cast(received_at AS date) + interval 1 day
             <= (SELECT max(received_at) - interval 1 day FROM state) GROUP BY 1"""))
def final_days(spark, sf):
    """Append mode: only the days the watermark has passed."""
    out, mark = (scratch_dir(spark, k) for k in ("days", "mark"))
    streams.append_to(streams.arrivals_per_day(_event_stream(spark, sf)), out, mark)
    return spark.read.parquet(out)


@query("str04_unique_ids", using(
    "state", "SELECT id, epoch_us(received_at) AS received_us FROM state"))
def unique_ids(spark, sf):
    inbox, out, mark = (scratch_dir(spark, k) for k in ("inbox", "unique", "mark"))
    arrived = staging.mailbox_state(spark, sf).select("id", "received_at")
    arrived.unionByName(arrived).write.parquet(inbox)
    twice = streams.stream_files(spark, inbox, arrived.schema)
    streams.append_to(streams.unique_on_arrival(twice), out, mark)
    return spark.read.parquet(out).select("id", F.unix_micros("received_at").alias("received_us"))


@query("str05_land_and_score", using(
    "messages",
    f"""SELECT id, epoch_us(received_at) AS received_us, {with_defaults('subject', "'x'")[0]}
               AS subject FROM messages"""))
def land_and_score(spark, sf):
    inbox, plans, mark, table = (scratch_dir(spark, k) for k in ("inbox", "plan", "mark", "landing"))
    name = "landed_" + table[-12:]
    landing.create_landing(spark, name, table)
    sent = staging.payloads(spark, sf).select("id", "payload")
    sent.write.parquet(inbox)
    process = streams.land_and_score(name, whole_model(spark, sf), plans)
    streams.catch_up(streams.stream_files(spark, inbox, sent.schema), process, mark)
    return landing.landed(spark, name).select(
        "id", F.unix_micros("received_at").alias("received_us"), "subject"
    )


@query("str05_two_streams", using("messages", "SELECT id, 1::bigint AS times FROM messages"))
def two_streams(spark, sf):
    """Two streams with checkpoints of their own land in one table; then nothing comes."""
    plans, table = scratch_dir(spark, "plan"), scratch_dir(spark, "landing")
    name = "landed_" + table[-12:]
    landing.create_landing(spark, name, table)
    sent = staging.payloads(spark, sf).select("id", "payload")
    process = streams.land_and_score(name, whole_model(spark, sf), plans)
    odd = F.substring("id", -1, 1).isin("1", "3", "5", "7", "9")
    for part in (sent.where(odd), sent.where(~odd)):
        inbox, mark = (scratch_dir(spark, k) for k in ("inbox", "mark"))
        part.write.parquet(inbox)
        for _ in range(2):
            streams.catch_up(streams.stream_files(spark, inbox, sent.schema), process, mark)
    return landing.landed(spark, name).groupBy("id").agg(F.count(F.lit(1)).alias("times"))


@query("str06_retention", using(
    "state",
    """SELECT id FROM state WHERE list_contains(labels, 'TRASH')
       AND trashed_at < timestamp '2024-01-20'"""))
def retention(spark, sf):
    old = triage.purge_candidates(staging.mailbox_state(spark, sf), dt.datetime(2024, 1, 20))
    return old.select("id")


HOLD = dt.timedelta(hours=72)


@query("str06_retention_timer", using(
    "state",
    """SELECT id, epoch_us(trashed_at) AS trashed_us FROM state
       WHERE trashed_at IS NOT NULL AND (value >= 50 OR value > 30 AND value < 40)
         AND trashed_at + interval 72 hour
             <= (SELECT max(moved) - interval 1 day
                 FROM (SELECT received_at AS moved FROM state WHERE trashed_at IS NOT NULL UNION ALL
                       SELECT received_at + interval 1 hour * CASE WHEN value <= 30 THEN 10
                              WHEN value < 40 THEN 80 ELSE 72 END
                       FROM state WHERE trashed_at IS NOT NULL AND value < 50))"""))
def retention_timer(spark, sf):
    """Messages moved to the trash, some taken out of it 10, 72 or 80 hours later, in the order of
    no clock. Requests come for stays of more than 72 hours."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    inbox, out, mark = (scratch_dir(spark, k) for k in ("moves", "requests", "mark"))
    moved = staging.mailbox_state(spark, sf).where("trashed_at IS NOT NULL")
    hours = F.when(F.col("value") <= 30, 10).when(F.col("value") < 40, 80).otherwise(72)
    back = F.col("trashed_at") + F.make_dt_interval(hours=hours)
    events = moved.select("id", F.col("trashed_at").alias("at"), F.lit(True).alias("trashed"))
    events = events.unionByName(
        moved.where("value < 50").select("id", back.alias("at"), F.lit(False).alias("trashed"))
    )
    events.write.parquet(inbox)
    stream = streams.stream_files(spark, inbox, events.schema)
    streams.append_to(timers.purge_requests(stream, HOLD), out, mark)
    return spark.read.schema(timers.REQUEST).parquet(out).select(
        "id", F.unix_micros("trashed_at").alias("trashed_us")
    )
