"""Scans."""

import datetime as dt

from pyspark.sql import functions as F

from mailspark import staging
from mailspark.functions import dates
from mailspark.operators import chunks, fetch
from mailspark.queries.base import query, received_us, using
from mailspark.session import scratch_dir
from mailspark.sources import by_day, landing, mailbox, snapshots

LAST_DAY = "last_day AS (SELECT cast(max(received_at) AS date) + 1 AS d FROM messages)"


@query("src01_ids_by_day_range", using(
    "messages",
    """SELECT id, epoch_us(received_at) AS received_us FROM messages, last_day
       WHERE received_at >= d - interval 7 day AND received_at < d""",
    LAST_DAY))
def ids_by_day_range(spark, sf):
    path = scratch_dir(spark, "by-day")
    by_day.write_by_day(staging.messages(spark, sf).select("id", "received_at"), path)
    after_last = by_day.newest_day(spark, path) + dt.timedelta(days=1)
    wanted = by_day.in_days(by_day.read_by_day(spark, path), after_last, fetch.DAYS_BACK)
    return wanted.select("id", received_us())


@query("src01_ids_of_plain_table", using(
    "messages",
    """SELECT id, epoch_us(received_at) AS received_us FROM messages, last_day
       WHERE received_at >= d - interval 7 day AND received_at < d""",
    LAST_DAY))
def ids_of_plain_table(spark, sf):
    """The same of a table without days: the newest day costs a scan of its own."""
    messages = staging.messages(spark, sf)
    return fetch.in_days(messages, fetch.day_after_last(messages)).select("id", received_us())


@query("src02_day_page_cap", using(
    "state",
    """SELECT id, strftime(received_at, '%Y/%m/%d') AS day FROM (
         SELECT *, row_number() OVER (PARTITION BY cast(received_at AS date)
                                      ORDER BY received_at DESC, id) AS r FROM state)
       WHERE r <= 100"""))
def day_page_cap(spark, sf):
    capped = fetch.page_cap_per_day(staging.mailbox_state(spark, sf), fetch.PAGE_SIZE)
    return capped.select("id", F.date_format("day", dates.DAY_FORMAT).alias("day"))


@query("src03_fetch_by_id", using(
    "messages labelset",
    """SELECT m.id, CASE WHEN source = 'src0' THEN '{}' ELSE body END AS payload
       FROM messages m WHERE m.id IN (SELECT id FROM labelset)"""))
def fetch_by_id(spark, sf):
    stored = staging.messages(spark, sf).select(
        "id", F.when(F.col("source") != "src0", F.col("body")).alias("payload")
    )
    return fetch.fetch_payloads(stored, staging.labels(spark, sf))


@query("src04_batched_fetch_retry", using(
    "outcomes",
    """SELECT id, CASE WHEN status = 'ok' OR value < 100 THEN payload END AS payload,
              CASE WHEN status = 'ok' THEN 1 ELSE 2 END::bigint AS attempt,
              CASE WHEN status = 'ok' OR value < 100 THEN 'ok' ELSE 'failed' END AS status
       FROM outcomes"""))
def batched_fetch_retry(spark, sf):
    first = staging.fetch_outcomes(spark, sf)
    again = F.when(F.col("value") < 100, "ok").otherwise("failed")
    second = first.where(F.col("status") == "failed").withColumn("status", again)
    done = fetch.fetch_with_retry(first, first, second)
    return done.withColumn("attempt", F.col("attempt").cast("bigint"))


@query("src05_scan_by_label", using(
    "messages labelset",
    """SELECT id, label::bigint AS label FROM (
         SELECT id, label, row_number() OVER (PARTITION BY label ORDER BY id) AS r
         FROM messages JOIN labelset USING (id)) WHERE r <= 30"""))
def scan_by_label(spark, sf):
    picked = fetch.list_by_label(staging.labelled(spark, sf), "label", (1, 0), 30)
    return picked.select("id", F.col("label").cast("bigint").alias("label"))


@query("src06_scan_trash", using(
    "state", "SELECT id FROM state WHERE list_contains(labels, 'TRASH') ORDER BY id LIMIT 500"))
def scan_trash(spark, sf):
    return fetch.list_trash(staging.mailbox_state(spark, sf), fetch.RESULT_CAP)


@query("src07_scan_since", using(
    "state",
    """SELECT id, mailbox FROM state
       WHERE list_contains(labels, 'INBOX') AND received_at >= timestamp '2024-01-15'"""))
def scan_since(spark, sf):
    since = fetch.list_since(staging.mailbox_state(spark, sf), dt.date(2024, 1, 15))
    return since.select("id", "mailbox")


@query("src08_raw_mail", using(
    "messages",
    """SELECT cast(id AS bigint) AS uid, 'From: Reader <' || source || '@mail.example>' AS head,
              nullif(source, 'src0') AS mailbox, 'mail.example' AS host FROM messages"""))
def raw_mail(spark, sf):
    path = scratch_dir(spark, "raw")
    snapshots.write_frame(staging.raw_mail(spark, sf), path)
    return snapshots.read_frame(spark, path).select(
        "uid",
        F.substring_index(F.col("rfc822").cast("string"), "\r\n", 1).alias("head"),
        F.col("envelope.mailbox").alias("mailbox"),
        F.col("envelope.host").alias("host"),
    )


@query("src09_read_snapshot", using("messages", "SELECT body AS payload FROM messages"))
def read_snapshot(spark, sf):
    path = scratch_dir(spark, "snapshot")
    rows = staging.messages(spark, sf).select("id", F.col("body").alias("payload"))
    snapshots.write_snapshot(rows, path, dt.datetime(2024, 1, 1))
    return snapshots.read_snapshot(spark, path, "id string, payload string").select("payload")


@query("src10_parquet_handoff", using(
    "messages", "SELECT id, subject, body FROM messages"))
def parquet_handoff(spark, sf):
    path = scratch_dir(spark, "frame")
    snapshots.write_frame(staging.messages(spark, sf), path)
    return snapshots.read_frame(spark, path).select("id", "subject", "body")


@query("src11_landed_count", "SELECT count(*) AS rows FROM documents")
def landed_count(spark, sf):
    path = scratch_dir(spark, "landing")
    name = "landed_" + path[-12:]
    landing.create_landing(spark, name, path)
    batch = staging.messages(spark, sf).withColumnRenamed("body", "payload")
    landing.land(batch, name, "first")
    return landing.landed_count(spark, name)


@query("src12_mailbox_source", using(
    "messages", "SELECT id, epoch_us(received_at) AS received_us, subject FROM messages"))
def mailbox_source(spark, sf):
    path = scratch_dir(spark, "mailbox")
    messages = staging.messages(spark, sf)
    mailbox.write_mailbox(messages, path)
    # the run's own dates, as a scheduler would hand them over
    first, last = messages.agg(
        F.to_date(F.min("received_at")), F.date_add(F.to_date(F.max("received_at")), 1)
    ).first()
    mailbox.register(spark)
    source = spark.read.format("mailbox").options(
        path=path, from_date=last.isoformat(), days=str((last - first).days)
    )
    return source.load().select("id", received_us(), "subject")


@query("win01_chunk_ids", using(
    "messages",
    """SELECT id, ((row_number() OVER (ORDER BY substr(md5(id), 1, 3), id) - 1) // 50)::bigint
                  AS chunk_id FROM messages"""))
def chunk_ids(spark, sf):
    return chunks.chunk_ids(staging.messages(spark, sf).select("id"), fetch.FETCH_CHUNK)


@query("win01_chunk_per_mailbox", using(
    "state",
    """SELECT mailbox, id, ((row_number() OVER (PARTITION BY mailbox
              ORDER BY substr(md5(id), 1, 3), id) - 1) // 50)::bigint AS chunk_id FROM state"""))
def chunk_per_mailbox(spark, sf):
    ids = staging.mailbox_state(spark, sf).select("mailbox", "id")
    return chunks.chunk_ids(ids, fetch.FETCH_CHUNK, group_cols=("mailbox",))


@query("win02_first_per_group", using(
    "state",
    """SELECT mailbox, id FROM (
         SELECT mailbox, id, row_number() OVER (PARTITION BY mailbox ORDER BY id) AS r
         FROM state) WHERE r <= 20"""))
def first_per_group(spark, sf):
    ids = staging.mailbox_state(spark, sf).select("mailbox", "id")
    return chunks.first_n_per_group(ids, 20, ("mailbox",), (F.col("id"),))


@query("lim01_first_500", using("messages", "SELECT id FROM messages ORDER BY id LIMIT 500"))
def first_500(spark, sf):
    return chunks.first_n(staging.messages(spark, sf).select("id"), fetch.RESULT_CAP)


@query("lim02_log_sample", using("messages", "SELECT id FROM messages ORDER BY id LIMIT 5"))
def log_sample(spark, sf):
    return chunks.first_n(staging.messages(spark, sf).select("id"), 5)


@query("fn16_day_ranges", using(
    "messages",
    """SELECT strftime(d - interval (i + 1) day, '%Y/%m/%d') AS after_date,
              strftime(d - interval (i) day, '%Y/%m/%d') AS before_date,
              count(m.id) AS arrived
       FROM last_day CROSS JOIN range(10) r(i)
       LEFT JOIN messages m ON m.received_at >= d - interval (i + 1) day
                           AND m.received_at < d - interval (i) day
       GROUP BY 1, 2""",
    LAST_DAY))
def day_ranges(spark, sf):
    path, asked = scratch_dir(spark, "by-day"), scratch_dir(spark, "ranges")
    by_day.write_by_day(staging.messages(spark, sf).select("id", "received_at"), path)
    after_last = F.lit(by_day.newest_day(spark, path) + dt.timedelta(days=1))
    dates.day_ranges(spark.range(1), after_last, fetch.DAYS_BACK_BATCHED).write.parquet(asked)
    ranges = spark.read.parquet(asked)
    found = by_day.in_ranges(by_day.read_by_day(spark, path), ranges).groupBy("after_date").agg(
        F.count("id").alias("n")
    )
    return ranges.join(found, "after_date", "left").select(
        "after_date", "before_date", F.coalesce("n", F.lit(0)).alias("arrived")
    )
