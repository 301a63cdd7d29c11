"""Writes, read back; and the mailbox changes."""

import datetime as dt

from pyspark.sql import functions as F

from mailspark import staging
from mailspark.operators import fetch, mime, rawmail, triage
from mailspark.queries.base import cleaned, query, received_us, using, with_defaults
from mailspark.session import scratch_dir
from mailspark.sources import landing, snapshots, state

RUN = dt.datetime(2024, 2, 1)
MID = dt.datetime(2024, 1, 20)


def _landing(spark):
    path = scratch_dir(spark, "landing")
    name = "landed_" + path[-12:]
    landing.create_landing(spark, name, path)
    return name, path


def _batch(spark, sf):
    return staging.messages(spark, sf).withColumnRenamed("body", "payload")


@query("snk01_run_snapshot", using(
    "messages labelset",
    """SELECT id, label::bigint AS label, '01-02-2024-00-00-00' AS run_ts, subject
       FROM messages JOIN labelset USING (id)"""))
def run_snapshot(spark, sf):
    path = scratch_dir(spark, "snapshot")
    rows = staging.labelled(spark, sf).select("id", "label", "subject")
    for _ in range(2):  # a run that is run again
        snapshots.write_snapshot(rows, path, RUN, "label")
    return snapshots.read_snapshot(
        spark, path, "id string, subject string, run_ts string, label bigint"
    ).select("id", "label", "run_ts", "subject")


@query("snk02_create_landing", using("messages", "SELECT id, subject FROM messages"))
def create_landing(spark, sf):
    name, path = _landing(spark)
    landing.land(_batch(spark, sf), name, "first")
    landing.create_landing(spark, name, path)  # there already: nothing is lost
    return landing.landed(spark, name).select("id", "subject")


@query("snk03_insert_if_absent", using(
    "messages",
    """SELECT id, epoch_us(received_at) AS received_us, subject,
              CASE WHEN lang = 'en' THEN 'first' ELSE 'second' END AS run_id FROM messages"""))
def insert_if_absent(spark, sf):
    name, _ = _landing(spark)
    batch = _batch(spark, sf)
    landing.land(batch.where(F.col("lang") == "en"), name, "first")
    twice = batch.unionByName(batch)
    landing.land(twice, name, "second")
    landing.land(twice, name, "second")  # a run that is run again
    return landing.landed(spark, name).select("id", received_us(), "subject", "run_id")


_SUBJECT, _BODY = with_defaults("subject", cleaned("body"))


@query("snk04_decoded_frame", using(
    "messages",
    f"""SELECT id, epoch_us(received_at) AS received_us, {_SUBJECT} AS subject, {_BODY} AS body
        FROM messages"""))
def decoded_frame(spark, sf):
    path = scratch_dir(spark, "decoded")
    snapshots.write_frame(mime.decode_payload(staging.payloads(spark, sf)), path)
    return snapshots.read_frame(spark, path).select("id", received_us(), "subject", "body")


@query("snk05_raw_frame", using(
    "messages",
    """SELECT cast(id AS bigint) AS uid, CASE WHEN source <> 'src0'
              THEN source || '@mail.example' END AS sender_address FROM messages"""))
def raw_frame(spark, sf):
    path = scratch_dir(spark, "raw")
    snapshots.write_frame(staging.raw_mail(spark, sf), path)
    parsed = rawmail.parse_raw_mail(snapshots.read_frame(spark, path))
    return parsed.select("uid", "sender_address")


@query("snk06_write_embeddings",
       """SELECT vec_id, len(embedding)::bigint AS dim,
                 round(list_sum(list_transform(embedding, lambda x: x::double)), 4) AS total
          FROM embeddings""")
def write_embeddings(spark, sf):
    path = scratch_dir(spark, "features")
    rows = staging.table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<float>").alias("features")
    )
    snapshots.write_frame(rows, path)
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return snapshots.read_frame(spark, path).select(
        "vec_id", F.size("features").cast("bigint").alias("dim"), F.round(total, 4).alias("total")
    )


@query("snk08_stage_handoff", using(
    "messages",
    """SELECT id, CASE WHEN lang = 'en' THEN 1 ELSE 2 END::bigint AS turn FROM messages"""))
def stage_handoff(spark, sf):
    box = snapshots.Handoff(scratch_dir(spark, "handoff"), "run-1")
    ids = staging.messages(spark, sf).select("id", "lang")
    box.push("ids", ids.where(F.col("lang") != "en"), 7)
    box.push("ids", ids.where(F.col("lang") == "en"), 3)
    first, second = box.pop(spark, "ids"), box.pop(spark, "ids", after=3)
    turn = F.lit(1).cast("bigint")
    return first.select("id", turn.alias("turn")).unionByName(
        second.select("id", (turn + 1).alias("turn"))
    )


def _planned(spark, sf):
    """Mailbox events with a predicted class: unimportant when the value is low."""
    return staging.mailbox_state(spark, sf).select("id", (F.col("value") >= 35).cast("int").alias("important"))


@query("snk09_move_to_trash", using(
    "state",
    """SELECT id,
              CASE WHEN value < 35 AND event_type <> 'signup' THEN 'INBOX,TRASH'
                   ELSE array_to_string(labels, ',') END AS labels,
              epoch_us(CASE WHEN value < 35 THEN coalesce(trashed_at, timestamp '2024-02-01')
                            ELSE trashed_at END) AS trashed_us
       FROM state"""))
def move_to_trash(spark, sf):
    plan = triage.trash_plan(_planned(spark, sf))
    moved = triage.move_to_trash(
        staging.mailbox_state(spark, sf), plan, F.lit(RUN).cast("timestamp")
    )
    return moved.select(
        "id", F.array_join("labels", ",").alias("labels"),
        F.unix_micros("trashed_at").alias("trashed_us"),
    )


@query("snk10_purge", using(
    "state",
    """SELECT id, CASE WHEN trashed_at < timestamp '2024-01-20' THEN 'purged' ELSE 'kept' END
              AS outcome FROM state"""))
def purge(spark, sf):
    marked = triage.marked_due(staging.mailbox_state(spark, sf), MID)
    return marked.select("id", F.when(F.col("due"), "purged").otherwise("kept").alias("outcome"))


@query("snk10_purge_by_ids", using(
    "state",
    """SELECT id, CASE WHEN trashed_at < timestamp '2024-01-20' THEN 'purged' ELSE 'kept' END
              AS outcome FROM state"""))
def purge_by_ids(spark, sf):
    """The same by a list of ids, as a run has it."""
    now = staging.mailbox_state(spark, sf)
    kept, audit = triage.purge(
        now, triage.purge_candidates(now, MID), F.lit(MID).cast("timestamp")
    )
    return kept.select("id", F.lit("kept").alias("outcome")).unionByName(
        audit.select("id", F.lit("purged").alias("outcome"))
    )


@query("snk09_snk10_written_state", using(
    "state",
    """SELECT id, epoch_us(CASE WHEN value < 35 THEN coalesce(trashed_at, timestamp '2024-02-01')
                            ELSE trashed_at END) AS trashed_us,
              list_contains(labels, 'TRASH') OR value < 35 AS in_trash
       FROM state
       WHERE NOT (coalesce(trashed_at < timestamp '2024-01-20', false) AND value >= 35)"""))
def written_state(spark, sf):
    """Changes made to the written table, run twice, and read back."""
    path, audit = scratch_dir(spark, "state"), scratch_dir(spark, "audit")
    before = staging.mailbox_state(spark, sf)
    state.write_state(before, path)
    old = triage.purge_candidates(before, MID)
    at = F.lit(RUN).cast("timestamp")
    for _ in range(2):
        state.commit_changes(
            spark, path, triage.unimportant(_planned(spark, sf)), old, at, audit, "run-1"
        )
    return state.read_state(spark, path).select(
        "id", F.unix_micros("trashed_at").alias("trashed_us"),
        F.array_contains("labels", "TRASH").alias("in_trash"),
    )


@query("snk11_trash_with_retries", using(
    "outcomes",
    """SELECT id,
              CASE WHEN status = 'ok' THEN 1 WHEN value < 50 THEN 2 ELSE 3 END::bigint AS attempts,
              CASE WHEN status = 'ok' OR value < 100 THEN 'ok' ELSE 'failed' END AS status
       FROM outcomes"""))
def trash_with_retries(spark, sf):
    batch = staging.fetch_outcomes(spark, sf)

    def single(limit):
        worked = F.when(F.col("value") < limit, "ok").otherwise("failed")
        return batch.where(F.col("status") == "failed").select("id", worked.alias("status"))

    done = triage.attempt_outcomes(batch.select("id"), batch, single(50), single(100))
    return done.withColumn("attempts", F.col("attempts").cast("bigint"))


@query("flt05_run_type_gate", using(
    "state",
    """SELECT run_type, count(CASE WHEN run_type <> 'manual' AND trashed_at < timestamp
              '2024-01-20' THEN 1 END) AS purged
       FROM state CROSS JOIN (VALUES ('manual'), ('scheduled')) t(run_type) GROUP BY 1"""))
def run_type_gate(spark, sf):
    now = staging.mailbox_state(spark, sf)

    def purged(kind):
        found = triage.purge_candidates(now, MID, kind)
        return found.agg(F.count("id").alias("purged")).select(
            F.lit(kind).alias("run_type"), "purged"
        )

    return purged(triage.MANUAL).unionByName(purged(triage.SCHEDULED))


@query("agg07_chunk_arrays", using(
    "messages",
    """SELECT chunk_id, string_agg(id, ',' ORDER BY id) AS ids, count(*) AS n FROM (
         SELECT id, ((row_number() OVER (ORDER BY substr(md5(id), 1, 3), id) - 1) // 100)::bigint
                    AS chunk_id FROM messages) GROUP BY 1"""))
def chunk_arrays(spark, sf):
    plan = triage.purge_plan(staging.messages(spark, sf).select("id"))
    return plan.select(
        "chunk_id", F.array_join("ids", ",").alias("ids"), F.size("ids").cast("bigint").alias("n")
    )


@query("jon03_failed_ids", using(
    "outcomes", "SELECT id FROM outcomes WHERE status <> 'ok'"))
def failed_ids(spark, sf):
    tried = staging.fetch_outcomes(spark, sf)
    return fetch.missing(tried.select("id"), tried.where(F.col("status") == "ok"))
