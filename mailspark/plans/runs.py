"""Whole runs, put together from the operators."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from mailspark.functions import text
from mailspark.operators import fetch, learn, mime, quality, rawmail, triage
from mailspark.operators.features import HashingEncoder, embed
from mailspark.session import cut_lineage, scratch_dir
from mailspark.sources import landing, snapshots


@dataclass
class TriageResult:
    scored: DataFrame
    plan: DataFrame
    state: DataFrame
    purged: DataFrame
    purge_plan: DataFrame
    counts: DataFrame


def triage_run(
    fetched: DataFrame,
    state: DataFrame,
    model,
    landing_table: str,
    run_start: dt.datetime,
    run_type: str = triage.SCHEDULED,
    days: int = fetch.DAYS_BACK,
    encoder=HashingEncoder(),
    run_id: str | None = None,
    scores_path: str | None = None,
) -> TriageResult:
    """List, fetch, decode, land, score, trash and purge.

    `fetched` is (id, payload, received_at), and mailbox if there are several; `state` the
    mailbox state. A manual run neither lands nor purges. What this run moves to the trash is
    not purged by it. Scores are computed once: they are written, and plan and state are made
    from what was written. An empty input gives empty frames. `run_id` is the run's own, by
    default its start to the microsecond; a retry gives the same one.
    """
    spark = fetched.sparkSession
    by = [c for c in ("mailbox",) if c in fetched.columns]
    wanted = fetch.in_days(fetched, run_start.date(), days)
    decoded = mime.decode_payload(
        wanted.select(
            "id", *by, F.coalesce("payload", F.lit(fetch.EMPTY_PAYLOAD)).alias("payload")
        )
    ).persist(StorageLevel.MEMORY_AND_DISK)
    scores_path = scores_path or scratch_dir(spark, "scores")
    try:
        if run_type != triage.MANUAL:
            landing.land(decoded, landing_table, run_id or f"{run_start:%Y%m%dT%H%M%S.%f}")
        scored = learn.score_messages(decoded, model, encoder, keep=by)
        scored.write.mode("overwrite").parquet(scores_path)
    finally:
        decoded.unpersist()
    scored = spark.read.parquet(scores_path)
    plan = triage.trash_plan(scored)
    at = F.lit(run_start).cast("timestamp")
    old_trash = triage.purge_candidates(state, run_start, run_type)
    moved = triage.apply_labels(state, triage.unimportant(scored), at)
    kept, purged = triage.purge(moved, old_trash, at)
    counts = quality.run_counts(
        scored, important=F.col("important") == 1, to_trash=F.col("important") == 0
    )
    return TriageResult(scored, plan, kept, purged, triage.purge_plan(old_trash), counts)


def training_snapshot(
    messages: DataFrame,
    base: str,
    run_ts: dt.datetime,
    label_col: str = "label",
    values=(1, 0),
    per_label: int | None = None,
) -> None:
    """The messages of each label, as one snapshot with a folder per label. `per_label` bounds
    the fitting sample; by default all are taken."""
    picked = fetch.list_by_label(messages, label_col, values, per_label)
    snapshots.write_snapshot(picked, base, run_ts, label_col)


def raw_mail_snapshot(raw: DataFrame, since: dt.date, path: str) -> None:
    """Raw mail since a date, with its envelope."""
    recent = raw.where(F.col("received_at") >= F.lit(since).cast("timestamp"))
    snapshots.write_frame(recent, path)


def read_raw_mail(spark: SparkSession, path: str) -> DataFrame:
    return rawmail.parse_raw_mail(snapshots.read_frame(spark, path))


@dataclass
class TrainingResult:
    model: object
    confusion: DataFrame
    recall: DataFrame
    rounds: DataFrame


def train(
    important: DataFrame,
    unimportant: DataFrame,
    unlabelled: DataFrame,
    params: learn.BoostParams = learn.BoostParams(),
    n_trials: int = learn.TRIALS,
    max_rounds: int = learn.SELF_TRAINING_ROUNDS,
    encoder=HashingEncoder(),
    model_path: str | None = None,
    ledger: str | None = None,
) -> TrainingResult:
    """Label, fill, embed, split, tune (unless n_trials is 0), self-train, evaluate, and save if
    a path is given. Frames are (id, subject, body)."""
    labelled = important.withColumn("label", F.lit(1)).unionByName(
        unimportant.withColumn("label", F.lit(0))
    )
    filled = labelled.withColumn("body", text.body_or_subject(F.col("body"), F.col("subject")))
    features = cut_lineage(embed(filled, encoder=encoder).select("id", "features", "label"))
    learn_on, held_out = learn.split(features)
    if n_trials:
        params, _ = learn.tune(learn_on, n_trials, base=params)
    others = embed(unlabelled, encoder=encoder).select("id", "features")
    result = learn.self_train(learn_on, others, params, max_rounds, ledger=ledger)
    if model_path:
        learn.save_model(result.model, model_path, encoder)
    confusion, recall = learn.evaluate(result.model, held_out)
    return TrainingResult(result.model, confusion, recall, result.rounds)


def train_from_snapshots(
    spark: SparkSession,
    labelled_base: str,
    unlabelled_base: str,
    model_path: str,
    run_ts: str | None = None,
    **options,
) -> TrainingResult:
    """Reads the snapshots of payloads (labels as folders, see training_snapshot), decodes them,
    trains, and saves the classifier."""
    known = snapshots.read_snapshot(
        spark, labelled_base, "id string, payload string, run_ts string, label int", run_ts
    )
    others = snapshots.read_snapshot(
        spark, unlabelled_base, "id string, payload string, run_ts string", run_ts
    )
    decoded = mime.decode_payload(known.select("id", "payload", "label"))
    important, unimportant = (
        decoded.where(F.col("label") == v).select("id", "subject", "body") for v in (1, 0)
    )
    rest = mime.decode_payload(others.select("id", "payload")).select("id", "subject", "body")
    return train(important, unimportant, rest, model_path=model_path, **options)
