"""From predictions to mailbox changes: trash plans, retries, purge."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from mailspark.functions import scoring
from mailspark.operators.chunks import chunk_arrays
from mailspark.operators.fetch import first_success

# Ids per request, and tries after the batch attempt.
TRASH_CHUNK = 50
PURGE_CHUNK = 100
SINGLE_TRIES = 2
MANUAL = "manual"
SCHEDULED = "scheduled"


def pair_predictions(ids: DataFrame, predictions: DataFrame) -> DataFrame:
    """Each id with its own prediction, joined by id and never by position."""
    return ids.join(predictions, "id")


def unimportant(predicted: DataFrame, col: str = "important") -> DataFrame:
    return predicted.where(F.col(col) == 0)


def confident(scored: DataFrame, p: str = "p", cut: float = scoring.CONFIDENCE) -> DataFrame:
    return scored.where(scoring.is_confident(F.col(p), cut))


def not_confident(scored: DataFrame, p: str = "p", cut: float = scoring.CONFIDENCE) -> DataFrame:
    return scored.where(~scoring.is_confident(F.col(p), cut))


def _by_mailbox(df: DataFrame) -> tuple[str, ...]:
    return ("mailbox",) if "mailbox" in df.columns else ()


def trash_plan(predicted: DataFrame, size: int = TRASH_CHUNK) -> DataFrame:
    """(mailbox, chunk_id, ids) of the messages to move to the trash. A request belongs to one
    mailbox; without that column all rows are one mailbox's. Numbering reads its input twice, so
    pass scores that are written, not computed."""
    return chunk_arrays(unimportant(predicted), size, group_cols=_by_mailbox(predicted))


def apply_labels(
    state: DataFrame,
    ids: DataFrame,
    at: Column,
    add: tuple[str, ...] = ("TRASH",),
    remove: tuple[str, ...] = (),
) -> DataFrame:
    """Mailbox state with labels added and removed on the given ids. A message already
    in the trash keeps the time it was put there."""
    marked = ids.select("id").distinct().withColumn("_hit", F.lit(True))
    labels = F.array_union("labels", F.array(*[F.lit(x) for x in add]).cast("array<string>"))
    labels = F.array_except(labels, F.array(*[F.lit(x) for x in remove]).cast("array<string>"))
    hit = F.col("_hit").isNotNull()
    trashed = F.col("trashed_at")
    if "TRASH" in add:
        trashed = F.when(hit, F.coalesce(trashed, at)).otherwise(trashed)
    if "TRASH" in remove:
        trashed = F.when(~hit, trashed)
    return (
        state.join(marked, "id", "left")
        .withColumn("labels", F.when(hit, labels).otherwise(F.col("labels")))
        .withColumn("trashed_at", trashed)
        .select(*state.columns)
    )


def move_to_trash(state: DataFrame, plan: DataFrame, at: Column) -> DataFrame:
    """`plan` is (chunk_id, ids)."""
    return apply_labels(state, plan.select(F.explode("ids").alias("id")), at)


def attempt_outcomes(plan: DataFrame, *attempts: DataFrame) -> DataFrame:
    """Outcome of a request that was tried in a batch and then one by one.

    Each attempt is (id, status). An id counts as tried again only while it failed. The
    result is (id, attempts, status), each planned id once; one that fails every time
    stays with status failed.
    """
    done = first_success(plan, *[a.select("id", "status") for a in attempts])
    return done.select("id", F.col("attempt").alias("attempts"), "status")


def is_due(run_start: dt.datetime | Column, run_type: str | Column = SCHEDULED) -> Column:
    """Trashed before this run began. A manual run purges nothing, and no run purges what it
    trashed itself. Never unknown."""
    start = run_start if isinstance(run_start, Column) else F.lit(run_start)
    kind = run_type if isinstance(run_type, Column) else F.lit(run_type)
    due = F.array_contains("labels", "TRASH") & (F.col("trashed_at") < start) & (kind != MANUAL)
    return F.coalesce(due, F.lit(False))


def purge_candidates(
    state: DataFrame, run_start: dt.datetime | Column, run_type: str | Column = SCHEDULED
) -> DataFrame:
    """Ids that are due."""
    return state.where(is_due(run_start, run_type)).select(*_by_mailbox(state), "id")


def purge_plan(candidates: DataFrame, size: int = PURGE_CHUNK) -> DataFrame:
    """(mailbox, chunk_id, ids): the requests. What changes in tables goes by the candidates."""
    return chunk_arrays(candidates, size, group_cols=_by_mailbox(candidates))


def purge(state: DataFrame, candidates: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """The state without the candidates, and the audit rows (id, purged_at)."""
    ids = candidates.select("id").distinct()
    audit = ids.join(state.select("id").distinct(), "id", "left_semi")
    return state.join(ids, "id", "left_anti"), audit.select("id", at.alias("purged_at"))


def marked_due(
    state: DataFrame,
    run_start: dt.datetime | Column,
    run_type: str | Column = SCHEDULED,
    out_col: str = "due",
) -> DataFrame:
    """The state with a mark on what is due. Each side is a filter on it: no join, no shuffle, and
    one scan of the state for whoever takes both sides from one pass."""
    return state.withColumn(out_col, is_due(run_start, run_type))


def purge_due(
    state: DataFrame, run_start: dt.datetime, at: Column, run_type: str = SCHEDULED
) -> tuple[DataFrame, DataFrame]:
    """The state without what is due, and the audit rows (id, purged_at). Ids of a state are
    unique; for a list of ids from elsewhere see purge."""
    marked = marked_due(state, run_start, run_type, "_due")
    return (
        marked.where(~F.col("_due")).drop("_due"),
        marked.where("_due").select("id", at.alias("purged_at")),
    )
