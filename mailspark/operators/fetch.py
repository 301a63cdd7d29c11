"""Listing ids and fetching payloads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from mailspark.functions.dates import DAY_FORMAT
from mailspark.operators.chunks import first_n, first_n_per_group

# Days a run looks back, page caps, request and retry sizes.
DAYS_BACK = 7
DAYS_BACK_BATCHED = 10
PAGE_SIZE = 100
RESULT_CAP = 500
FETCH_CHUNK = 50
RAW_FETCH_CHUNK = 100
EMPTY_PAYLOAD = "{}"


def in_days(messages: DataFrame, from_date: dt.date | Column, days: int = DAYS_BACK) -> DataFrame:
    """Messages of the `days` days before `from_date`. With a literal date the two
    bounds reach the scan as pushed filters."""
    if isinstance(from_date, Column):
        start, end = F.date_sub(from_date, days), from_date
    else:
        start, end = F.lit(from_date - dt.timedelta(days=days)), F.lit(from_date)
    at = F.col("received_at")
    return messages.where((at >= start.cast("timestamp")) & (at < end.cast("timestamp")))


def day_after_last(messages: DataFrame) -> Column:
    """The day after the newest message, as a scalar subquery: nothing is collected."""
    newest = messages.agg(F.max("received_at").alias("newest"))
    return newest.select(F.date_add(F.to_date("newest"), 1)).scalar()


def list_ids(messages: DataFrame, from_date: dt.date | Column, days: int = DAYS_BACK) -> DataFrame:
    return in_days(messages, from_date, days).select("id")


def list_ids_by_range(messages: DataFrame, ranges: DataFrame) -> DataFrame:
    """Ids with the day range they fall into. `ranges` holds a row per day asked for."""
    dated = messages.select("id", F.to_date("received_at").alias("_day"))
    days = ranges.withColumn("_day", F.to_date("after_date", DAY_FORMAT))
    return dated.join(days, "_day").select("id", "after_date", "before_date")


def page_cap_per_day(messages: DataFrame, n: int) -> DataFrame:
    """Only the newest n messages of each day: what one result page shows."""
    dated = messages.withColumn("day", F.to_date("received_at"))
    return first_n_per_group(dated, n, ("day",), (F.col("received_at").desc(), F.col("id")))


def list_since(messages: DataFrame, since: dt.date, folder: str = "INBOX") -> DataFrame:
    return messages.where(
        F.array_contains("labels", folder)
        & (F.col("received_at") >= F.lit(since).cast("timestamp"))
    )


def list_by_label(
    messages: DataFrame, label_col: str, values, n: int | None = None
) -> DataFrame:
    """The messages of each label value, or the first n of each, all values in one job."""
    wanted = messages.where(F.col(label_col).isin(*values))
    if n is None:
        return wanted
    return first_n_per_group(wanted, n, (label_col,), (F.col("id"),))


def list_trash(state: DataFrame, n: int | None = None) -> DataFrame:
    """Ids in the trash, or the first n of them."""
    ids = state.where(F.array_contains("labels", "TRASH")).select("id")
    return ids if n is None else first_n(ids, n)


def restrict(messages: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    return messages.join(ids.select(id_col).distinct(), id_col, "left_semi")


def fetch_payloads(messages: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, payload) for the ids asked for; a message without payload has an empty one."""
    return restrict(messages, ids).select(
        "id", F.coalesce("payload", F.lit(EMPTY_PAYLOAD)).alias("payload")
    )


def missing(requested: DataFrame, got: DataFrame, id_col: str = "id") -> DataFrame:
    return requested.join(got.select(id_col).distinct(), id_col, "left_anti")


def tagged_attempts(requested: DataFrame, *attempts: DataFrame) -> DataFrame:
    """One row for each request (turn 0) and each try (turn 1, 2, ...): id, turn, ok, payload."""
    none = F.lit(None).cast("string")
    rows = requested.select("id", F.lit(0).alias("turn"), F.lit(False).alias("ok"), none.alias("payload"))
    for turn, tried in enumerate(attempts, start=1):
        payload = F.col("payload").cast("string") if "payload" in tried.columns else none
        ok = F.coalesce(F.col("status") == "ok", F.lit(False))
        rows = rows.unionByName(
            tried.select("id", F.lit(turn).alias("turn"), ok.alias("ok"), payload.alias("payload"))
        )
    return rows


def first_success(requested: DataFrame, *attempts: DataFrame) -> DataFrame:
    """(id, attempt, payload, status), each requested id once, in one shuffle.

    The first try that worked counts; of several rows of one try, the least payload. An id that
    never worked has the number of tries and status failed.
    """
    won = F.min(F.when(F.col("ok"), F.struct("turn", "payload"))).alias("won")
    return (
        tagged_attempts(requested, *attempts)
        .groupBy("id")
        .agg(F.min("turn").alias("asked"), won)
        .where("asked = 0")
        .select(
            "id",
            F.coalesce("won.turn", F.lit(len(attempts))).alias("attempt"),
            "won.payload",
            F.when(F.col("won").isNull(), "failed").otherwise("ok").alias("status"),
        )
    )


def fetch_with_retry(requested: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Outcome of a fetch with one retry of what failed.

    `first` and `second` are attempts (id, status, payload). The result holds each
    requested id once, as (id, payload, attempt, status): an id that failed twice is
    kept with status failed.
    """
    return first_success(requested, first, second).select("id", "payload", "attempt", "status")
