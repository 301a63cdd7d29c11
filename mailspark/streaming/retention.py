"""A timer for each trashed message: a purge request once its time has come.

Events are (id, at, trashed): a message was moved to the trash at that time, or taken out of it.
A stay in the trash begins with the first move there and ends with the next taking out; at one
instant, taking out comes last. A stay that lasts longer than `hold` gives one request.

Events may come in any order up to the watermark's delay. So nothing is decided when a row comes:
the state holds the events of the ids of a bucket (a hash of the id), and a timer in event time fires
when the watermark has passed an event of one of them and the hold, at which time all that matters to
it is there. Every id is settled by itself, at each of its own times up to the watermark; the bucket
is read and written once in a batch that brings it so far, and its timer is set to the next time. What
lies before is then forgotten, so the state holds a hold's worth of events; a message that was requested is gone,
and a move of its id to the trash after that would be a new stay. (A time-to-live of the state store
is for processing time only.) The requests do not depend on how the events are cut into batches.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

REQUEST = "id string, trashed_at timestamp, due_at timestamp"
EVENT = "id string, at_us bigint, trashed boolean"
# Ids are kept in so many lists: a call for each id costs milliseconds
BUCKETS = 4096


def stays(events: list[tuple[int, bool]]) -> list[tuple[int, int | None]]:
    """(begin, end) of each stay, by time; the last may have no end."""
    out, begin = [], None
    for at, trashed in sorted(set(events), key=lambda e: (e[0], not e[1])):
        if trashed and begin is None:
            begin = at
        elif not trashed and begin is not None:
            out.append((begin, at))
            begin = None
    return [*out, (begin, None)] if begin is not None else out


def settle(
    events: list[tuple[int, bool]], hold_us: int, upto: list[int]
) -> tuple[list[tuple[int, bool]], list[int]]:
    """What is left of the events of an id once the times `upto` (ascending milliseconds) have
    come, and the begins of the stays that have lasted the hold at one of them."""
    due = []
    for now in upto:
        found = stays(events)
        # of what happened up to then only a stay matters that is open and ends in time
        later = [e for e in events if timer(e[0], hold_us) > now]
        for begin, end in found:
            if timer(begin, hold_us) <= now and end is not None and (
                timer(end, hold_us) > now and end - begin <= hold_us
            ):
                later.insert(0, (begin, True))
        due += [
            begin for begin, end in found
            if timer(begin, hold_us) == now and (end is None or end - begin > hold_us)
        ]
        events = later
    return events, due


def timer(at: int, hold_us: int) -> int:
    """The first millisecond at which a stay that begins at `at` has lasted the hold."""
    return -(-(at + hold_us) // 1000)


class RetentionTimer(StatefulProcessor):
    """One request for each stay in the trash that outlasts `hold`, for all ids of a bucket."""

    def __init__(self, hold: dt.timedelta):
        self.hold_us = hold // dt.timedelta(microseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", EVENT)
        self.settled: dict = {}  # the watermark up to which a bucket was settled in this batch

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        first = None
        for batch in rows:
            if not len(batch):
                continue
            at = batch["at_us"].tolist()
            self.events.appendList(list(zip(batch["id"].tolist(), at, batch["trashed"].tolist())))
            first = min(at) if first is None else min(first, *at)
        if first is not None:
            self.handle.registerTimer(timer(first, self.hold_us))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, watermark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        if self.settled.get(key) == watermark:
            return
        self.settled[key] = watermark
        of_id: dict[str, list[tuple[int, bool]]] = {}
        for id_, at, trashed in self.events.get():
            of_id.setdefault(id_, []).append((at, trashed))
        left, due, following = [], [], None
        for id_, events in of_id.items():
            times = sorted({timer(at, self.hold_us) for at, _ in events})
            events, begins = settle(
                events, self.hold_us, [t for t in times if t <= max(now, watermark)]
            )
            left += [(id_, at, trashed) for at, trashed in events]
            due += [(id_, begin) for begin in begins]
            coming = next((t for t in times if t > max(now, watermark)), None)
            if coming is not None:
                following = coming if following is None else min(following, coming)
        if left:
            self.events.put(left)
        else:
            self.events.clear()
        if following is not None:
            self.handle.registerTimer(following)
        if due:
            yield pd.DataFrame({
                "id": [id_ for id_, _ in due],
                "trashed_at": [pd.Timestamp(at, unit="us") for _, at in due],
                "due_at": [pd.Timestamp(at + self.hold_us, unit="us") for _, at in due],
            })

    def close(self) -> None:
        pass


def purge_requests(
    events: DataFrame, hold: dt.timedelta, late: str = "1 day", buckets: int = BUCKETS
) -> DataFrame:
    """(id, trashed_at, due_at) of a stream of (id, at, trashed). Needs the RocksDB state store.
    Rows without id or time, or that come after the watermark, are left out."""
    timed = events.where("id IS NOT NULL AND at IS NOT NULL").withWatermark("at", late)
    return (
        timed.select(
            F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("bucket"), "id", "at",
            F.unix_micros("at").alias("at_us"), "trashed",
        )
        .groupBy("bucket")
        .transformWithStateInPandas(
            statefulProcessor=RetentionTimer(hold),
            outputStructType=REQUEST,
            outputMode="Append",
            timeMode="EventTime",
        )
    )


def due_by_batch(events: DataFrame, hold: dt.timedelta, until) -> DataFrame:
    """The same of a whole table, for a watermark that has reached `until`, where no message is
    moved to the trash again after its request."""
    in_time = Window.partitionBy("id").orderBy("at", F.col("trashed").desc())
    moves = events.where("id IS NOT NULL AND at IS NOT NULL").select("id", "at", "trashed")
    begins = F.col("trashed") & ~F.coalesce(F.lag("trashed").over(in_time), F.lit(False))
    after = in_time.rowsBetween(1, Window.unboundedFollowing)
    end = F.min(F.when(~F.col("trashed"), F.col("at"))).over(after)
    due = F.col("at") + F.lit(hold)
    return (
        moves.withColumns({"begins": begins, "end": end, "due_at": due})
        .where("begins AND (end IS NULL OR end > due_at)").where(due <= until)
        .select("id", F.col("at").alias("trashed_at"), "due_at")
    )
