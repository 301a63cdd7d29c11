"""Day folders, purges in one pass, pooled vectors and the retention timer."""

import datetime as dt
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from mailspark import staging
from mailspark.functions import dates
from mailspark.operators import features, triage
from mailspark.sources import by_day
from mailspark.streaming import retention, streams


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def days(spark, tiny, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("days") / "messages")
    by_day.write_by_day(staging.messages(spark, tiny).select("id", "received_at"), path)
    return path


def test_a_range_of_dates_prunes_folders(spark, tiny, days):
    assert by_day.newest_day(spark, days) == dt.date(2024, 1, 6)
    found = by_day.in_days(by_day.read_by_day(spark, days), dt.date(2024, 1, 5), 2)
    plan = plan_of(found)
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ >= 2024-01-03", plan)
    want = staging.messages(spark, tiny).where(
        "received_at >= '2024-01-03' AND received_at < '2024-01-05'")
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in want.collect())


def test_a_day_is_not_cut_into_many_files(spark, tmp_path):
    path, n = tmp_path / "messages", 4000
    at = F.timestamp_seconds(F.lit(staging.START_EPOCH) + F.col("id") % 40 * 86400)
    messages = spark.range(n).select(F.col("id").cast("string"), at.alias("received_at"))
    by_day.write_by_day(messages, str(path))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(list(path.glob("day=*"))) == 40
    assert len(list(path.glob("day=*/*.parquet"))) <= 40 + width
    assert by_day.read_by_day(spark, str(path)).drop("day").exceptAll(messages).count() == 0


def test_a_table_of_ranges_prunes_folders_when_it_runs(spark, tiny, days, tmp_path):
    asked = str(tmp_path / "ranges")
    anchor = spark.range(1)
    dates.day_ranges(anchor, F.lit(dt.date(2024, 1, 5)), 2).write.parquet(asked)
    found = by_day.in_ranges(by_day.read_by_day(spark, days), spark.read.parquet(asked))
    plan = plan_of(found)
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan
    rows = found.collect()
    want = staging.messages(spark, tiny).where(
        "received_at >= '2024-01-03' AND received_at < '2024-01-05'")
    assert sorted(r.id for r in rows) == sorted(r.id for r in want.collect())
    assert {(r.after_date, r.before_date) for r in rows} == {
        ("2024/01/03", "2024/01/04"), ("2024/01/04", "2024/01/05")}
    # only the folders asked for were read
    scans = []

    def visit(node):
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            return visit(node.executedPlan())
        if node.nodeName().endswith("QueryStage"):
            return visit(node.plan())
        if node.nodeName().startswith("Scan parquet") and "day" in node.toString():
            metrics = node.metrics()
            if metrics.contains("numPartitions"):
                scans.append(metrics.apply("numPartitions").value())
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    visit(found._jdf.queryExecution().executedPlan())
    assert scans == [2]


def test_ranges_over_an_empty_or_missing_day(spark, days, tmp_path):
    asked = str(tmp_path / "ranges")
    dates.day_ranges(spark.range(1), F.lit(dt.date(2030, 1, 5)), 2).write.parquet(asked)
    found = by_day.in_ranges(by_day.read_by_day(spark, days), spark.read.parquet(asked))
    assert found.count() == 0


def test_a_purge_is_one_scan_without_shuffle(spark, tiny):
    state = staging.mailbox_state(spark, tiny)
    at = F.lit(dt.datetime(2024, 1, 20)).cast("timestamp")
    kept, audit = triage.purge_due(state, dt.datetime(2024, 1, 20), at)
    marked = triage.marked_due(state, dt.datetime(2024, 1, 20))
    for df in (kept, audit, marked):
        plan = plan_of(df)
        assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan
    by_ids, by_ids_audit = triage.purge(
        state, triage.purge_candidates(state, dt.datetime(2024, 1, 20)), at)
    assert kept.exceptAll(by_ids).count() == by_ids.exceptAll(kept).count() == 0
    assert sorted(map(tuple, audit.collect())) == sorted(map(tuple, by_ids_audit.collect()))
    assert kept.count() + audit.count() == state.count() and audit.count() > 0
    manual, none = triage.purge_due(state, dt.datetime(2024, 1, 20), at, triage.MANUAL)
    assert manual.count() == state.count() and none.count() == 0


def test_masked_mean_is_one_aggregate_of_vectors(spark):
    df = spark.createDataFrame(
        [("a", [1.0, 2.0], 1), ("a", [3.0, None], 1), ("a", [9.0, 9.0], 0), ("b", [5.0, 5.0], 0),
         ("c", [7.0], 1), ("c", None, 1), ("d", [1.0, 1.0], None)],
        "id string, v array<double>, m int")
    got = {r.id: r.pooled for r in features.masked_mean(df, "id", "v", "m", 2).collect()}
    assert got == {"a": [2.0, 1.0], "b": [0.0, 0.0], "c": [3.5, 0.0], "d": [0.0, 0.0]}
    wide = spark.range(50).select(
        (F.col("id") % 3).alias("key"),
        F.transform(F.sequence(F.lit(1), F.lit(384)), lambda i: i / (F.col("id") + 1.0)).alias("v"),
        (F.col("id") % 2).alias("m"))
    pooled = features.masked_mean(wide, "key", "v", "m", 384)
    assert plan_of(pooled).count("summary") + plan_of(pooled).count("aggregate_metrics") > 0
    for r in pooled.collect():
        own = [i for i in range(50) if i % 3 == r.key and i % 2]
        for k in (0, 383):
            assert r.pooled[k] == pytest.approx(sum((k + 1) / (i + 1) for i in own) / len(own))


def moves(draw, n):
    """Moves to the trash and out of it, no id twice in the trash after its request."""
    out = []
    for i in range(n):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=draw.randrange(10**12))
        out.append((f"m{i}", at, True))
        stay = dt.timedelta(hours=draw.choice([1, 20, 47, 48, 49, 100]))
        if draw.random() < 0.6:
            out.append((f"m{i}", at + stay, False))
            if stay < dt.timedelta(hours=48) and draw.random() < 0.5:
                out.append((f"m{i}", at + stay + dt.timedelta(hours=2), True))
    return out + [("none", None, True), (None, dt.datetime(2024, 1, 2), True)]


def test_timers_give_the_requests_of_the_batch_rule(spark, tmp_path):
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "id string, at timestamp, trashed boolean"
    hold = dt.timedelta(hours=48)
    events = moves(random.Random(4), 60)
    # by time, with neighbours swapped, in three files: late within the delay
    events.sort(key=lambda e: (e[1] is None, e[1] or 0))
    for i in range(0, len(events) - 4, 4):
        events[i : i + 4] = reversed(events[i : i + 4])
    last = max(e[1] for e in events if e[1])
    for k in range(3):
        part = events[k * len(events) // 3 : (k + 1) * len(events) // 3]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(
            str(tmp_path / "in"))
        stream = streams.stream_files(spark, str(tmp_path / "in"), schema)
        streams.append_to(
            retention.purge_requests(stream, hold, "5 days"), str(tmp_path / "out"),
            str(tmp_path / "mark"))
    got = spark.read.schema(retention.REQUEST).parquet(str(tmp_path / "out"))
    until = F.lit(last - dt.timedelta(days=5)).cast("timestamp")
    want = retention.due_by_batch(spark.createDataFrame(events, schema), hold, until)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert 5 < got.count() < 60


def test_timers_ask_the_state_by_bucket_not_by_id():
    class Handle:
        def __init__(self):
            self.lists, self.timers, self.calls = [], set(), 0

        def getListState(self, name, schema):
            return self

        def registerTimer(self, at):
            self.calls += 1
            self.timers.add(at)

        def appendList(self, rows):
            self.calls += 1
            self.lists += rows

        def put(self, rows):
            self.calls += 1
            self.lists = list(rows)

        def clear(self):
            self.put([])

        def get(self):
            self.calls += 1
            return iter(self.lists)

    class At:
        def __init__(self, ms):
            self.ms = ms

        def getExpiryTimeInMs(self):
            return self.ms

        getCurrentWatermarkInMs = getExpiryTimeInMs

    hold_us, draw, handle = 10_000, random.Random(8), Handle()
    events = [(f"m{draw.randrange(300)}", 1000 * draw.randrange(50), draw.random() < 0.6)
              for _ in range(1000)]
    own = retention.RetentionTimer(dt.timedelta(microseconds=hold_us))
    own.init(handle)
    rows = pd.DataFrame(events, columns=["id", "at_us", "trashed"])
    own.handleInputRows((0,), iter([rows[:400], rows[400:]]), None)
    got, asked = [], 0
    for watermark in (20, 35, 70):
        own.settled.clear()  # a batch of its own
        for now in sorted(t for t in handle.timers if t <= watermark):
            for out in own.handleExpiredTimer((0,), At(watermark), At(now)):
                got += zip(out["id"], out["trashed_at"].astype("int64") // 1000)
            handle.timers.discard(now)
    want = []
    for name in {e[0] for e in events}:
        mine = [(at, trashed) for i, at, trashed in events if i == name]
        times = sorted({retention.timer(at, hold_us) for at, _ in mine})
        for time in times:  # one timer after the other, as by a timer for each event
            mine, due = retention.settle(mine, hold_us, [time])
            want += [(name, at) for at in due]
        assert not mine
    assert sorted(got) == sorted(want) and len(got) > 100 and not handle.lists
    assert handle.calls < 20  # not some for each of 300 ids


def test_a_timer_at_the_watermark_itself_fires(spark, tmp_path):
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema, at = "id string, at timestamp, trashed boolean", dt.datetime(2024, 1, 1)
    hold, ms = dt.timedelta(hours=2), dt.timedelta(milliseconds=1)
    rows = [("on", at), ("long", at - hold), ("early", at - ms), ("late", at + ms),
            ("last", at + hold + dt.timedelta(days=1))]
    spark.createDataFrame([(*r, True) for r in rows], schema).write.parquet(str(tmp_path / "in"))
    for buckets in (1, 4096):
        out = str(tmp_path / f"out{buckets}")
        stream = streams.stream_files(spark, str(tmp_path / "in"), schema)
        streams.append_to(retention.purge_requests(stream, hold, buckets=buckets), out,
                          str(tmp_path / f"mark{buckets}"))
        got = spark.read.schema(retention.REQUEST).parquet(out).collect()
        assert sorted(r.id for r in got) == ["early", "long", "on"]


def test_stays():
    assert retention.stays([(5, False), (1, True), (3, True), (9, True)]) == [(1, 5), (9, None)]
    assert retention.stays([(1, True), (1, False), (2, False)]) == [(1, 1)]
    assert retention.stays([]) == []
