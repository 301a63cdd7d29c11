import datetime as dt
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mailspark import staging
from mailspark.operators import features, learn, triage
from mailspark.plans import runs
from mailspark.sources import landing, snapshots
from mailspark.streaming import streams

SMALL = learn.BoostParams(rounds=2, max_depth=2)


def model(spark, tiny):
    known = features.embed(staging.labelled(spark, tiny)).select("id", "features", "label")
    return learn.fit(known, SMALL)


def test_triage_run(spark, tiny, tmp_path):
    sent = staging.payloads(spark, tiny).select("id", "payload", "received_at")
    start = dt.datetime(2024, 1, 6)
    old = dt.datetime(2023, 12, 1)
    state = sent.select(
        "id", F.lit(1).cast("bigint").alias("mailbox"), "received_at",
        F.array(F.lit("INBOX")).alias("labels"),
        F.lit(None).cast("timestamp").alias("trashed_at"),
    ).unionByName(spark.createDataFrame(
        [("gone", 1, old, ["TRASH"], old)],
        "id string, mailbox bigint, received_at timestamp, labels array<string>, "
        "trashed_at timestamp",
    ))
    trees = model(spark, tiny)
    for kind in (triage.MANUAL, triage.SCHEDULED):
        name = "t_" + uuid.uuid4().hex[:10]
        landing.create_landing(spark, name, str(tmp_path / name), buckets=4)
        result = runs.triage_run(sent, state, trees, name, start, kind, days=3)
        scored = result.scored.collect()
        recent = sent.where("received_at >= '2024-01-03' and received_at < '2024-01-06'")
        assert {r["id"] for r in scored} == {r["id"] for r in recent.select("id").collect()}
        bad = {r["id"] for r in scored if not r["important"]}
        planned = [i for r in result.plan.collect() for i in r["ids"]]
        assert sorted(planned) == sorted(bad)
        counts = result.counts.first()
        assert (counts["rows"], counts["to_trash"]) == (len(scored), len(bad))
        # scores are read back, not computed again
        for frame in (result.scored, result.plan, result.state):
            assert "ArrowEval" not in frame._jdf.queryExecution().executedPlan().toString()
        after = {r["id"]: r for r in result.state.collect()}
        assert {i for i, r in after.items() if "TRASH" in r["labels"] and i != "gone"} == bad
        landed = landing.landed(spark, name).count()
        if kind == triage.MANUAL:
            assert landed == 0 and "gone" in after and result.purged.count() == 0
        else:
            assert landed == len(scored) and "gone" not in after
            assert [r["id"] for r in result.purged.collect()] == ["gone"]


def test_training_run(spark, tiny):
    known = staging.labelled(spark, tiny).select("id", "subject", "body", "label")
    parts = [known.where(F.col("label") == v).drop("label") for v in (1, 0)]
    others = staging.unlabelled(spark, tiny).select("id", "subject", "body")
    result = runs.train(*parts, others, SMALL, 0, max_rounds=1)
    assert result.confusion.count() == 2
    assert 0.0 <= result.recall.first()[0] <= 1.0
    assert result.rounds.count() <= 1


def test_snapshots_of_labels_and_raw_mail(spark, tiny, tmp_path):
    known = staging.labelled(spark, tiny).select("id", "subject", "body", "label")
    runs.training_snapshot(known, str(tmp_path / "s"), dt.datetime(2024, 1, 1))
    back = snapshots.read_snapshot(spark, str(tmp_path / "s"), "id string, label int")
    assert back.count() == known.count()
    raw = staging.raw_mail(spark, tiny)
    runs.raw_mail_snapshot(raw, dt.date(2024, 1, 3), str(tmp_path / "raw"))
    parsed = runs.read_raw_mail(spark, str(tmp_path / "raw"))
    assert 0 < parsed.count() < raw.count()


def test_stream_equals_batch(spark, tiny, tmp_path):
    state = staging.mailbox_state(spark, tiny).select("id", "received_at")
    state.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = streams.stream_files(spark, str(tmp_path / "in"), state.schema, max_files=1)
    batch = {r["day"]: r["arrived"] for r in streams.arrivals_per_day(state).collect()}
    seen = {}

    def keep(df, _):
        seen.update({r["day"]: r["arrived"] for r in df.collect()})

    query = streams.arrivals_per_day(stream, late="60 days").writeStream.outputMode("update")
    query.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True
    ).start().awaitTermination()
    assert seen == batch
    assert streams.unique_on_arrival(state.union(state)).count() == state.count()


def test_batches_land_and_plan_once(spark, tiny, tmp_path):
    sent = staging.payloads(spark, tiny).select("id", "payload")
    sent.repartition(2).write.parquet(str(tmp_path / "in"))
    name = "t_" + uuid.uuid4().hex[:10]
    landing.create_landing(spark, name, str(tmp_path / name), buckets=4)
    process = streams.land_and_score(name, model(spark, tiny), str(tmp_path / "plans"))
    stream = streams.stream_files(spark, str(tmp_path / "in"), sent.schema, max_files=1)
    streams.catch_up(stream, process, str(tmp_path / "c"))
    assert landing.landed(spark, name).select("id").distinct().count() == sent.count()
    before = spark.read.parquet(str(tmp_path / "plans")).count()
    # the same batch again, as after a lost driver
    process(spark.read.parquet(str(tmp_path / "in")).limit(0), 99)
    streams.catch_up(stream, process, str(tmp_path / "c"))
    assert landing.landed(spark, name).count() == sent.count()
    assert spark.read.parquet(str(tmp_path / "plans")).count() == before


def test_two_streams_share_a_landing_table(spark, tiny, tmp_path):
    sent = staging.payloads(spark, tiny).select("id", "payload")
    name = "t_" + uuid.uuid4().hex[:10]
    landing.create_landing(spark, name, str(tmp_path / name), buckets=4)
    process = streams.land_and_score(name, model(spark, tiny), str(tmp_path / "plans"))
    half = F.col("id") < "0000000000000100"
    for k, part in enumerate((half, ~half)):  # both start at batch 0
        sent.where(part).write.parquet(str(tmp_path / f"in{k}"))
        stream = streams.stream_files(spark, str(tmp_path / f"in{k}"), sent.schema)
        streams.catch_up(stream, process, str(tmp_path / f"c{k}"))
    assert landing.landed(spark, name).count() == sent.count()
    assert len(list((tmp_path / "plans").glob("stream=*"))) == 2


def test_workers_of_a_batch_get_few_rows_and_decoded_ones_lie_on_disk(
    spark, tiny, tmp_path, monkeypatch
):
    sent = staging.payloads(spark, tiny).select("id", "payload")
    sent.coalesce(1).write.parquet(str(tmp_path / "in"))
    name = "t_" + uuid.uuid4().hex[:10]
    landing.create_landing(spark, name, str(tmp_path / name), buckets=4)
    sizes, levels, plain = [], [], learn.score_messages

    def watched(decoded, *rest):
        count = decoded.select("id").mapInArrow(
            lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches),
            "n bigint")
        sizes.extend(r["n"] for r in count.collect())
        levels.append(decoded.storageLevel)
        return plain(decoded, *rest)

    monkeypatch.setattr(streams.learn, "score_messages", watched)
    monkeypatch.setattr(streams, "BATCH_ROWS", 30)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    process = streams.land_and_score(name, model(spark, tiny), str(tmp_path / "plans"))
    stream = streams.stream_files(spark, str(tmp_path / "in"), sent.schema)
    streams.catch_up(stream, process, str(tmp_path / "c"))
    assert sum(sizes) == sent.count() == landing.landed(spark, name).count() and max(sizes) <= 30
    assert [(level.useDisk, level.useMemory) for level in levels] == [(True, False)]
    # by hand in the caller's own session, which keeps its setting
    process(spark.read.parquet(str(tmp_path / "in")), 7)
    assert max(sizes) <= 30 and spark.conf.get(key) == before
    monkeypatch.setattr(streams.landing, "land", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        process(spark.read.parquet(str(tmp_path / "in")), 8)
    assert spark.conf.get(key) == before


def test_training_from_snapshots_saves_the_model(spark, tiny, tmp_path):
    sent = staging.payloads(spark, tiny).select("id", "payload")
    known = sent.join(staging.labels(spark, tiny), "id")
    at = dt.datetime(2024, 1, 1)
    runs.training_snapshot(known, str(tmp_path / "known"), at, per_label=30)
    snapshots.write_snapshot(sent.join(known, "id", "left_anti"), str(tmp_path / "rest"), at)
    result = runs.train_from_snapshots(
        spark, str(tmp_path / "known"), str(tmp_path / "rest"), str(tmp_path / "model"),
        params=SMALL, n_trials=0, max_rounds=1,
    )
    assert result.confusion.count() == 2
    loaded = learn.load_model(str(tmp_path / "model"))
    assert set(loaded.nodes["tree"].to_pylist()) == set(range(SMALL.rounds))


def test_topic_values(spark):
    df = spark.createDataFrame(
        [('"a1"',), ('{"stop_consumer":true}',), ('"b2"',)], "value string"
    )
    assert sorted(r["id"] for r in streams.ids_of_topic(df).collect()) == ["a1", "b2"]
