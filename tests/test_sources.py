import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from mailspark import staging
from mailspark.session import scratch_dir, shared_dir
from mailspark.sources import landing, mailbox, snapshots, state


def new_table(spark, tmp_path, buckets=4):
    name = "t_" + uuid.uuid4().hex[:10]
    landing.create_landing(spark, name, str(tmp_path / name), buckets)
    return name


ROW = "id string, received_at timestamp, subject string, payload string"
DAY = dt.datetime(2024, 1, 1)


def test_landing_is_insert_if_absent(spark, tmp_path):
    name = new_table(spark, tmp_path)
    first = spark.createDataFrame([("a", DAY, "s1", "p"), ("b", DAY, "s2", "p")], ROW)
    second = spark.createDataFrame(
        [("b", DAY, "late", "p"), ("c", DAY, "s3", "p"), ("c", DAY, "s3", "p")], ROW
    )
    landing.land(first, name, "run-1")
    for _ in range(2):  # the second time is a retry of the same run
        landing.land(second, name, "run-2")
    rows = sorted((r["id"], r["subject"], r["run_id"]) for r in landing.landed(spark, name).collect())
    assert rows == [("a", "s1", "run-1"), ("b", "s2", "run-1"), ("c", "s3", "run-2")]
    assert landing.landed_count(spark, name).first()[0] == 3


def test_a_rerun_that_brings_nothing_leaves_nothing(spark, tmp_path):
    name = new_table(spark, tmp_path)
    rows = spark.createDataFrame([("a", DAY, "s1", "p")], ROW)
    landing.land(rows, name, "run-1")
    landing.land(rows.withColumn("id", F.lit("b")), name, "run-2")
    landing.land(rows.limit(0), name, "run-1")
    assert [r["id"] for r in landing.landed(spark, name).collect()] == ["b"]
    with pytest.raises(ValueError):
        landing.land(rows, name, "x') SELECT 1 --")


def test_landing_refuses_bad_ids(spark, tmp_path):
    name = new_table(spark, tmp_path)
    with pytest.raises(Exception, match="1 to 16 characters"):
        landing.land(spark.createDataFrame([("x" * 17, DAY, "s", "p")], ROW), name, "run")
    assert landing.landed_count(spark, name).first()[0] == 0


def test_landed_side_is_not_shuffled(spark, tmp_path):
    name = new_table(spark, tmp_path, buckets=16)
    landing.land(spark.createDataFrame([("a", DAY, "s1", "p")], ROW), name, "run-1")
    batch = spark.createDataFrame([("b", DAY, "s1", "p")], ROW)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = landing.new_rows(batch, spark.table(name))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    scan = plan[: plan.index("FileScan")].splitlines()
    assert "Exchange" not in scan[-2]


def ids_of(spark, *ids):
    return spark.createDataFrame([(i, DAY, "s", "p") for i in ids], ROW)


def test_new_ids_read_no_landed_rows(spark, tmp_path):
    name = new_table(spark, tmp_path)
    landing.land(ids_of(spark, *[f"a{i}" for i in range(50)]), name, "run-1")
    landing.land(ids_of(spark, *[f"b{i}" for i in range(50)]), name, "run-2")
    parts = landing.parts_of(spark, name)
    assert [p.run_id for p in parts] == ["run-1", "run-2"]
    assert landing.landed_of(ids_of(spark, "c1", "c2").select("id"), name, parts) is None
    some = landing.landed_of(ids_of(spark, "a7", "c2").select("id"), name, parts)
    assert [r.id for r in some.collect()] == ["a7"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    # one run, and of it the bucket of the one id
    assert "run-1" in plan and "run-2" not in plan and "SelectedBucketsCount: 1 out of 4" in plan


def test_filters_miss_no_id_and_are_seldom_wrong(spark):
    ids = spark.range(20_000).select(F.format_string("%016x", F.xxhash64("id")).alias("id"))
    others = spark.range(20_000, 40_000).select(
        F.format_string("%016x", F.xxhash64("id")).alias("id"))
    filters = landing.filters_of(ids, 4).withColumn("part", F.lit("p"))
    assert landing.may_have_landed(ids, filters, 4).count() == 20_000
    assert landing.may_have_landed(others, filters, 4).count() < 60
    assert landing.may_have_landed(ids.limit(0), filters, 4).count() == 0
    # an id that a filter knows by mistake is still landed
    assert sum(len(r.bits) for r in filters.collect()) <= 2.1 * 20_000


def test_an_id_that_a_filter_knows_by_mistake_lands(spark, tmp_path, monkeypatch):
    name = new_table(spark, tmp_path)
    landing.land(ids_of(spark, "a", "b"), name, "run-1")
    monkeypatch.setattr(landing, "NAMED_IDS", 0)

    def everything(ids, filters, buckets):
        return ids.select("id", F.lit("run-1").alias("part"))

    monkeypatch.setattr(landing, "may_have_landed", everything)
    landing.land(ids_of(spark, "b", "c"), name, "run-2")
    assert sorted((r.id, r.run_id) for r in landing.landed(spark, name).collect()) == [
        ("a", "run-1"), ("b", "run-1"), ("c", "run-2")]


def test_many_runs_are_few_folders(spark, tmp_path):
    name = new_table(spark, tmp_path, buckets=2)
    for k in range(30):
        # each run brings one new id and one of the run before
        landing.land(ids_of(spark, f"i{k}", f"i{max(0, k - 1)}"), name, f"run-{k}")
        landing.compact(spark, name, fan=3, open_runs=2)
    parts = landing.parts_of(spark, name)
    assert len(parts) <= 2 + 2 * 4  # open runs, and below `fan` at each level
    assert [p.run_id for p in parts if not p.level][-1] == "run-29"
    assert sorted(r.id for r in landing.landed(spark, name).collect()) == sorted(
        f"i{k}" for k in range(30))
    # a merged run that comes again adds nothing; an open one is replaced
    landing.land(ids_of(spark, "i0", "i1"), name, "run-1")
    landing.land(ids_of(spark, "new"), name, "run-29")
    assert sorted(r.id for r in landing.landed(spark, name).collect()) == sorted(
        [f"i{k}" for k in range(29)] + ["new"])


def test_a_crash_while_landing_or_merging_changes_nothing(spark, tmp_path, monkeypatch):
    name = new_table(spark, tmp_path, buckets=2)
    for k in range(4):
        landing.land(ids_of(spark, f"i{k}"), name, f"run-{k}")
    whole = [f"i{k}" for k in range(4)]

    def lost(*_):
        raise RuntimeError("driver lost")

    for step in ("_point", "filters_of"):
        with monkeypatch.context() as broken:
            broken.setattr(landing, step, lost)
            with pytest.raises(RuntimeError):
                landing.land(ids_of(spark, "other"), name, "run-3")
        assert sorted(r.id for r in landing.landed(spark, name).collect()) == whole
    # merged rows are there, those they replace not yet dropped
    with monkeypatch.context() as broken:
        real, calls = landing._drop_merged, []

        def second(*args):
            calls.append(1)
            return lost() if len(calls) == 2 else real(*args)

        broken.setattr(landing, "_drop_merged", second)
        with pytest.raises(RuntimeError):
            landing.compact(spark, name, fan=4, open_runs=0)
    assert spark.table(name).count() == 8
    assert sorted(r.id for r in landing.landed(spark, name).collect()) == whole
    assert landing.compact(spark, name, fan=4, open_runs=0) == 0
    assert sorted(r.id for r in spark.table(name).collect()) == whole


def test_changes_rewrite_touched_days_only(spark, tmp_path):
    path, audit = str(tmp_path / "state"), str(tmp_path / "audit")
    rows = [
        (f"d{d}i{i}", 1, DAY + dt.timedelta(days=d), ["INBOX"], None) for d in range(3) for i in range(4)
    ]
    state.write_state(spark.createDataFrame(
        rows, "id string, mailbox bigint, received_at timestamp, labels array<string>, "
        "trashed_at timestamp"
    ), path)
    untouched = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "state" / "day=2024-01-03").iterdir()}
    trash = spark.createDataFrame([("d0i0",), ("d0i1",), ("nowhere",)], "id string")
    purge = spark.createDataFrame([("d1i0",), ("d0i1",)], "id string")
    at = F.lit(DAY).cast("timestamp")
    for _ in range(2):
        state.commit_changes(spark, path, trash, purge, at, audit, "r1")
    after = {r["id"]: r["labels"] for r in state.read_state(spark, path).collect()}
    assert len(after) == 11 and "d1i0" not in after
    assert [i for i, x in sorted(after.items()) if "TRASH" in x] == ["d0i0", "d0i1"]
    now = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "state" / "day=2024-01-03").iterdir()}
    assert now == untouched
    assert spark.read.parquet(audit).groupBy("action").count().count() == 2


def test_snapshot_round_trip(spark, tmp_path):
    base = str(tmp_path / "snap")
    df = spark.createDataFrame([("a", 1), ("b", 0)], "id string, label int")
    for _ in range(2):
        snapshots.write_snapshot(df, base, dt.datetime(2025, 8, 22, 3, 23, 5), "label")
    back = snapshots.read_snapshot(
        spark, base, "id string, run_ts string, label int", "22-08-2025-03-23-05"
    )
    assert sorted((r["id"], r["label"]) for r in back.collect()) == [("a", 1), ("b", 0)]
    assert list((tmp_path / "snap" / "run_ts=22-08-2025-03-23-05" / "label=1").glob("*.json.gz"))


def test_handoff_is_first_in_first_out(spark, tmp_path):
    box = snapshots.Handoff(str(tmp_path), "r1")
    box.push("q", spark.createDataFrame([("late",)], "id string"), 5)
    box.push("q", spark.createDataFrame([("early",)], "id string"), 1)
    box.push("q", spark.createDataFrame([("early again",)], "id string"), 1)
    assert [r["id"] for r in box.pop(spark, "q").collect()] == ["early again"]
    assert [r["id"] for r in box.pop(spark, "q", after=1).collect()] == ["late"]
    assert box.pop(spark, "q", after=5).count() == 0


def test_mailbox_source_reads_only_its_days(spark, tiny, tmp_path):
    path = str(tmp_path / "box")
    messages = staging.messages(spark, tiny)
    mailbox.write_mailbox(messages, path)
    mailbox.register(spark)
    read = spark.read.format("mailbox").options(path=path, from_date="2024-01-04", days="2").load()
    want = messages.where("received_at >= '2024-01-02' and received_at < '2024-01-04'")
    got = read.select("id", "received_at", "subject", "body")
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == want.count() > 0
    reader = mailbox.MailboxReader({"path": path, "from_date": "2024-01-04", "days": "2"})
    assert {p.day for p in reader.partitions()} == {"2024-01-02", "2024-01-03"}
    none = spark.read.format("mailbox").options(path=path, from_date="2020-01-01").load()
    assert none.count() == 0


def test_many_days_share_a_partition_and_large_files_are_split(spark, tiny, tmp_path, monkeypatch):
    path = str(tmp_path / "box")
    messages = staging.messages(spark, tiny)
    mailbox.write_mailbox(messages, path)
    want = sorted(r.id for r in messages.where("received_at < '2024-01-05'").collect())
    for parts, large in ((2, 1 << 30), (512, 1)):
        monkeypatch.setattr(mailbox, "PARTS", parts)
        monkeypatch.setattr(mailbox, "LARGE", large)
        reader = mailbox.MailboxReader({"path": path, "from_date": "2024-01-05", "days": "4"})
        found = reader.partitions()
        assert len(found) <= 2 if parts == 2 else all(p.row_group is not None for p in found)
        ids = [i for p in found for batch in reader.read(p) for i in batch.column(0).to_pylist()]
        assert sorted(ids) == want


def test_scratch_lies_below_the_shared_folder(spark):
    base = shared_dir(spark)
    assert scratch_dir(spark, "x").startswith(base)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")
