import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailspark import staging
from mailspark.functions import text
from mailspark.operators import chunks, features, fetch, learn, quality, rawmail, triage


def ids(spark, n, partitions=4):
    return spark.range(0, n, 1, partitions).select(F.format_string("%05d", "id").alias("id"))


@pytest.mark.parametrize("n", [0, 1, 50, 51, 100, 101])
def test_chunk_edges(spark, n):
    got = chunks.chunk_arrays(ids(spark, n), 50).collect()
    sizes = [len(r["ids"]) for r in sorted(got, key=lambda r: r["chunk_id"])]
    assert sizes == [50] * (n // 50) + ([n % 50] if n % 50 else [])
    assert sorted(i for r in got for i in r["ids"]) == [f"{i:05d}" for i in range(n)]


def test_numbers_do_not_depend_on_partitioning(spark):
    def numbered(p):
        df = ids(spark, 3000).repartition(p).withColumn(
            "box", F.when(F.col("id") < "02500", "hot").otherwise(F.substring("id", 1, 4))
        )
        rows = chunks.number_rows(df, group_cols=("box",)).collect()
        return sorted((r["box"], r["pos"], r["id"]) for r in rows)

    once = numbered(1)
    assert once == numbered(4) == numbered(64)
    assert [pos for box, pos, _ in once if box == "hot"] == list(range(2500))


def test_a_hot_group_is_spread(spark):
    """One mailbox holds nearly everything; no task numbers more than its bucket."""
    df = ids(spark, 4000).withColumn("box", F.lit("hot"))
    buckets = df.groupBy("box", chunks.id_bucket(F.col("id"))).count()
    assert buckets.agg(F.max("count")).first()[0] < 20


def test_null_group_is_numbered(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("c", "x")], "id string, g string")
    rows = chunks.number_rows(df, group_cols=("g",)).collect()
    assert sorted((r["g"] or "", r["pos"]) for r in rows) == [("", 0), ("", 1), ("x", 0)]


def test_first_n_per_group_is_exact(spark):
    df = ids(spark, 1000).withColumn("g", F.when(F.col("id") < "00900", "hot").otherwise("cold"))
    rows = chunks.first_n_per_group(df, 7, ("g",), (F.col("id"),), salts=5).collect()
    assert sorted((r["g"], r["id"]) for r in rows) == sorted(
        [("hot", f"{i:05d}") for i in range(7)] + [("cold", f"{i:05d}") for i in range(900, 907)]
    )


def test_one_per_id(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 9, None)], "id string, at int, v string"
    )
    rows = chunks.one_per_id(df, order_cols=("at",)).collect()
    assert sorted(tuple(r) for r in rows) == [("a", 1, "y"), ("b", 9, None)]


def test_retry_keeps_every_id_once(spark):
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "id string")
    schema = "id string, status string, payload string"
    first = spark.createDataFrame(
        [("a", "ok", "1"), ("b", "failed", None), ("c", "failed", None)], schema
    )
    second = spark.createDataFrame([("b", "ok", "2"), ("c", "failed", None)], schema)
    rows = fetch.fetch_with_retry(asked, first, second).collect()
    assert sorted((r["id"], r["attempt"], r["status"], r["payload"]) for r in rows) == [
        ("a", 1, "ok", "1"), ("b", 2, "ok", "2"), ("c", 2, "failed", None),
    ]


def test_an_id_given_twice_comes_out_once(spark):
    schema = "id string, status string, payload string"
    asked = spark.createDataFrame([("a",)], "id string")
    twice = spark.createDataFrame([("a", "ok", "2"), ("a", "ok", "1"), ("x", "ok", "3")], schema)
    done = fetch.fetch_with_retry(asked, twice, twice)
    assert [tuple(r) for r in done.collect()] == [("a", "1", 1, "ok")]


def test_trash_requests_belong_to_one_mailbox(spark):
    scored = spark.createDataFrame(
        [(f"{i:03}", i % 3, 0) for i in range(200)], "id string, mailbox bigint, important int"
    )
    plan = triage.trash_plan(scored).collect()
    assert all(len(r["ids"]) <= 50 for r in plan)
    assert all({int(i) % 3 for i in r["ids"]} == {r["mailbox"]} for r in plan)
    assert sum(len(r["ids"]) for r in plan) == 200


def test_caps_are_asked_for(spark):
    df = spark.createDataFrame([(f"{i}", 1, ["TRASH"]) for i in range(700)],
                               "id string, label int, labels array<string>")
    assert fetch.list_by_label(df, "label", (1, 0)).count() == 700
    assert fetch.list_by_label(df, "label", (1, 0), 10).count() == 10
    assert fetch.list_trash(df).count() == 700


def test_day_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.sql("SELECT '1' AS id, timestamp'2024-01-03 00:00:00' AS received_at").write.parquet(path)
    df = fetch.list_ids(spark.read.parquet(path), dt.date(2024, 1, 4), 1)
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Equal(received_at,2024-01-03" in plan and "LessThan(received" in plan
    assert fetch.list_ids(spark.read.parquet(path), dt.date(2024, 1, 3), 1).count() == 0


STATE = "id string, mailbox bigint, received_at timestamp, labels array<string>, trashed_at timestamp"


def mailbox(spark, run_start):
    old = run_start - dt.timedelta(days=8)
    return spark.createDataFrame(
        [
            ("old", 1, old, ["TRASH"], old),
            ("kept", 1, old, ["INBOX"], None),
            ("fresh", 1, old, ["INBOX"], None),
        ],
        STATE,
    )


def test_purge_spares_what_this_run_trashed(spark):
    start = dt.datetime(2024, 2, 1)
    at = F.lit(start).cast("timestamp")
    plan = spark.createDataFrame([(0, ["fresh"])], "chunk_id bigint, ids array<string>")
    moved = triage.move_to_trash(mailbox(spark, start), plan, at)
    old = triage.purge_candidates(moved, start)
    assert [r["ids"] for r in triage.purge_plan(old).collect()] == [["old"]]
    kept, audit = triage.purge(moved, old, at)
    assert {r["id"]: r["labels"] for r in kept.collect()} == {
        "kept": ["INBOX"], "fresh": ["INBOX", "TRASH"],
    }
    assert [r["id"] for r in audit.collect()] == ["old"]
    assert triage.purge_candidates(moved, start, triage.MANUAL).count() == 0


def test_labels_can_be_removed(spark):
    state = mailbox(spark, dt.datetime(2024, 2, 1))
    back = triage.apply_labels(
        state, state.select("id"), F.current_timestamp(), add=("INBOX",), remove=("TRASH",)
    )
    for r in back.collect():
        assert r["labels"] == ["INBOX"] and r["trashed_at"] is None


def test_attempts(spark):
    plan = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")

    def tried(**status):
        return spark.createDataFrame(list(status.items()), "id string, status string")

    rows = triage.attempt_outcomes(
        plan, tried(a="ok", b="failed", c="failed", d="failed"), tried(b="ok", c="failed"),
        tried(c="ok"),
    ).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("a", 1, "ok"), ("b", 2, "ok"), ("c", 3, "ok"), ("d", 3, "failed"),
    ]


def test_confident_and_rest_make_the_whole(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 0.05, 0.5, 0.95, 1.0, None)], "p double")
    sure, rest = triage.confident(df), triage.not_confident(df)
    assert sure.count() + rest.count() == 6
    assert None in [r["p"] for r in rest.collect()]


def test_confusion_and_recall(spark):
    schema = "label int, predicted int"
    df = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (0, 1)], schema)
    cells = sorted(tuple(r) for r in learn.confusion_matrix(df).collect())
    assert cells == [(0, 0, 1), (1, 1, 2)]
    assert learn.recall(df).first()[0] == pytest.approx(2 / 3)
    assert learn.precision(df).first()[0] == pytest.approx(2 / 3)
    assert learn.recall(spark.createDataFrame([(0, 1)], schema)).first()[0] == 0.0


def test_masked_mean(spark):
    df = spark.createDataFrame(
        [("a", [1.0, 2.0], 1), ("a", [3.0, 4.0], 1), ("a", [9.0, 9.0], 0), ("b", [5.0, 5.0], 0)],
        "id string, v array<double>, m int",
    )
    rows = features.masked_mean(df, "id", "v", "m", 2).collect()
    assert {r["id"]: r["pooled"] for r in rows} == {"a": [2.0, 3.0], "b": [0.0, 0.0]}


@pytest.mark.parametrize("hash_name", ["md5", "xxhash64"])
def test_embedding(spark, hash_name):
    encoder = features.HashingEncoder(dim=16, hash_name=hash_name)
    df = spark.createDataFrame(
        [("a", "hello", "some body text"), ("b", "hello", "other words"), ("c", "x", "")],
        "id string, subject string, body string",
    )
    got = {r["id"]: np.array(r["features"]) for r in features.embed(df, encoder=encoder).collect()}
    for v in got.values():
        assert len(v) == 32
        assert np.linalg.norm(v[:16]) == pytest.approx(1)
    assert (got["a"][:16] == got["b"][:16]).all()
    assert features.embed(df.limit(0), encoder=encoder).count() == 0


def test_embedding_does_not_shuffle(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.sql("SELECT '1' AS id, 's' AS subject, 'b' AS body").write.parquet(path)
    plan = features.embed(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_reports(spark):
    df = spark.createDataFrame([("s", "b"), ("s", None)], "subject string, body string")
    report = quality.request_report(df).first()
    assert (report["rows"], report["subjects"], report["bodies"], report["valid"]) == (
        2, 2, 1, False,
    )
    assert not quality.request_report(df.limit(0)).first()["valid"]
    with pytest.raises(Exception, match="equal length"):
        quality.require_request(df).collect()
    assert quality.require_request(df.limit(1)).count() == 1
    assert quality.nothing_to_do(df.limit(0)) and not quality.nothing_to_do(df)


MULTI = (
    b"From: a@b.c\r\nMIME-Version: 1.0\r\nContent-Type: multipart/mixed; boundary=x\r\n\r\n"
    b"--x\r\nContent-Type: text/plain\r\nContent-Disposition: attachment; filename=f\r\n\r\nno\r\n"
    b"--x\r\nContent-Type: text/plain; charset=latin-1\r\n\r\ncaf\xe9\r\n--x--\r\n"
)


def test_raw_mail(spark):
    envelope = "struct<name: string, mailbox: string, host: string>"
    rows = [
        (1, bytearray(MULTI), ("N", "a", "b.c")),
        (2, bytearray(b"Content-Type: text/plain; charset=utf-8\r\n\r\nplain"), (None, "a", None)),
        (3, bytearray(b"Content-Type: text/plain; charset=odd-name\r\n\r\nplain"), None),
        (4, None, None),
    ]
    df = spark.createDataFrame(rows, f"uid bigint, rfc822 binary, envelope {envelope}")
    got = {r["uid"]: r for r in rawmail.parse_raw_mail(df).collect()}
    assert (got[1]["body"], got[1]["has_attachments"]) == ("café", True)
    assert (got[1]["sender_name"], got[1]["sender_address"]) == ("N", "a@b.c")
    assert (got[2]["body"], got[2]["sender_address"]) == ("plain", None)
    assert got[3]["body"] == "plain"
    assert got[4]["body"] is None


def test_split_is_stable(spark, tiny):
    messages = staging.messages(spark, tiny)
    train, test = learn.split(messages.repartition(64))
    again = learn.split(messages.coalesce(1))[1]
    assert train.count() + test.count() == messages.count()
    assert {r["id"] for r in test.collect()} == {r["id"] for r in again.collect()}


def toy(spark, n=200):
    return spark.range(n).select(
        F.format_string("%05d", "id").alias("id"),
        F.array(
            (F.col("id") % 2).cast("double"), (F.xxhash64("id") % 100 / 100.0).cast("double")
        ).alias("features"),
        (F.col("id") % 2).cast("int").alias("label"),
    )


def test_training_is_deterministic_and_useful(spark, tmp_path):
    params = learn.BoostParams(rounds=5, max_depth=2)
    data = toy(spark)
    a, b = learn.fit(data, params), learn.fit(data, params)
    pa = {r["id"]: r["p"] for r in learn.predict(a, data).collect()}
    assert pa == {r["id"]: r["p"] for r in learn.predict(b, data).collect()}
    assert learn.evaluate(a, data)[1].first()[0] == 1.0
    path = str(tmp_path / "model")
    learn.save_model(a, path)
    loaded = learn.load_model(path)
    assert pa == {r["id"]: r["p"] for r in learn.predict(loaded, data).collect()}
    with pytest.raises(ValueError):
        learn.load_model(path, features.HashingEncoder(dim=32))


def test_self_training_moves_each_row_once(spark):
    params = learn.BoostParams(rounds=8, max_depth=2, eta=0.5)
    data = toy(spark)
    known, others = data.where("id < '00100'"), data.where("id >= '00100'").drop("label")
    result = learn.self_train(known, others, params, max_rounds=3, cut=0.8)
    assert result.labelled.count() == 200 and result.remaining.count() == 0
    assert result.labelled.select("id").distinct().count() == 200
    assert [tuple(r) for r in result.rounds.collect()] == [(1, 100, 200, 0)]
    wrong = result.labelled.join(data.withColumnRenamed("label", "truth"), "id")
    assert wrong.where("label <> truth").count() == 0


def test_self_training_without_confident_rows(spark):
    params = learn.BoostParams(rounds=1, max_depth=1, eta=0.01)
    data = toy(spark, 40)
    result = learn.self_train(data, data.drop("label"), params, cut=0.9999999)
    assert result.rounds.count() == 0 and result.labelled.count() == 40


def test_score_one(spark):
    encoder = features.HashingEncoder(dim=4)
    texts = spark.createDataFrame(
        [(f"{i}", "sale now" if i % 2 else "meeting", "buy" if i % 2 else "agenda", i % 2 == 0)
         for i in range(40)],
        "id string, subject string, body string, good boolean",
    )
    known = features.embed(texts, encoder=encoder).select(
        "id", "features", F.col("good").cast("int").alias("label")
    )
    model = learn.fit(known, learn.BoostParams(rounds=5, max_depth=2))
    assert learn.score_one(spark, "meeting", "agenda", model, encoder).first()["important"] == 1
    assert learn.score_one(spark, "sale now", "buy", model, encoder).first()["important"] == 0


def test_tokens(spark):
    df = spark.createDataFrame([("a b c",), ("a",)], "x string")
    assert [r[0] for r in df.select(text.tokens(F.col("x"), 2)).collect()] == [["a", "b"], ["a"]]
