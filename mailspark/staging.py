"""Mail-shaped views over the given tables: documents become messages, pages become
HTML mail, events become mailbox state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailspark.functions import text
from mailspark.session import pin_utc

START_EPOCH = 1704067200  # 2024-01-01 UTC
MINUTES_APART = 37


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mail_id(c: Column) -> Column:
    return F.lpad(c.cast("string"), 16, "0")


def received_at(c: Column) -> Column:
    return F.timestamp_seconds(F.lit(START_EPOCH) + c * F.lit(MINUTES_APART * 60))


def hash_percent(c: Column, buckets: int = 100) -> Column:
    """A stable bucket of the id, the same under every partitioning and engine."""
    head = F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        mail_id(F.col("doc_id")).alias("id"),
        received_at(F.col("doc_id")).alias("received_at"),
        F.split_part("text", F.lit("."), F.lit(1)).alias("subject"),
        F.col("text").alias("body"),
        F.lit("text/plain").alias("mime_type"),
        "lang",
        "source",
    )


def html_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        mail_id(F.col("page_id")).alias("id"),
        F.lit("text/html").alias("mime_type"),
        F.col("html").alias("body"),
        "url",
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        mail_id(F.col("doc_id")).alias("id"), F.col("quality").alias("label")
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).join(labels(spark, sf_dir), "id")


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).join(labels(spark, sf_dir), "id", "left_anti")


def scores(df: DataFrame) -> DataFrame:
    """A stand-in probability that depends on the id alone."""
    return df.select("id", (hash_percent(F.col("id"), 1000) / F.lit(1000.0)).alias("p"))


def mailbox_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    in_trash = F.col("event_type") == "signup"
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        mail_id(F.col("event_id")).alias("id"),
        F.col("user_id").alias("mailbox"),
        ts.alias("received_at"),
        F.when(in_trash, F.array(F.lit("TRASH")))
        .otherwise(F.array(F.lit("INBOX")))
        .alias("labels"),
        F.when(in_trash, ts).alias("trashed_at"),
        "event_type",
        "value",
    )


def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        mail_id(F.col("event_id")).alias("id"),
        F.when(F.col("event_type") == "error", "failed").otherwise("ok").alias("status"),
        F.col("props").alias("payload"),
        "value",
    )


def _headers(subject: Column, received: Column) -> Column:
    def header(name, value):
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    return F.array(
        header("From", F.lit("Sender <sender@mail.example>")),
        header("Subject", subject),
        header("Date", F.date_format(received, "EEE, dd MMM yyyy HH:mm:ss Z")),
    )


def _escaped_html(content: Column) -> Column:
    safe = F.replace(
        F.replace(F.replace(content, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
        F.lit(">"),
        F.lit("&gt;"),
    )
    return F.concat(
        F.lit("<html><head><style>p{}</style></head><body><nav>menu</nav><p>"),
        safe,
        F.lit("</p><footer>sent by mail</footer></body></html>"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as payload documents in four shapes, by language: plain, HTML, a
    plain/HTML alternative, and an alternative nested in a mixed container."""
    lang = F.col("lang")
    content = F.when(lang == "en", F.col("body")).otherwise(_escaped_html(F.col("body")))
    alternative = F.lit("multipart/alternative")

    def node(mime, data=None, parts=None, kind="string"):
        body = F.struct(data.alias("data")) if data is not None else F.lit(None)
        below = parts if parts is not None else F.lit(None)
        return F.struct(
            mime.alias("mimeType"),
            body.cast("struct<data: string>").alias("body"),
            below.cast(kind).alias("parts"),
        )

    leaf_parts = "array<struct<mimeType: string, body: struct<data: string>, parts: string>>"
    leaves = F.array(
        node(F.lit("text/plain"), text.text_to_base64url(F.lit("see the html part"))),
        node(F.lit("text/html"), F.col("_data")),
    )
    nodes = f"array<struct<mimeType: string, body: struct<data: string>, parts: {leaf_parts}>>"
    flat = F.transform(leaves, lambda x: node(x["mimeType"], x["body"]["data"], kind=leaf_parts))
    nested = F.array(node(alternative, parts=leaves, kind=leaf_parts))
    document = F.struct(
        F.when(lang == "en", "text/plain")
        .when(lang == "de", "text/html")
        .when(lang == "fr", alternative)
        .otherwise("multipart/mixed")
        .alias("mimeType"),
        F.when(lang.isin("en", "de"), F.struct(F.col("_data").alias("data"))).alias("body"),
        _headers(F.col("subject"), F.col("received_at")).alias("headers"),
        F.when(lang == "fr", flat.cast(nodes))
        .when(~lang.isin("en", "de"), nested.cast(nodes))
        .alias("parts"),
    )
    return (
        messages(spark, sf_dir)
        .withColumn("_data", text.text_to_base64url(content))
        .select("id", F.to_json(document).alias("payload"), "received_at", "subject")
    )


def raw_mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as RFC 822 bytes with an envelope; English ones carry an attachment."""
    src = messages(spark, sf_dir)
    eol = F.lit("\r\n")
    encoded = F.base64(F.col("body").cast("binary"))
    plain_part = F.concat(
        F.lit("Content-Type: text/plain; charset=utf-8"), eol,
        F.lit("Content-Transfer-Encoding: base64"), eol, eol, encoded, eol,
    )
    head = F.concat(
        F.lit("From: Reader <"), F.col("source"), F.lit("@mail.example>"), eol,
        F.lit("MIME-Version: 1.0"), eol,
    )
    single = F.concat(head, plain_part)
    multi = F.concat(
        head, F.lit('Content-Type: multipart/mixed; boundary="cut"'), eol, eol,
        F.lit("--cut"), eol,
        F.lit("Content-Type: text/plain; charset=utf-8"), eol,
        F.lit('Content-Disposition: attachment; filename="a.txt"'), eol, eol,
        F.lit("attached"), eol,
        F.lit("--cut"), eol, plain_part,
        F.lit("--cut--"), eol,
    )
    return src.select(
        F.col("id").cast("bigint").alias("uid"),
        F.when(F.col("lang") == "en", multi).otherwise(single).cast("binary").alias("rfc822"),
        F.struct(
            F.lit("Reader").alias("name"),
            F.when(F.col("source") != "src0", F.col("source")).alias("mailbox"),
            F.lit("mail.example").alias("host"),
        ).alias("envelope"),
        "received_at",
    )
