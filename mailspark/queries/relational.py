"""Projections, filters, joins, aggregates, sets and samples."""

from pyspark.sql import functions as F

from mailspark import staging
from mailspark.functions import scoring
from mailspark.operators import chunks, fetch, learn, mime, quality, triage
from mailspark.queries.base import bucket, cleaned, query, received_us, using, with_defaults

_SUBJECT, _BODY = with_defaults("subject", cleaned("body"))


def _scores(spark, sf):
    return staging.scores(staging.messages(spark, sf))


def _judged(spark, sf):
    """Labelled messages with the stand-in probability."""
    labels = staging.labels(spark, sf)
    return labels.join(_scores(spark, sf), "id")


@query("prj01_payload_only", using("messages", "SELECT body AS payload FROM messages"))
def payload_only(spark, sf):
    fetched = staging.messages(spark, sf).select("id", F.col("body").alias("payload"))
    return fetched.select("payload")


@query("prj02_expand_payload", using(
    "messages",
    f"""SELECT epoch_us(received_at) AS received_us, {_SUBJECT} AS subject, {_BODY} AS body
        FROM messages"""))
def expand_payload(spark, sf):
    decoded = mime.decode_payload(staging.payloads(spark, sf).select("id", "payload"))
    return decoded.select(received_us(), "subject", "body")


@query("prj03_model_input", using("messages", "SELECT subject, body FROM messages"))
def model_input(spark, sf):
    return staging.messages(spark, sf).drop("id", "received_at", "mime_type", "lang", "source")


@query("prj04_landing_columns", using(
    "messages",
    "SELECT id, epoch_us(received_at) AS received_us, subject, body AS payload FROM messages"))
def landing_columns(spark, sf):
    decoded = staging.messages(spark, sf).withColumnRenamed("body", "payload")
    return decoded.select("id", received_us(), "subject", "payload")


@query("prj05_constant_label", using(
    "messages labelset",
    "SELECT id, label::bigint AS label FROM messages JOIN labelset USING (id)"))
def constant_label(spark, sf):
    label = F.when(F.col("label") == 1, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    return staging.labelled(spark, sf).select("id", label.alias("label"))


@query("flt01_unimportant", using(
    "messages scores", "SELECT id FROM scores WHERE p <= 0.35::double"))
def unimportant(spark, sf):
    scored = _scores(spark, sf).withColumn("important", scoring.threshold(F.col("p")))
    return triage.unimportant(scored).select("id")


@query("flt02_confident", using(
    "messages scores", "SELECT id, p FROM scores WHERE p > 0.95::double OR p < 1 - 0.95::double"))
def confident(spark, sf):
    return triage.confident(_scores(spark, sf))


@query("flt03_not_confident", using(
    "messages scores",
    "SELECT id, p FROM scores WHERE NOT (p > 0.95::double OR p < 1 - 0.95::double)"))
def not_confident(spark, sf):
    return triage.not_confident(_scores(spark, sf))


@query("flt04_empty_gate", using("messages", "SELECT id FROM messages"))
def empty_gate(spark, sf):
    ids = staging.messages(spark, sf).select("id")
    return ids.limit(0) if quality.nothing_to_do(ids) else ids


@query("flt06_request_check", using(
    "messages",
    """SELECT count(*) AS rows, count(subject) AS subjects,
              count(CASE WHEN source <> 'src0' THEN body END) AS bodies,
              count(*) > 0 AND count(subject) = count(*)
              AND count(CASE WHEN source <> 'src0' THEN body END) = count(*) AS valid
       FROM messages"""))
def request_check(spark, sf):
    asked = staging.messages(spark, sf).withColumn(
        "body", F.when(F.col("source") != "src0", F.col("body"))
    )
    return quality.request_report(asked)


@query("jon01_pair_predictions", using(
    "messages scores", "SELECT id, (p > 0.35::double)::bigint AS important FROM scores"))
def pair_predictions(spark, sf):
    predicted = _scores(spark, sf).select(
        "id", scoring.threshold(F.col("p")).cast("bigint").alias("important")
    )
    return triage.pair_predictions(staging.messages(spark, sf).select("id"), predicted)


@query("jon02_restrict_by_ids", using(
    "messages labelset", "SELECT id, subject FROM messages WHERE id IN (SELECT id FROM labelset)"))
def restrict_by_ids(spark, sf):
    messages = staging.messages(spark, sf).select("id", "subject")
    return fetch.restrict(messages, staging.labels(spark, sf))


@query("agg01_run_counts", using(
    "outcomes",
    """SELECT count(*) AS rows, count(CASE WHEN status = 'ok' THEN 1 END) AS fetched,
              count(CASE WHEN status <> 'ok' THEN 1 END) AS failed,
              count(CASE WHEN value < 35 THEN 1 END) AS to_trash FROM outcomes"""))
def run_counts(spark, sf):
    return quality.run_counts(
        staging.fetch_outcomes(spark, sf),
        fetched=F.col("status") == "ok",
        failed=F.col("status") != "ok",
        to_trash=F.col("value") < 35,
    )


@query("agg02_null_counts", using(
    "state",
    """SELECT count(*) - count(id) AS id, count(*) - count(mailbox) AS mailbox,
              count(*) - count(received_at) AS received_at, count(*) - count(labels) AS labels,
              count(*) - count(trashed_at) AS trashed_at,
              count(*) - count(event_type) AS event_type, count(*) - count(value) AS value
       FROM state"""))
def null_counts(spark, sf):
    return quality.null_counts(staging.mailbox_state(spark, sf))


@query("agg03_confident_count", using(
    "messages scores",
    """SELECT count(*) AS rows,
              count(CASE WHEN p > 0.95::double OR p < 1 - 0.95::double THEN 1 END) AS confident
       FROM scores"""))
def confident_count(spark, sf):
    return quality.run_counts(
        _scores(spark, sf), confident=scoring.is_confident(F.col("p"))
    )


@query("agg04_confusion_matrix", using(
    "messages labelset scores",
    """SELECT a.actual::bigint AS actual,
              count(CASE WHEN p < 0.5 THEN 1 END) AS predicted_0,
              count(CASE WHEN p >= 0.5 THEN 1 END) AS predicted_1
       FROM (VALUES (0), (1)) a(actual)
       LEFT JOIN (SELECT label, p FROM labelset JOIN scores USING (id)) j ON j.label = a.actual
       GROUP BY 1"""))
def confusion_matrix(spark, sf):
    judged = _judged(spark, sf).withColumn(
        "predicted", scoring.threshold(F.col("p"), scoring.EVEN_THRESHOLD, strict=False)
    )
    matrix = learn.confusion_matrix(judged)
    return matrix.withColumn("actual", F.col("actual").cast("bigint"))


@query("agg05_recall", using(
    "messages labelset scores",
    """SELECT round(coalesce(count(CASE WHEN label = 1 AND p >= 0.5 THEN 1 END)::double
              / nullif(count(CASE WHEN label = 1 THEN 1 END), 0), 0), 6) AS recall
       FROM labelset JOIN scores USING (id)"""))
def recall(spark, sf):
    judged = _judged(spark, sf).withColumn(
        "predicted", scoring.threshold(F.col("p"), scoring.EVEN_THRESHOLD, strict=False)
    )
    return learn.recall(judged).select(F.round("recall", 6).alias("recall"))


@query("agg08_label_counts", using(
    "labelset", "SELECT label::bigint AS label, count(*) AS n FROM labelset GROUP BY 1"))
def label_counts(spark, sf):
    return (
        staging.labels(spark, sf)
        .groupBy(F.col("label").cast("bigint").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("smp01_hash_split", using(
    "messages",
    f"""SELECT id, CASE WHEN {bucket('id', 100)} < 25 THEN 'test' ELSE 'train' END AS side
        FROM messages"""))
def hash_split(spark, sf):
    train, test = learn.split(staging.messages(spark, sf).select("id"))
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


@query("set01_union_labelled", using(
    "messages labelset",
    "SELECT id, subject, label::bigint AS label FROM messages JOIN labelset USING (id)"))
def union_labelled(spark, sf):
    known = staging.labelled(spark, sf).select(
        "id", "subject", F.col("label").cast("bigint").alias("label")
    )
    return known.where(F.col("label").isin(0, 1))


@query("set02_add_pseudo_labels", using(
    "messages labelset scores",
    """SELECT id, label::bigint AS label FROM labelset UNION ALL
       SELECT id, (p > 0.5)::bigint FROM scores
       WHERE (p > 0.95::double OR p < 1 - 0.95::double)
         AND id NOT IN (SELECT id FROM labelset)"""))
def add_pseudo_labels(spark, sf):
    labels = staging.labels(spark, sf).select("id", F.col("label").cast("bigint").alias("label"))
    unlabelled = staging.scores(staging.unlabelled(spark, sf))
    pseudo = triage.confident(unlabelled).select(
        "id", scoring.threshold(F.col("p"), scoring.EVEN_THRESHOLD).cast("bigint").alias("label")
    )
    return labels.unionByName(pseudo)


@query("set03_remove_moved", using(
    "messages labelset scores",
    """SELECT id FROM scores WHERE NOT (p > 0.95::double OR p < 1 - 0.95::double)
       AND id NOT IN (SELECT id FROM labelset)"""))
def remove_moved(spark, sf):
    unlabelled = staging.scores(staging.unlabelled(spark, sf))
    return triage.not_confident(unlabelled).select("id")


@query("set04_flatten_chunks", using("messages", "SELECT id FROM messages"))
def flatten_chunks(spark, sf):
    ids = staging.messages(spark, sf).select("id")
    return chunks.explode_ids(chunks.chunk_arrays(ids, fetch.FETCH_CHUNK)).select("id")
