"""Scalar functions and payload decode."""

from pyspark.sql import functions as F

from mailspark import staging
from mailspark.functions import dates, headers, html, scoring, text, vectors
from mailspark.operators import mime, rawmail
from mailspark.queries.base import (
    allowed, cleaned, no_urls, page_text, query, received_us, squeezed, using, with_defaults,
)

C = F.col


@query("fn01_base64url_decode", using("messages", "SELECT id, body FROM messages"))
def base64url_decode(spark, sf):
    sent = staging.messages(spark, sf).withColumn("data", text.text_to_base64url(C("body")))
    return sent.select("id", text.base64url_to_text(C("data")).alias("body"))


@query("fn02_utf8_ignore", using("messages", "SELECT id, body FROM messages"))
def utf8_ignore(spark, sf):
    broken = F.concat(F.unhex(F.lit("FF")), C("body").cast("binary"), F.unhex(F.lit("C3")))
    return staging.messages(spark, sf).select("id", text.utf8_ignore(broken).alias("body"))


@query("fn03_html_text",
       f"SELECT page_id, {page_text('html')} AS text FROM pages")
def html_text(spark, sf):
    pages = staging.table(spark, sf, "pages")
    return html.with_html_text(pages, "html", "text").select("page_id", "text")


@query("fn03_html_text_native",
       f"SELECT page_id, {page_text('html')} AS text FROM pages")
def html_text_native(spark, sf):
    pages = staging.table(spark, sf, "pages")
    return pages.select("page_id", html.strip_html(C("html")).alias("text"))


@query("fn04_remove_urls",
       f"""SELECT page_id, {no_urls("'see ' || url || ' or www.' || url || ' now'")} AS text
           FROM pages""")
def remove_urls(spark, sf):
    linked = F.concat(F.lit("see "), C("url"), F.lit(" or www."), C("url"), F.lit(" now"))
    return staging.table(spark, sf, "pages").select(
        "page_id", text.remove_urls(linked).alias("text")
    )


@query("fn05_keep_allowed", using(
    "messages", f"SELECT id, {allowed('body')} AS body FROM messages"))
def keep_allowed(spark, sf):
    return staging.messages(spark, sf).select("id", text.keep_allowed(C("body")).alias("body"))


@query("fn06_squeeze", using(
    "messages", f"SELECT id, {squeezed(allowed('body'))} AS body FROM messages"))
def squeeze(spark, sf):
    return staging.messages(spark, sf).select(
        "id", text.squeeze(text.keep_allowed(C("body"))).alias("body")
    )


@query("fn07_clean_text", using(
    "messages", f"SELECT id, {cleaned('body')} AS body FROM messages"))
def clean_text(spark, sf):
    return staging.messages(spark, sf).select("id", text.clean_text(C("body")).alias("body"))


@query("fn07_clean_text_turns",
       f"SELECT conv_id, turn, {cleaned('text')} AS text FROM conversations")
def clean_text_turns(spark, sf):
    return staging.table(spark, sf, "conversations").select(
        "conv_id", "turn", text.clean_text(C("text")).alias("text")
    )


@query("fn08_header_pick", using(
    "messages",
    """SELECT id, CASE WHEN lang = 'en' THEN subject ELSE 'later' END AS subject,
              strftime(received_at, '%Y-%m-%d') AS sent FROM messages"""))
def header_pick(spark, sf):
    def header(name, value):
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    src = staging.messages(spark, sf)
    sent = header("Date", F.date_format("received_at", "yyyy-MM-dd"))
    first, later = header("Subject", C("subject")), header("Subject", F.lit("later"))
    stray = header("subject", F.lit("other case"))
    found = headers.pick_headers(
        F.when(C("lang") == "en", F.array(stray, first, sent, later)).otherwise(
            F.array(first, later, sent, header("Date", F.lit("never")))
        )
    )
    return src.withColumn("h", found).select(
        "id", C("h.subject").alias("subject"), C("h.date").alias("sent")
    )


@query("fn09_mail_date", using(
    "messages",
    """SELECT id, epoch_us(CASE WHEN lang = 'en' THEN received_at + interval 330 minute
              WHEN lang = 'de' THEN received_at + interval 5 hour ELSE received_at END)
              AS received_us FROM messages"""))
def mail_date(spark, sf):
    at = C("received_at")
    written = (
        F.when(C("lang") == "en", F.date_format(at, "EEE,d MMM yyyy HH:mm:ss '-0530'"))
        .when(C("lang") == "de", F.date_format(at, "d MMM yyyy HH:mm 'EST'"))
        .when(C("lang") == "fr", F.date_format(at, "EEEE, dd-MMM-yy HH:mm:ss 'GMT'"))
        .when(C("source") == "src1", F.date_format(at, "dd-MMM-yyyy HH:mm:ss '+0000'"))
        .otherwise(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss '+0000 (UTC)'"))
    )
    parsed = dates.parse_mail_date(written)
    return staging.messages(spark, sf).withColumn("received_at", parsed).select("id", received_us())


_RAW_SUBJECT = "CASE WHEN lang = 'en' THEN subject WHEN lang = 'de' THEN '' END"
_RAW_BODY = "CASE WHEN source <> 'src0' THEN body ELSE '' END"
_SUBJECT, _BODY = with_defaults(_RAW_SUBJECT, _RAW_BODY)


def _gaps(spark, sf):
    return staging.messages(spark, sf).select(
        "id",
        F.when(C("lang") == "en", C("subject")).when(C("lang") == "de", "").alias("subject"),
        F.when(C("source") != "src0", C("body")).otherwise("").alias("body"),
    )


@query("fn10_subject_default", using("messages", f"SELECT id, {_SUBJECT} AS subject FROM messages"))
def subject_default(spark, sf):
    return _gaps(spark, sf).select("id", text.default_subject(C("subject")).alias("subject"))


@query("fn11_body_default", using("messages", f"SELECT id, {_BODY} AS body FROM messages"))
def body_default(spark, sf):
    filled = _gaps(spark, sf).withColumn("subject", text.default_subject(C("subject")))
    return filled.select("id", text.default_body(C("body"), C("subject")).alias("body"))


def _document(mime_type, parts=None, data="body"):
    fields = [
        mime_type.alias("mimeType"),
        F.struct(text.text_to_base64url(C(data)).alias("data")).alias("body"),
        F.array(F.struct(F.lit("Subject").alias("name"), C("subject").alias("value"))).alias(
            "headers"
        ),
    ]
    return F.to_json(F.struct(*fields, *([parts.alias("parts")] if parts is not None else [])))


_S, _PLAIN = with_defaults("subject", cleaned("body"))
_, _PAGE = with_defaults("subject", cleaned(page_text("body")))
_, _OTHER = with_defaults("subject", "body")


@query("fn12_mime_dispatch", using(
    "messages",
    f"""SELECT id, CASE WHEN lang = 'en' THEN {_PLAIN} WHEN lang = 'de' THEN {_PAGE}
               ELSE {_OTHER} END AS body FROM messages"""))
def mime_dispatch(spark, sf):
    kind = (
        F.when(C("lang") == "en", "text/plain")
        .when(C("lang") == "de", "text/html")
        .otherwise("text/calendar")
    )
    sent = staging.messages(spark, sf).select("id", _document(kind).alias("payload"))
    return mime.decode_payload(sent).select("id", "body")


@query("fn13_part_choice", using(
    "messages",
    f"SELECT id, {with_defaults('NULL', cleaned('body'))[1]} AS body FROM messages"))
def part_choice(spark, sf):
    def part(kind, content):
        return F.struct(
            F.lit(kind).alias("mimeType"),
            F.struct(text.text_to_base64url(content).alias("data")).alias("body"),
        )

    page = F.concat(F.lit("<p>"), F.replace(F.replace(F.replace(
        C("body"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
        F.lit(">"), F.lit("&gt;")), F.lit("</p>"))
    parts = F.when(
        C("lang") == "en", F.array(part("text/plain", F.lit("first")), part("text/plain", C("body")))
    ).otherwise(F.array(part("text/html", page), part("text/plain", F.lit("plain loses"))))
    sent = staging.messages(spark, sf).select(
        "id", _document(F.lit("multipart/alternative"), parts, "subject").alias("payload"),
        C("subject").alias("own"),
    )
    # a container without data of its own is not opened in strict mode
    return mime.decode_payload(sent.withColumn(
        "payload", F.when(C("own") == "", F.replace("payload", F.lit('"data":""'),
                                                    F.lit('"data":"eA"'))).otherwise(C("payload"))
    ), mode="strict").select("id", "body")


@query("fn13_deep_part_choice", using(
    "messages",
    f"SELECT id, {with_defaults('NULL', cleaned('body'))[1]} AS body FROM messages"))
def deep_part_choice(spark, sf):
    """Six levels of parts, all followed by the strict rule."""
    below = F.struct(
        F.lit("text/plain").alias("mimeType"),
        F.struct(text.text_to_base64url(C("body")).alias("data")).alias("body"),
    )
    for level in range(6):
        below = F.struct(
            F.lit(f"multipart/plain-{level}").alias("mimeType"),
            F.struct(F.lit("eA").alias("data")).alias("body"),
            F.array(below).alias("parts"),
        )
    sent = staging.messages(spark, sf).select("id", F.to_json(below).alias("payload"))
    return mime.decode_payload(sent, mode="strict").select("id", "body")


@query("fn24_payload_attachments", using(
    "messages", "SELECT id, lang = 'en' AS has_attachment FROM messages"))
def payload_attachments(spark, sf):
    def header(name, value):
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    kind = F.when(C("lang") == "en", 'attachment; filename="a.txt"').otherwise("inline")
    part = F.struct(
        F.lit("text/plain").alias("mimeType"),
        F.array(header("Content-Disposition", kind)).alias("headers"),
    )
    document = F.struct(
        F.lit("multipart/mixed").alias("mimeType"),
        F.array(header("Subject", C("subject")), header("X", F.lit('"value":"attachment'))).alias(
            "headers"
        ),
        F.array(F.struct(F.array(part).alias("parts"))).alias("parts"),
    )
    sent = staging.messages(spark, sf).select("id", F.to_json(document).alias("payload"))
    return sent.select("id", mime.has_attachment(C("payload")).alias("has_attachment"))


@query("fn14_decode_payload", using(
    "messages",
    f"""SELECT id, epoch_us(received_at) AS received_us, {_S} AS subject, {_PLAIN} AS body,
               NULL::varchar AS decode_note FROM messages"""))
def decode_payload(spark, sf):
    decoded = mime.decode_payload(staging.payloads(spark, sf).select("id", "payload"))
    return decoded.select("id", received_us(), "subject", "body", "decode_note")


@query("fn14_decode_payload_strict", using(
    "messages",
    f"""SELECT id, {_S} AS subject, CASE WHEN lang IN ('en', 'de') THEN {_PLAIN}
               ELSE {with_defaults('subject', 'NULL')[1]} END AS body FROM messages"""))
def decode_payload_strict(spark, sf):
    sent = staging.payloads(spark, sf).select("id", "payload")
    return mime.decode_payload(sent, mode="strict").select("id", "subject", "body")


@query("fn15_fill_body", using(
    "messages",
    """SELECT id, CASE WHEN source <> 'src0' THEN body ELSE repeat(subject, 10) END AS body
       FROM messages"""))
def fill_body(spark, sf):
    gaps = F.when(C("source") != "src0", C("body"))
    return staging.messages(spark, sf).select(
        "id", text.body_or_subject(gaps, C("subject")).alias("body")
    )


@query("fn17_run_stamp", using(
    "messages",
    """SELECT id, strftime(received_at, '%d-%m-%Y-%H-%M-%S') AS stamp,
              strftime(received_at, '%d-%m-%Y-%H-%M') AS short_stamp FROM messages"""))
def run_stamp(spark, sf):
    at = C("received_at")
    return staging.messages(spark, sf).select(
        "id", dates.run_stamp(at).alias("stamp"), dates.run_stamp(at, False).alias("short_stamp")
    )


_UNIT = """list_transform(embedding, lambda x: x::double * (label + 1)
           / greatest(sqrt(list_sum(list_transform(embedding,
             lambda y: (y::double * (label + 1)) * (y::double * (label + 1))))), 1e-12))"""


def _stretched(spark, sf):
    """Embeddings of another length than one."""
    return staging.table(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * (C("label") + 1)).alias("v")
    )


@query("fn18_l2_normalise",
       f"""SELECT vec_id, i::bigint AS i, round(v[i], 6) + 0.0 AS value FROM (
             SELECT vec_id, {_UNIT} AS v FROM embeddings), range(1, 65) r(i)""")
def l2_normalise(spark, sf):
    unit = _stretched(spark, sf).select(
        "vec_id", F.posexplode(vectors.l2_normalise(C("v"))).alias("i", "value")
    )
    return unit.select(
        "vec_id", (C("i") + 1).cast("bigint").alias("i"),
        (F.round("value", 6) + F.lit(0.0)).alias("value"),
    )


@query("fn19_concat_vectors",
       """SELECT vec_id, len(v)::bigint AS dim, round(v[64]::double, 6) AS last_of_first,
                 round(v[65]::double, 6) AS first_of_second
          FROM (SELECT vec_id, list_concat(embedding, list_reverse(embedding)) AS v
                FROM embeddings)""")
def concat_vectors(spark, sf):
    both = staging.table(spark, sf, "embeddings").select(
        "vec_id", F.concat("embedding", F.reverse("embedding")).alias("v")
    )
    return both.select(
        "vec_id", F.size("v").cast("bigint").alias("dim"),
        F.round(F.get("v", F.lit(63)).cast("double"), 6).alias("last_of_first"),
        F.round(F.get("v", F.lit(64)).cast("double"), 6).alias("first_of_second"),
    )


@query("fn20_truncate_tokens", using(
    "messages",
    f"""SELECT id, array_to_string(list_slice(t, 1, 20), ' ') AS head,
               least(len(t), 512)::bigint AS tokens
        FROM (SELECT id, string_split({cleaned('body')}, ' ') AS t FROM messages)"""))
def truncate_tokens(spark, sf):
    clean = staging.messages(spark, sf).select("id", text.clean_text(C("body")).alias("body"))
    return clean.select(
        "id", F.array_join(text.tokens(C("body"), 20), " ").alias("head"),
        F.size(text.tokens(C("body"), 512)).cast("bigint").alias("tokens"),
    )


@query("fn21_thresholds", using(
    "messages scores",
    """SELECT id, (p > 0.35::double)::bigint AS serving, (p > 0.5::double)::bigint AS tuning,
              (p >= 0.5::double)::bigint AS final FROM scores"""))
def thresholds(spark, sf):
    p = C("p")
    return staging.scores(staging.messages(spark, sf)).select(
        "id",
        scoring.threshold(p).cast("bigint").alias("serving"),
        scoring.threshold(p, scoring.EVEN_THRESHOLD).cast("bigint").alias("tuning"),
        scoring.threshold(p, scoring.EVEN_THRESHOLD, strict=False).cast("bigint").alias("final"),
    )


@query("fn22_payload_round_trip", using(
    "messages", "SELECT id, subject, body FROM messages"))
def payload_round_trip(spark, sf):
    packed = staging.messages(spark, sf).select(
        "id", F.to_json(F.struct("subject", "body")).alias("payload")
    )
    document = F.parse_json("payload")
    return packed.select(
        "id",
        F.try_variant_get(document, "$.subject", "string").alias("subject"),
        F.try_variant_get(document, "$.body", "string").alias("body"),
    )


@query("fn23_sender_split", using(
    "messages",
    """SELECT id, CASE WHEN lang = 'en' THEN 'Reader, ' || source END AS name,
              CASE WHEN source <> 'src0' THEN source || '@mail.example' END AS address,
              CASE WHEN lang = 'en' THEN 'Reader, ' || source END AS header_name,
              source || '@mail.example' AS header_address FROM messages"""))
def sender_split(spark, sf):
    name = F.when(C("lang") == "en", F.concat(F.lit("Reader, "), C("source")))
    envelope = F.struct(
        name.alias("name"),
        F.when(C("source") != "src0", C("source")).alias("mailbox"),
        F.lit("mail.example").alias("host"),
    )
    box = F.concat(C("source"), F.lit("@mail.example"))
    header = F.when(
        C("lang") == "en", F.concat(F.lit('"'), name, F.lit('" <'), box, F.lit(">"))
    ).otherwise(box)
    split = staging.messages(spark, sf).select(
        "id",
        headers.sender_from_envelope(envelope).alias("e"),
        headers.sender_from_header(header).alias("h"),
    )
    return split.select(
        "id", C("e.name").alias("name"), C("e.address").alias("address"),
        C("h.name").alias("header_name"), C("h.address").alias("header_address"),
    )


@query("fn24_has_attachments", using(
    "messages",
    "SELECT cast(id AS bigint) AS uid, lang = 'en' AS has_attachments FROM messages"))
def has_attachments(spark, sf):
    return rawmail.parse_raw_mail(staging.raw_mail(spark, sf)).select("uid", "has_attachments")


@query("fn25_raw_body", using(
    "messages", "SELECT cast(id AS bigint) AS uid, body FROM messages"))
def raw_body(spark, sf):
    return rawmail.parse_raw_mail(staging.raw_mail(spark, sf)).select("uid", "body")
