"""Payload decode: nested mail documents to (received_at, subject, body).

Everything stays inside the row, so decoding is part of the scan stage and never
shuffles a body. The document is parsed once into a schema of bounded depth; deeper
ones, and HTML a regex cannot judge, take an exact path of their own.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from mailspark.functions import dates, headers, html, text
from mailspark.functions.html import html_text  # by name: it travels to the workers
from mailspark.schemas import payload_ddl

MAX_DEPTH = 4
_LEAF = T.StructType([
    T.StructField("mime", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("deep", T.BooleanType()),
])

_TEXT = T.StructType([T.StructField("mime", T.StringType()), T.StructField("text", T.StringType())])


def _mentions(mime: Column, kind: str) -> Column:
    return F.coalesce(mime.contains(kind), F.lit(False))


@dataclass(frozen=True)
class _Node:
    """SQL text of the fields of a document node. The walks are nested lambdas, one level
    inside the other, and are written as text to be parsed in one go."""

    mime: str
    data: str
    headers: str
    parts: str

    @classmethod
    def of(cls, name: str) -> _Node:
        return cls(f"{name}.mimeType", f"{name}.body.data", f"{name}.headers", f"{name}.parts")

    @property
    def has_data(self) -> str:
        return f"coalesce({self.data} <> '', false)"

    @property
    def is_text(self) -> str:
        return f"coalesce({self.mime} IN ('text/plain', 'text/html'), false)"

    def is_kind(self, kind: str) -> str:
        return f"coalesce(contains({self.mime}, '{kind}'), false)"


_ROOT = _Node("_mime", "_content.data", "_headers", "_parts")


def _leaves(node: _Node, depth: int) -> str:
    """Nodes without parts, in document order, as array<struct(mime, data, deep)>."""

    def leaf(deep):
        return f"array(named_struct('mime', {node.mime}, 'data', {node.data}, 'deep', {deep}))"

    if depth == 0:
        return leaf(f"{node.parts} IS NOT NULL")
    part = f"p{depth}"
    return (
        f"CASE WHEN coalesce(size({node.parts}), 0) <= 0 OR ({node.is_text} AND {node.has_data}) "
        f"THEN {leaf('false')} ELSE flatten(transform({node.parts}, "
        f"{part} -> {_leaves(_Node.of(part), depth - 1)})) END"
    )


def _walk(document: str) -> Iterator[tuple[str | None, str | None]]:
    """(mime, data) of the nodes without parts, in document order, at any depth."""
    todo = [json.loads(document)]
    while todo:
        node = todo.pop() or {}
        mime, data = node.get("mimeType"), (node.get("body") or {}).get("data")
        parts = node.get("parts") or []
        if parts and not (data and mime in ("text/plain", "text/html")):
            todo.extend(reversed(parts))
        else:
            yield mime, data


@F.pandas_udf(T.ArrayType(_LEAF))
def _deep_leaves(documents: pd.Series) -> pd.Series:
    def leaves(document):
        return [{"mime": mime, "data": data, "deep": False} for mime, data in _walk(document)]

    return documents.map(leaves, na_action="ignore")


_PICKED = T.StructType([
    T.StructField("mime", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()), T.StructField("value", T.StringType()),
    ]))),
    T.StructField("deep", T.BooleanType()),
])


def _pick(document: str) -> dict:
    """What _strict_pick finds, at any depth."""
    node, blank = json.loads(document) or {}, False
    while True:
        mime, data = node.get("mimeType") or "", (node.get("body") or {}).get("data")
        parts = node.get("parts")
        if not data or mime in ("text/plain", "text/html") or parts is None:
            break
        kinds = [(p or {}).get("mimeType") or "" for p in parts]
        pages = [p for p, k in zip(parts, kinds) if "html" in k]
        plains = [p for p, k in zip(parts, kinds) if "plain" in k and "html" not in k]
        if not pages and not plains:
            blank = True
            break
        node = (pages or plains)[-1]
    headers_of = [
        {"name": h.get("name"), "value": h.get("value")} for h in node.get("headers") or []
    ]
    text_of = None if blank or not data else data
    return {
        "mime": node.get("mimeType"), "data": text_of, "headers": headers_of, "deep": False
    }


@F.pandas_udf(T.ArrayType(_PICKED))
def _deep_pick(documents: pd.Series) -> pd.Series:
    return documents.map(lambda document: [_pick(document)], na_action="ignore")


def _bytes_of(data: str) -> bytes:
    known = re.sub("[^A-Za-z0-9+/]", "", data.replace("-", "+").replace("_", "/"))
    known = known[: len(known) - (len(known) % 4 == 1)]
    return base64.b64decode(known + "=" * (-len(known) % 4))


@F.pandas_udf(T.ArrayType(_TEXT))
def _exact_texts(documents: pd.Series) -> pd.Series:
    """The text of every leaf of a document the native path must not judge."""

    def text_of(mime, data):
        if data is None:
            return None
        decoded = _bytes_of(data).decode("utf-8", "ignore").replace("\ufffd", "")
        return html_text(decoded) if mime == "text/html" else decoded

    def texts(document):
        return [{"mime": mime, "text": text_of(mime, data)} for mime, data in _walk(document)]

    return documents.map(texts, na_action="ignore")


def _last_text(bodies: Column) -> Column:
    return F.try_element_at(F.filter(bodies, lambda b: b != ""), F.lit(-1))


def _parse(df: DataFrame, payload_col: str, depth: int) -> DataFrame:
    """Adds the fields of the document, and _subject and _date.

    The fields come out of a generator with one row per row: projections are neither
    merged nor split across it, so the document is parsed exactly once.
    """
    parsed = F.from_json(
        F.col(payload_col).cast("string"),
        f"{payload_ddl(depth)[:-1]}, _broken: string>",
        {"columnNameOfCorruptRecord": "_broken"},
    )
    opened = F.inline(F.array(parsed)).alias("_mime", "_content", "_headers", "_parts", "_broken")
    return df.select("*", opened).withColumn(
        "_picked", headers.pick_headers(F.col("_headers"))
    )


def _with_html_bodies(df: DataFrame, leaves_col: str, exact_html: bool) -> DataFrame:
    """Adds _html: the cleaned bodies of array<struct(strip, text)> in `leaves_col`.

    Entries with strip=false are other types that merely mention html; they keep
    their text as it is.
    """
    leaves = F.col(leaves_col)
    if not exact_html:
        native = F.transform(
            leaves,
            lambda x: F.when(
                x["strip"], text.clean_text(html.strip_html(x["text"]))
            ).otherwise(x["text"]),
        )
        return df.withColumn("_html", native)
    bare = F.transform(leaves, lambda x: F.when(x["strip"], html.drop_markup(x["text"])))
    native = F.zip_with(
        leaves,
        F.col("_bare"),
        lambda x, r: F.when(
            x["strip"], text.clean_text(html.resolve_entities(r["text"]))
        ).otherwise(x["text"]),
    )
    exact = F.zip_with(
        leaves,
        F.col("_exact"),
        lambda x, s: F.when(x["strip"], text.clean_text(s)).otherwise(x["text"]),
    )
    raw_pages = F.transform(leaves, lambda x: F.when(x["strip"], x["text"]))
    doubtful = F.coalesce(F.exists("_bare", lambda r: r["doubt"]), F.lit(False))
    return (
        df.withColumn("_bare", bare)
        .withColumn("_doubt", doubtful)
        .withColumn("_exact", html.strip_html_list_exact(F.when(F.col("_doubt"), raw_pages)))
        .withColumn("_html", F.when(F.col("_doubt"), exact).otherwise(native))
        .drop("_bare", "_doubt", "_exact")
    )


def _as_page(leaf: Column) -> Column:
    return F.struct(
        F.coalesce(leaf["mime"] == "text/html", F.lit(False)).alias("strip"),
        text.base64url_to_text(leaf["data"]).alias("text"),
    )


def _plain_or_raw(leaf: Column) -> Column:
    decoded = text.base64url_to_text(leaf["data"])
    return F.when(leaf["mime"] == "text/plain", text.clean_text(decoded)).otherwise(decoded)


def _finish(df: DataFrame, body: Column, keep: list[str]) -> DataFrame:
    date = F.col("_picked.date")
    return (
        df.withColumns({
            "received_at": dates.parse_mail_date(date),
            "_subject": text.default_subject(F.col("_picked.subject")),
            "_body": body,
        })
        .select(
            *keep,
            "received_at",
            F.col("_subject").alias("subject"),
            text.default_body(F.col("_body"), F.col("_subject")).alias("body"),
            F.when(F.col("_broken").isNotNull(), "broken_document")
            .when(date.isNotNull() & F.col("received_at").isNull(), "bad_date")
            .alias("decode_note"),
        )
    )


def decode_payload(
    df: DataFrame,
    payload_col: str = "payload",
    mode: str = "descend",
    exact_html: bool = True,
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """Adds received_at, subject, body and decode_note to a frame of payload documents.

    descend: the last non-empty HTML leaf of the document, else the last non-empty
    plain leaf. strict: parts are looked at only below a container with data of its
    own, and a part without a body counts as its placeholder sentence.

    decode_note is NULL, or names what could not be read; no row is dropped.
    """
    made = ("received_at", "subject", "body", "decode_note")
    keep = [c for c in df.columns if c not in made]
    decode = {"descend": _decode_descend, "strict": _decode_strict}.get(mode)
    if decode is None:
        raise ValueError(f"mode is descend or strict, not {mode!r}")
    return decode(df.select(*keep), payload_col, exact_html, max_depth, keep)


def _with_leaves(df: DataFrame, payload_col: str, depth: int) -> DataFrame:
    """Adds _leaves of every document, whatever its depth."""
    near = _parse(df, payload_col, depth).withColumn("_near", F.expr(_leaves(_ROOT, depth)))
    deep = F.expr("coalesce(exists(_near, x -> x.deep), false)")
    return near.withColumn("_far", _deep_leaves(F.when(deep, F.col(payload_col)))).withColumn(
        "_leaves", F.coalesce("_far", "_near")
    )


def _is_plain(leaf: Column) -> Column:
    return _mentions(leaf["mime"], "plain") & ~_mentions(leaf["mime"], "html")


def _decode_descend(df, payload_col, exact_html, depth, keep) -> DataFrame:
    def pages_of(leaves):
        return F.filter(leaves, lambda x: _mentions(x["mime"], "html"))

    df = _parse(df, payload_col, depth).withColumn("_near", F.expr(_leaves(_ROOT, depth)))
    df = df.withColumn("_pages", F.transform(pages_of("_near"), _as_page))
    if exact_html:
        bare = F.transform(
            "_pages", lambda x: F.when(x["strip"], html.drop_markup(x["text"]))
        )
        df = df.withColumn("_bare", bare)
        doubt = F.expr(
            "coalesce(exists(_near, x -> x.deep), false) OR "
            "coalesce(exists(_bare, x -> x.doubt), false)"
        )
        native = F.zip_with(
            "_pages",
            "_bare",
            lambda x, r: F.when(
                x["strip"], text.clean_text(html.resolve_entities(r["text"]))
            ).otherwise(x["text"]),
        )
    else:
        doubt = F.expr("coalesce(exists(_near, x -> x.deep), false)")
        native = F.transform(
            "_pages",
            lambda x: F.when(
                x["strip"], text.clean_text(html.strip_html(x["text"]))
            ).otherwise(x["text"]),
        )
    df = df.withColumn("_exact", _exact_texts(F.when(doubt, F.col(payload_col))))

    def cleaned(leaf):
        known = leaf["mime"].isin("text/plain", "text/html")
        return F.when(known, text.clean_text(leaf["text"])).otherwise(leaf["text"])

    is_exact = F.col("_exact").isNotNull()
    page_bodies = F.when(is_exact, F.transform(pages_of("_exact"), cleaned)).otherwise(native)
    plain_bodies = F.when(
        is_exact, F.transform(F.filter("_exact", _is_plain), cleaned)
    ).otherwise(F.transform(F.filter("_near", _is_plain), _plain_or_raw))
    # a document that is one node of another type
    alone = F.expr(
        f"CASE WHEN coalesce(size(_parts), 0) <= 0 AND NOT {_ROOT.is_kind('html')} "
        f"AND NOT {_ROOT.is_kind('plain')} THEN {_ROOT.data} END"
    )
    # coalesce stops at the first value, so plain parts are decoded only where no HTML
    # part has text
    body = F.coalesce(
        _last_text(page_bodies), _last_text(plain_bodies), text.base64url_to_text(alone)
    )
    return _finish(df, body, keep)


def _strict_pick(node: _Node, depth: int) -> str:
    """The node whose own text becomes the body: follow the last HTML part, else the
    last plain part, down from each container that has data and parts."""

    def here(blank, deep):
        return (
            f"named_struct('mime', {node.mime}, 'data', {node.data}, 'headers', {node.headers}, "
            f"'blank', {blank}, 'deep', {deep})"
        )

    container = f"{node.has_data} AND NOT {node.is_text} AND {node.parts} IS NOT NULL"
    if depth == 0:
        return f"CASE WHEN {container} THEN {here('true', 'true')} ELSE {here('false', 'false')} END"
    part = f"p{depth}"
    below = _Node.of(part)
    pages = f"filter({node.parts}, {part} -> {below.is_kind('html')})"
    plains = (
        f"filter({node.parts}, {part} -> {below.is_kind('plain')} AND NOT {below.is_kind('html')})"
    )
    chosen = (
        f"get(transform(slice(concat({plains}, {pages}), -1, 1), "
        f"{part} -> {_strict_pick(below, depth - 1)}), 0)"
    )
    return (
        f"CASE WHEN {container} THEN coalesce({chosen}, {here('true', 'false')}) "
        f"ELSE {here('false', 'false')} END"
    )


def _decode_strict(df, payload_col, exact_html, depth, keep) -> DataFrame:
    # one node per document, as an array, so that it is handled like many
    df = _parse(df, payload_col, depth).withColumn(
        "_leaf",
        F.expr(
            f"transform(array({_strict_pick(_ROOT, depth)}), n -> named_struct('mime', n.mime, "
            "'data', CASE WHEN NOT n.blank AND n.data <> '' THEN n.data END, "
            "'headers', n.headers, 'deep', n.deep))"
        ),
    )
    # documents deeper than the schema are few; they are walked in Python
    deep = F.col("_leaf")[0]["deep"]
    df = df.withColumn("_far", _deep_pick(F.when(deep, F.col(payload_col)))).withColumn(
        "_leaf", F.coalesce("_far", "_leaf")
    )
    is_page = F.filter("_leaf", lambda n: n["mime"] == "text/html")
    df = _with_html_bodies(
        df.withColumn("_pages", F.transform(is_page, _as_page)), "_pages", exact_html
    )
    others = F.filter("_leaf", lambda n: F.coalesce(n["mime"] != "text/html", F.lit(True)))
    own = F.coalesce(
        F.get("_html", F.lit(0)), F.get(F.transform(others, _plain_or_raw), F.lit(0))
    )
    node = F.get("_leaf", F.lit(0))
    df = df.withColumns({
        "_own": own,
        # the sentence carries the subject of the part it came from
        "_part_subject": text.default_subject(headers.pick_headers(node["headers"])["subject"]),
    })
    return _finish(df, text.default_body(F.col("_own"), F.col("_part_subject")), keep)


_NAME = r'(?<!\\)"name"\s*:\s*"content-disposition"'
_VALUE = r'(?<!\\)"value"\s*:\s*"\s*attachment\b'
_ATTACHED = rf"(?i){_NAME}\s*,\s*{_VALUE}|{_VALUE}[^\"]*\"\s*,\s*{_NAME}"


def has_attachment(payload: Column) -> Column:
    """Whether any part, at any depth, has a Content-Disposition header of an attachment.

    Looked for in the document's text, so nothing is parsed or walked: a header is an object of
    name and value in either order, quotes inside values are escaped, and bodies are base64.
    """
    return F.coalesce(F.rlike(payload.cast("string"), F.lit(_ATTACHED)), F.lit(False))


def rejects(decoded: DataFrame) -> DataFrame:
    """Rows something could not be read from, with the reason."""
    return decoded.where(F.col("decode_note").isNotNull())


def parts_table(df: DataFrame, id_col: str = "id", payload_col: str = "payload") -> DataFrame:
    """One row per leaf part: (id, part, mime, data)."""
    return (
        _with_leaves(df.select(id_col, payload_col), payload_col, MAX_DEPTH)
        .select(id_col, F.posexplode("_leaves").alias("part", "_x"))
        .select(id_col, "part", F.col("_x.mime").alias("mime"), F.col("_x.data").alias("data"))
    )
