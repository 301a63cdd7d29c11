"""Registry, and the SQL the checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def received_us():
    return F.unix_micros("received_at").alias("received_us")


WS = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}"


# What counts as an address, and the characters that stay.
def no_urls(x: str) -> str:
    return rf"regexp_replace({x}, 'https?://[^{WS}]+|http?://[^{WS}]+|www\.[^{WS}]+', '', 'g')"


def allowed(x: str) -> str:
    return f"regexp_replace({x}, '[^a-zA-Z0-9£$€¥₹{WS}]', '', 'g')"


def squeezed(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[{WS}]+', ' ', 'g'))"


def cleaned(x: str) -> str:
    return squeezed(allowed(no_urls(x)))


def page_text(x: str) -> str:
    for tag in ("script", "style", "header", "footer", "nav", "aside"):
        x = rf"regexp_replace({x}, '(?is)<{tag}(\s[^>]*)?>.*?</{tag}\s*>', '', 'g')"
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"
    x = f"regexp_replace({x}, '(?s)<[!/a-zA-Z][^>]*>', '', 'g')"
    for entity, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("nbsp", " "),
                         ("copy", "©"), ("middot", "·"), ("amp", "&")):
        x = f"replace({x}, '&{entity};', '{char}')"
    return x


def with_defaults(subject: str, body: str) -> tuple[str, str]:
    s = f"coalesce(nullif({subject}, ''), 'Email has no Subject')"
    return s, f"coalesce(nullif({body}, ''), 'Email has a subject ''' || {s} || ''' and no body.')"


def bucket(x: str, n: int) -> str:
    return f"(('0x' || substr(md5({x}), 1, 8))::bigint % {n})"


CTES = {
    "messages": """messages AS (
        SELECT lpad(cast(doc_id AS varchar), 16, '0') AS id,
               timestamp '2024-01-01' + doc_id * interval 37 minute AS received_at,
               split_part(text, '.', 1) AS subject,
               text AS body, lang, source
        FROM documents)""",
    "labelset": """labelset AS (
        SELECT lpad(cast(doc_id AS varchar), 16, '0') AS id, quality AS label FROM labels)""",
    "scores": f"""scores AS (
        SELECT id, {bucket('id', 1000)} / 1000.0::double AS p FROM messages)""",
    "state": """state AS (
        SELECT lpad(cast(event_id AS varchar), 16, '0') AS id, user_id AS mailbox,
               ts AS received_at, event_type, value,
               CASE WHEN event_type = 'signup' THEN ['TRASH'] ELSE ['INBOX'] END AS labels,
               CASE WHEN event_type = 'signup' THEN ts END AS trashed_at
        FROM events)""",
    "outcomes": """outcomes AS (
        SELECT lpad(cast(event_id AS varchar), 16, '0') AS id,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS status,
               props AS payload, value
        FROM events)""",
}


def using(names: str, select: str, *more: str) -> str:
    """WITH the named views, further ones, and a final select."""
    parts = [CTES[n] for n in names.split()] + list(more)
    return f"WITH {', '.join(parts)} {select}"
