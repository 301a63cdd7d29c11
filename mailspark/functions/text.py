"""Text functions on columns. All of them are native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

# These must equal the cleaning rules and wording of the mail triage.
# Unicode whitespace, spelled so that Java and RE2 both accept it inside [...].
WS = r"\s\x{0B}\x{1C}-\x{1F}\x{85}\p{Z}"
URL_PATTERN = rf"https?://[^{WS}]+|http?://[^{WS}]+|www\.[^{WS}]+"
DISALLOWED_PATTERN = rf"[\W_&&[^£$€¥₹{WS}]]+"
WS_PATTERN = rf"[{WS}]++"
NO_SUBJECT = "Email has no Subject"
NO_BODY_HEAD = "Email has a subject '"
NO_BODY_TAIL = "' and no body."


def bind(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c), with `c` computed once however often `use` mentions it."""
    return F.transform(F.array(c), use)[0]


def base64url_to_binary(c: Column) -> Column:
    """URL-safe base64 to bytes. Missing padding is accepted. Characters outside the
    alphabet are passed over, and a dangling last character, which holds no whole byte,
    is left out; such text takes the second path instead of failing the job."""

    def repaired(x):
        known = F.regexp_replace(x, "[^\\w+/]+", "")
        return F.try_to_binary(
            F.regexp_replace(known, "^((?:.{4})*+).$", "$1"), F.lit("base64")
        )

    return bind(
        F.translate(c, "-_", "+/"),
        lambda x: F.coalesce(F.try_to_binary(x, F.lit("base64")), repaired(x)),
    )


def utf8_ignore(c: Column) -> Column:
    """Bytes to text; invalid sequences vanish."""
    return F.replace(F.make_valid_utf8(c.cast("string")), F.lit("�"), F.lit(""))


def base64url_to_text(c: Column) -> Column:
    return utf8_ignore(base64url_to_binary(c))


def text_to_base64url(c: Column) -> Column:
    return F.translate(F.base64(c.cast("binary")), "+/=\r\n", "-_")


def remove_urls(c: Column) -> Column:
    """The pattern is tried only on texts that hold the literal part of a URL."""
    return bind(
        c,
        lambda x: F.when(
            x.contains("://") | x.contains("www."), F.regexp_replace(x, URL_PATTERN, "")
        ).otherwise(x),
    )


def keep_allowed(c: Column) -> Column:
    return F.regexp_replace(c, DISALLOWED_PATTERN, "")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), WS_PATTERN, " "))


def clean_text(c: Column) -> Column:
    return squeeze(keep_allowed(remove_urls(c)))


def default_subject(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(NO_SUBJECT))


def default_body(body: Column, subject: Column) -> Column:
    """`subject` must already carry its own default."""
    return F.coalesce(
        F.nullif(body, F.lit("")),
        F.concat(F.lit(NO_BODY_HEAD), subject, F.lit(NO_BODY_TAIL)),
    )


def body_or_subject(body: Column, subject: Column, times: int = 10) -> Column:
    return F.coalesce(body, F.repeat(subject, times))


def tokens(c: Column, limit: int) -> Column:
    """The first `limit` blank-separated words."""
    return F.slice(F.split(c, " ", limit + 1), 1, limit)
