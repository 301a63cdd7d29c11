"""Raw RFC 822 mail: sender, attachment flag and body."""

from __future__ import annotations

from email import message_from_bytes, policy

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from mailspark.functions import headers


def _text_of(part) -> str:
    raw = part.get_payload(decode=True) or b""
    try:
        return raw.decode(part.get_content_charset() or "utf-8", errors="ignore")
    except LookupError:  # a charset Python has no name for
        return raw.decode("utf-8", errors="ignore")


def _is_attached(part) -> bool:
    return "attachment" in str(part.get("Content-Disposition", ""))


def _read(raw: bytes | None) -> tuple[bool | None, str | None]:
    if raw is None:
        return None, None
    mail = message_from_bytes(bytes(raw), policy=policy.default)
    if not mail.is_multipart():
        return False, _text_of(mail)
    plain = (
        p for p in mail.walk() if p.get_content_type() == "text/plain" and not _is_attached(p)
    )
    first = next(plain, None)
    return any(True for _ in mail.iter_attachments()), None if first is None else _text_of(first)


@F.pandas_udf(T.StructType([
    T.StructField("has_attachments", T.BooleanType()),
    T.StructField("body", T.StringType()),
]))
def read_rfc822(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(
        [_read(r) for r in raw], columns=["has_attachments", "body"], index=raw.index
    )


def parse_raw_mail(
    df: DataFrame, raw_col: str = "rfc822", envelope_col: str = "envelope"
) -> DataFrame:
    """Adds sender_name, sender_address, has_attachments and body, for every row."""
    sender = headers.sender_from_envelope(F.col(envelope_col))
    return (
        df.withColumn("_mail", read_rfc822(F.col(raw_col)))
        .withColumn("_from", sender)
        .select(
            *[c for c in df.columns if c not in (raw_col, envelope_col)],
            F.col("_from.name").alias("sender_name"),
            F.col("_from.address").alias("sender_address"),
            F.col("_mail.has_attachments").alias("has_attachments"),
            F.col("_mail.body").alias("body"),
        )
    )
