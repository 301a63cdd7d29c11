"""Header pick and sender split."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def pick_headers(headers: Column) -> Column:
    """Fold over the header list to struct(subject, date).

    Names match exactly. The last value seen wins until both are set; from then on
    the pair is settled.
    """
    empty = F.struct(
        F.lit(None).cast("string").alias("subject"), F.lit(None).cast("string").alias("date")
    )

    def step(acc, h):
        settled = acc["subject"].isNotNull() & acc["date"].isNotNull()
        subject_seen = F.struct(
            F.coalesce(h["value"], F.lit("")).alias("subject"), acc["date"].alias("date")
        )
        date_seen = F.struct(acc["subject"].alias("subject"), h["value"].alias("date"))
        return (
            F.when(settled, acc)
            .when(h["name"] == "Subject", subject_seen)
            .when(h["name"] == "Date", date_seen)
            .otherwise(acc)
        )

    return F.aggregate(F.coalesce(headers, F.array()), empty, step)


def sender_from_envelope(addr: Column) -> Column:
    """struct(name, mailbox, host) to struct(name, address); either may be NULL."""
    name = F.nullif(addr["name"], F.lit(""))
    mailbox, host = F.nullif(addr["mailbox"], F.lit("")), F.nullif(addr["host"], F.lit(""))
    return F.struct(name.alias("name"), F.concat(mailbox, F.lit("@"), host).alias("address"))


def sender_from_header(c: Column) -> Column:
    """A raw From header, `"Name" <box@host>` or `box@host`, to struct(name, address)."""
    in_brackets = F.regexp_extract(c, r"<\s*([^<>\s@]+@[^<>\s@]+)\s*>", 1)
    bare = F.regexp_extract(c, r"^\s*([^<>\s@\"]+@[^<>\s@]+)\s*$", 1)
    name = F.trim(F.regexp_extract(c, r"^\s*\"?([^\"<>]*?)\"?\s*<", 1))
    return F.struct(
        F.nullif(name, F.lit("")).alias("name"),
        F.coalesce(F.nullif(in_brackets, F.lit("")), F.nullif(bare, F.lit(""))).alias("address"),
    )
