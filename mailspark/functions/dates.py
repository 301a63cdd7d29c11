"""Day ranges, run stamps and mail dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Formats of the mail search, the run stamp and the obsolete zone names.
DAY_FORMAT = "yyyy/MM/dd"
RUN_STAMP = "dd-MM-yyyy-HH-mm-ss"
RUN_STAMP_SHORT = "dd-MM-yyyy-HH-mm"
ZONES = {
    "GMT": "+0000", "UT": "+0000", "UTC": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}


def day_ranges(anchor: DataFrame, from_date: Column, days: int) -> DataFrame:
    """One (after, before) pair per day, going back `days` days from `from_date`,
    for each row of `anchor`."""
    return anchor.select(
        from_date.alias("_from"), F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("_back")
    ).select(
        F.date_format(F.date_sub("_from", F.col("_back") + 1), DAY_FORMAT).alias("after_date"),
        F.date_format(F.date_sub("_from", F.col("_back")), DAY_FORMAT).alias("before_date"),
    )


def run_stamp(ts: Column, seconds: bool = True) -> Column:
    return F.date_format(ts, RUN_STAMP if seconds else RUN_STAMP_SHORT)


def parse_mail_date(c: Column) -> Column:
    """RFC 5322 date to an instant. A date without zone, or with -0000, is read as UTC;
    an unreadable one is NULL."""
    text = F.trim(F.regexp_replace(F.regexp_replace(c, r"\s*\([^)]*\)", " "), r"\s+", " "))
    text = F.regexp_replace(text, r"^[A-Za-z]+(?:, ?| )", "")
    # 22-Aug-2025 and full month names
    text = F.regexp_replace(
        text, r"^(\d{1,2})[ -]([A-Za-z]{3})[A-Za-z]*\.?[ -](\d{2,4}) ", "$1 $2 $3 "
    )
    zones = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    name = F.upper(F.regexp_extract(text, r" ([A-Za-z]+)$", 1))
    offset = F.coalesce(
        F.nullif(F.regexp_extract(text, r" ([+-]\d{4})$", 1), F.lit("")),
        F.try_element_at(zones, name),
        F.lit("+0000"),
    )
    body = F.regexp_replace(text, r" (?:[+-]\d{4}|[A-Za-z]+)$", "")
    # two-digit years: below 69 they are in this century
    body = F.regexp_replace(body, r"^(\d{1,2} [A-Za-z]{3}) ([0-5]\d|6[0-8]) ", "$1 20$2 ")
    body = F.regexp_replace(body, r"^(\d{1,2} [A-Za-z]{3}) (\d\d) ", "$1 19$2 ")
    stamped = F.concat_ws(" ", body, offset)
    return F.coalesce(
        F.try_to_timestamp(stamped, F.lit("d MMM yyyy H:mm:ss Z")),
        F.try_to_timestamp(stamped, F.lit("d MMM yyyy H:mm Z")),
    )
