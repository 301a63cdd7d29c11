import datetime as dt
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from mailspark.functions import dates, headers, html, scoring, text, vectors


def one(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(v,) for v in value], f"x {kind}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


HEADS = ("https://", "http://", "htt://", "www.")


def python_clean(s):
    """The rules of text cleaning, character by character."""
    kept, at = [], 0
    while at < len(s):
        head = next((h for h in HEADS if s.startswith(h, at)), "")
        end = at + len(head)
        if head and end < len(s) and not s[end].isspace():
            while end < len(s) and not s[end].isspace():
                end += 1
            at = end
            continue
        c = s[at]
        if c.isspace():
            kept.append(" ")
        elif c in "£$€¥₹" or (c.isascii() and c.isalnum()):
            kept.append(c.lower())
        at += 1
    return " ".join("".join(kept).split())


CLEAN = {
    "a\x1fb\x85c\xa0d　e": "a b c d e",
    "HTTP://X.com www.x.y htt://q z": "httpxcom z",
    "café ​zero": "caf zero",
    "http:// lone": "http lone",
    "": "",
    "under_score £5 €6 ¥7 ₹8 $9": "underscore £5 €6 ¥7 ₹8 $9",
}


def test_clean_text_golden(spark):
    assert one(spark, list(CLEAN), text.clean_text) == list(CLEAN.values())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=40))
def test_clean_text_equals_python_and_is_idempotent(spark, samples):
    samples = [s.encode("utf-8", "ignore").decode() for s in samples]
    got = one(spark, samples, text.clean_text)
    assert got == [python_clean(s) for s in samples]
    assert one(spark, got, text.clean_text) == got


def test_base64_is_lenient(spark):
    data = ["SGkgdGhlcmU", "SGkgdGhlcmU=", "SGkg\ndGhl\r\ncmU=", "SGkgdGhlcmUx9", "_-8", "", None]
    got = one(spark, data, lambda c: text.base64url_to_binary(c))
    assert [None if g is None else bytes(g) for g in got] == [
        b"Hi there", b"Hi there", b"Hi there", b"Hi there1", b"\xff\xef", b"", None,
    ]


def test_long_base64_needs_no_deep_stack(spark):
    assert one(spark, ["QUJD" * 500_000 + "!x"], lambda c: F.length(
        text.base64url_to_binary(c))) == [1_500_000]


def test_defaults(spark):
    assert one(spark, [None, "", "s"], text.default_subject) == [
        "Email has no Subject", "Email has no Subject", "s",
    ]
    assert one(spark, [None, "b"], lambda c: text.default_body(c, F.lit("S"))) == [
        "Email has a subject 'S' and no body.", "b",
    ]
    assert one(spark, [None, "b"], lambda c: text.body_or_subject(c, F.lit("xy"))) == [
        "xy" * 10, "b",
    ]


PAGES = {
    "<p>a</p><p>b &amp; c</p>": "ab & c",
    "<HEADER class='x'>h</HEADER >t<script>if (a<b) x('</p>')</script>u": "tu",
    "<nav>a<nav>b</nav>c</nav>d": "d",
    "<div><aside>x</div>y": "y",
    '<a title="1 > 2">link</a>': "link",
    "5 < 6 &euro; &#65;": "5 < 6 € A",
    "a&regb &copyc &copy; d": "a&regb &copyc © d",
    "<!-- <script> -->kept<!-- x -->": "kept",
    "&amp;lt;": "&lt;",
}


def test_html_paths(spark):
    df = spark.createDataFrame([(p,) for p in PAGES] + [(None,)], "page string")
    got = {r["page"]: r["out"] for r in html.with_html_text(df, "page", "out").collect()}
    assert got == {**PAGES, None: None}
    # wherever the native path has no doubt, it agrees with the parser
    rows = df.where("page is not null").select(
        "page", html.drop_markup(F.col("page")).alias("m"), html.strip_html(F.col("page")).alias("n")
    ).collect()
    sure = [r for r in rows if not r["m"]["doubt"]]
    assert len(sure) >= 4
    for r in sure:
        assert r["n"] == html.html_text(r["page"])


def test_native_html_equals_the_parser_on_pages(spark, tiny):
    pages = spark.read.parquet(f"{tiny}/pages.parquet")
    both = pages.select(
        html.strip_html(F.col("html")).alias("a"), html.strip_html_exact(F.col("html")).alias("b")
    )
    assert both.where("a <> b").count() == 0


DATES = {
    "Fri, 22 Aug 2025 03:23:00 +0530": dt.datetime(2025, 8, 21, 21, 53),
    "22 Aug 2025 03:23:00 -0000": dt.datetime(2025, 8, 22, 3, 23),
    "Fri, 22 Aug 2025 03:23:00 GMT": dt.datetime(2025, 8, 22, 3, 23),
    "Fri, 22 Aug 2025 03:23:00 +0000 (UTC)": dt.datetime(2025, 8, 22, 3, 23),
    "Fri, 1 Aug 2025 03:23 +0200": dt.datetime(2025, 8, 1, 1, 23),
    "Fri, 01 Aug 25 03:23:00 PDT": dt.datetime(2025, 8, 1, 10, 23),
    "1 Aug 99 03:23:00 EST": dt.datetime(1999, 8, 1, 8, 23),
    "22 Aug 2025 03:23:00": dt.datetime(2025, 8, 22, 3, 23),
    "nonsense": None,
    "": None,
    "Fri, 99 Aug 2025 03:23:00 +0000": None,
}


def test_mail_dates(spark):
    got = one(spark, list(DATES), lambda c: F.unix_seconds(dates.parse_mail_date(c)))
    want = [
        None if d is None else int(d.replace(tzinfo=dt.timezone.utc).timestamp())
        for d in DATES.values()
    ]
    assert got == want


HEADERS = {
    "H1": ([("Subject", "A"), ("Date", "D1"), ("Subject", "B")], ("A", "D1")),
    "H2": ([("Date", "D1"), ("Subject", "A"), ("Subject", "B")], ("A", "D1")),
    "H3": ([("Subject", "A"), ("Subject", "B"), ("Date", "D1"), ("Date", "D2")], ("B", "D1")),
    "H4": ([("subject", "x")], (None, None)),
    "H5": ([("Subject", ""), ("Date", "D1"), ("Subject", "Z")], ("", "D1")),
    "none": ([], (None, None)),
}


def test_header_fold(spark):
    df = spark.createDataFrame(
        [(k, v[0]) for k, v in HEADERS.items()],
        "k string, h array<struct<name: string, value: string>>",
    )
    for r in df.select("k", headers.pick_headers(F.col("h")).alias("p")).collect():
        assert (r["p"]["subject"], r["p"]["date"]) == HEADERS[r["k"]][1], r["k"]


def test_senders(spark):
    got = one(
        spark,
        ['"A B" <a@b.c>', "a@b.c", "A <a@b.c>", "<a@b.c>", "nobody", None],
        headers.sender_from_header,
    )
    assert [(g["name"], g["address"]) for g in got] == [
        ("A B", "a@b.c"), (None, "a@b.c"), ("A", "a@b.c"), (None, "a@b.c"), (None, None),
        (None, None),
    ]


def test_vectors(spark):
    unit = one(spark, [[3.0, 4.0], [0.0, 0.0]], vectors.l2_normalise, "array<double>")
    assert unit == [[0.6, 0.8], [0.0, 0.0]]


@pytest.mark.parametrize("p,confident", [
    (0.05, True), (0.95, False), (0.951, True), (0.5, False), (0.049, True), (None, False),
])
def test_confidence_edges(spark, p, confident):
    assert one(spark, [p], scoring.is_confident, "double") == [confident]


def test_threshold_edges(spark):
    assert one(spark, [0.35, 0.36], scoring.threshold, "double") == [0, 1]
    assert one(spark, [0.5], lambda c: scoring.threshold(c, 0.5), "double") == [0]
    assert one(spark, [0.5], lambda c: scoring.threshold(c, 0.5, strict=False), "double") == [1]


def test_day_ranges(spark):
    anchor = spark.createDataFrame([(dt.date(2025, 3, 1),)], "d date")
    rows = dates.day_ranges(anchor, F.col("d"), 2).collect()
    assert sorted((r[0], r[1]) for r in rows) == [
        ("2025/02/27", "2025/02/28"), ("2025/02/28", "2025/03/01"),
    ]
