import base64
import json

import pytest

from mailspark.operators import mime


def b(content):
    raw = content if isinstance(content, bytes) else content.encode()
    return base64.urlsafe_b64encode(raw).decode()


def node(kind=None, content=None, parts=None, headers=None):
    out = {}
    if kind:
        out["mimeType"] = kind
    if content is not None:
        out["body"] = {"data": b(content)}
    if parts is not None:
        out["parts"] = parts
    if headers is not None:
        out["headers"] = headers
    return out


def mail(kind, content=None, parts=None, subject="S"):
    return node(kind, content, parts, [{"name": "Subject", "value": subject}])


EMPTY = "Email has a subject '{}' and no body."
PAGE = (
    "<html><head><title>T1</title><style>p{}</style></head><body><nav>menu</nav>"
    "<p>Hello</p><p>World &amp; co</p><footer>f</footer></body></html>"
)
ALT = "multipart/alternative"
PLAIN, HTML = node("text/plain", "Plain body"), node("text/html", "<p>Html body</p>")
CASES = {
    "M1": (mail("text/plain", "Hi there £5 http://a.b/c?x=1 ok"), "hi there £5 ok", None),
    "M2": (mail("text/html", PAGE), "t1helloworld co", None),
    "M3": (mail(ALT, None, [PLAIN, HTML]), EMPTY.format("S"), "html body"),
    "M4": (mail(ALT, "x", [PLAIN, HTML]), "html body", None),
    "M5": (
        mail(ALT, "x", [PLAIN, node("text/html")]),
        EMPTY.format("Email has no Subject"),
        "plain body",
    ),
    "M6": ({}, EMPTY.format("Email has no Subject"), None),
    "M7": (mail("text/plain", "https://a.b/c"), EMPTY.format("S"), None),
    "M8": (mail("text/calendar", "BEGIN:VCAL"), "BEGIN:VCAL", None),
    "M9": (
        mail("multipart/mixed", "x", [node(ALT, None, [node("text/html", "<p>deep</p>")])]),
        EMPTY.format("S"),
        "deep",
    ),
    "M10": (mail("text/plain", bytes.fromhex("6162FFFF6364C3")), "abcd", None),
    "M11": (mail("text/plain", "a b", subject=""), "a b", None),
    "M12": (
        mail(ALT, "x", [node("text/html", "one"), node("text/html", "two")]), "two", None,
    ),
    "M13": (mail(ALT, "x", [node("text/plain", f"p{i}") for i in range(12)]), "p11", None),
}


def decoded(spark, cases, **kw):
    rows = [(k, json.dumps(v[0])) for k, v in cases.items()]
    df = spark.createDataFrame(rows, "id string, payload string")
    return {r["id"]: r for r in mime.decode_payload(df, **kw).collect()}


@pytest.mark.parametrize("mode", ["strict", "descend"])
@pytest.mark.parametrize("exact", [True, False])
def test_golden_payloads(spark, mode, exact):
    got = decoded(spark, CASES, mode=mode, exact_html=exact)
    for case, (_, strict, descend) in CASES.items():
        want = strict if mode == "strict" or descend is None else descend
        assert got[case]["body"] == want, case
    assert got["M11"]["subject"] == "Email has no Subject"
    assert got["M6"]["received_at"] is None


def test_any_depth_is_read(spark):
    deep = node("text/html", "<p>bottom</p>")
    for _ in range(12):
        deep = node("multipart/mixed", None, [node("text/plain", "side"), deep])
    assert decoded(spark, {"d": (deep,)}, max_depth=3)["d"]["body"] == "bottom"


def test_strict_rule_holds_at_any_depth(spark):
    deep = node("text/html", "<p>deep body</p>")
    for _ in range(5):
        deep = node("multipart/html-related", "x", [deep])
    deep["headers"] = [{"name": "Subject", "value": "S"}]
    odd = node("multipart/html", "x", [node("image/png", "y")])
    for _ in range(6):
        odd = node("multipart/html", "x", [None, odd])
    got = decoded(spark, {"d": (deep,), "o": (odd,)}, mode="strict")
    assert got["d"]["body"] == "deep body" and got["d"]["decode_note"] is None
    assert got["o"]["body"] == EMPTY.format("Email has no Subject")


def test_attachments_are_seen_at_any_depth(spark):
    def part(value, **more):
        return {"headers": [{"name": "Content-Disposition", "value": value, **more}]}

    deep = part("attachment; filename=x")
    for _ in range(9):
        deep = {"parts": [PLAIN, deep]}
    swapped = '{"headers": [{"value": "ATTACHMENT", "name": "content-disposition"}]}'
    rows = [
        ("deep", json.dumps(deep)), ("swapped", swapped), ("inline", json.dumps(part("inline"))),
        ("none", None), ("broken", "{x"),
        ("quoted", json.dumps({"headers": [
            {"name": "Subject", "value": '"name": "Content-Disposition", "value": "attachment"'}
        ]})),
    ]
    df = spark.createDataFrame(rows, "id string, payload string")
    got = df.select("id", mime.has_attachment(df["payload"]).alias("x")).collect()
    assert {r["id"] for r in got if r["x"]} == {"deep", "swapped"}


def test_parts_table(spark):
    deep = node("text/html", "z")
    for _ in range(8):
        deep = node("multipart/mixed", None, [deep])
    rows = [("a", json.dumps(mail(ALT, None, [PLAIN, HTML]))), ("b", json.dumps(deep))]
    df = spark.createDataFrame(rows, "id string, payload string")
    got = sorted((r["id"], r["part"], r["mime"]) for r in mime.parts_table(df).collect())
    assert got == [("a", 0, "text/plain"), ("a", 1, "text/html"), ("b", 0, "text/html")]


def test_doubtful_html_takes_the_exact_path(spark):
    pages = {
        "nested": ("<nav>a<nav>b</nav>c</nav>d", "d"),
        "unclosed": ("<div><aside>x</div>y", "y"),
        "quoted": ('<a title="1 > 2">link</a>', "link"),
        "numeric": ("caf&#101; &euro;5", "cafe €5"),
        "script": ("<script>if (a < b) { c('</nav>') }</script>ok", "ok"),
        "open comment": ("a<!-- x -->b", "ab"),
    }
    got = decoded(spark, {k: (mail("text/html", v[0]),) for k, v in pages.items()})
    for k, (_, want) in pages.items():
        assert got[k]["body"] == want, k


def test_broken_documents_keep_their_row(spark):
    df = spark.createDataFrame(
        [("a", "{not json"), ("b", None), ("c", "{}")], "id string, payload string"
    )
    got = {r["id"]: r for r in mime.decode_payload(df).collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["a"]["decode_note"] == "broken_document"
    assert got["c"]["decode_note"] is None
    bad = {"headers": [{"name": "Date", "value": "nonsense"}]}
    assert decoded(spark, {"x": (bad,)})["x"]["decode_note"] == "bad_date"


@pytest.mark.parametrize("mode", ["strict", "descend"])
def test_decode_parses_once_and_does_not_shuffle(spark, tmp_path, mode):
    path = str(tmp_path / "fetched")
    spark.sql("SELECT '1' AS id, '{}' AS payload").write.parquet(path)
    decoded = mime.decode_payload(spark.read.parquet(path), mode=mode).select("id", "body")
    plan = decoded._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("from_json") == 1
