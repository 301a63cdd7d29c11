"""HTML to text: a native path, and an exact path for pages a regex cannot judge."""

from __future__ import annotations

import re
from functools import reduce
from html.parser import HTMLParser
from operator import or_

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from mailspark.functions.text import bind

# Subtrees whose text is not mail text, and the named entities the
# native path resolves.
RAW_TEXT_TAGS = ("script", "style")
SECTION_TAGS = ("header", "footer", "nav", "aside")
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " ",
    "&copy;": "©", "&middot;": "·",
    "&amp;": "&",  # last, so that "&amp;lt;" ends as "&lt;"
}
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)

_RAW = "|".join(rf"<{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in RAW_TEXT_TAGS)
_SECTIONS = "|".join(rf"<{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in SECTION_TAGS)
# Comments and raw text go in one left-to-right pass: whichever opens first owns the rest.
RAW_TEXT_PATTERN = rf"(?is)<!--.*?-->|{_RAW}"
SECTION_PATTERN = rf"(?is){_SECTIONS}"
TAG_PATTERN = r"(?s)<[!/a-zA-Z][^>]*>"

# Left over after the subtrees are gone, these open what the native path must not judge.
LEFTOVERS = tuple(f"<{slash}{t}" for t in RAW_TEXT_TAGS + SECTION_TAGS for slash in ("", "/")) + (
    "<!-", "<![",
)


def _has_any(c: Column, needles) -> Column:
    return reduce(or_, [c.contains(n) for n in needles])


def drop_subtrees(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, RAW_TEXT_PATTERN, ""), SECTION_PATTERN, "")


def drop_markup(c: Column) -> Column:
    """struct(text, doubt): the page without subtrees and tags, entities still in place,
    and whether a regex could not judge it: nested or unclosed subtrees, comments left
    open, markup signs that are text or sit in attributes, entities outside the table."""

    def judge(rest):
        return F.struct(
            F.regexp_replace(rest, TAG_PATTERN, "").alias("text"),
            _has_any(F.lower(rest), LEFTOVERS).alias("doubt"),
        )

    def other_entities(x):
        for entity in ENTITIES:
            x = F.replace(x, F.lit(entity), F.lit(""))
        return x.contains("&") & x.rlike("&(?:#|[A-Za-z][A-Za-z0-9]*;)")

    def widen(s):
        strange = _has_any(s["text"], "<>") | (
            s["text"].contains("&") & other_entities(s["text"])
        )
        return s.withField("doubt", s["doubt"] | strange)

    return bind(bind(drop_subtrees(c), judge), widen)


def resolve_entities(c: Column) -> Column:
    for entity, char in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def strip_html(c: Column) -> Column:
    """Native path alone: exact on pages `drop_markup` has no doubt about."""
    return resolve_entities(F.regexp_replace(drop_subtrees(c), TAG_PATTERN, ""))


class _MailText(HTMLParser):
    """Collects text outside the dropped subtrees. An end tag closes every element
    opened since its start tag, so an unclosed subtree ends with its parent."""

    dropped = frozenset(RAW_TEXT_TAGS + SECTION_TAGS)

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open_tags, self.hidden, self.kept = [], 0, []

    def handle_starttag(self, tag, attrs):
        if tag not in VOID_TAGS:
            self.open_tags.append(tag)
            self.hidden += tag in self.dropped

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in self.open_tags:
            while True:
                closed = self.open_tags.pop()
                self.hidden -= closed in self.dropped
                if closed == tag:
                    break

    def handle_data(self, data):
        if not self.hidden:
            self.kept.append(data)


def html_text(page: str | None) -> str | None:
    if page is None:
        return None
    reader = _MailText()
    # a named entity counts only with its semicolon; any other "&" is text
    reader.feed(re.sub(r"&(?!#|[A-Za-z][A-Za-z0-9]*;)", "&amp;", page))
    reader.close()
    return "".join(reader.kept)


@F.pandas_udf(T.StringType())
def strip_html_exact(pages: pd.Series) -> pd.Series:
    return pages.map(html_text, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def strip_html_list_exact(pages: pd.Series) -> pd.Series:
    return pages.map(lambda some: None if some is None else [html_text(p) for p in some])


def with_html_text(df, html_col: str, out_col: str):
    """Native text where that is exact; only doubtful pages travel to Python."""
    doubt = F.col("_bare.doubt")
    return (
        df.withColumn("_bare", drop_markup(F.col(html_col)))
        .withColumn("_exact", strip_html_exact(F.when(doubt, F.col(html_col))))
        .withColumn(
            out_col,
            F.when(doubt, F.col("_exact")).otherwise(resolve_entities(F.col("_bare.text"))),
        )
        .drop("_bare", "_exact")
    )
