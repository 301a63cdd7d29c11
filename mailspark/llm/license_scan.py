"""License scans with ordered signature rules, in DataFrame functions only.

FAMILIES is written by hand; each family gives rules for its tag, its address, its notice, its
name with a version and its bare name, some hundreds together. A rule has a regex, a keyword its
matches must hold, a label, and a priority: 1 for tags, addresses and notices, 2 for a name with
its version, 3 for a bare name or hint. A keyword is made from the fixed words of the rule and
looked for in the words parted by single blanks, so it is in every text the rule matches. Each
keyword holds an anchor; a text without any anchor is not looked at.

Overlaps are resolved on (start, end): what lies inside a detection of the same or better
priority goes, and so does what overlaps a strictly better one. The detections, which hold no
text, are dealt by row, so the windows see one text's detections at a time.

Base places are the fixed phrases as consecutive words. Nulls and empty texts have no words and
no labels. Repeated rows and ids stay as they are.

Very long texts are matched whole, in the JVM. An empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Phrases and labels of the base places.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Rare parts of words, the first of them in a keyword is its anchor.
ANCHOR_PARTS = (
    "licen", "spdx", "gpl", "creative", "copyright", "reserved", "domain", "cc0", "perl", "mozilla",
    "eclipse",
)
CC_BY = rf"(?i)(?<![0-9A-Za-z])cc{NOT_WORD}by(?![0-9A-Za-z])"
SCORES = {1: 1.0, 2: 0.8, 3: 0.5}
BASE_SCORE = 0.9

# label; names; versions (none: the license has no number); address
FAMILIES = (
    ("gpl", "gpl|gplv", "1 2 3", "gnu.org/licenses/gpl"),
    ("gpl", "gnu general public licen[cs]e", "1 2 3", ""),
    ("lgpl", "lgpl|lgplv", "2 2.1 3", "gnu.org/licenses/lgpl"),
    ("lgpl",
     "gnu lesser general public licen[cs]e|gnu library general public licen[cs]e", "2 2.1 3", ""),
    ("agpl", "agpl|agplv", "1 3", "gnu.org/licenses/agpl"),
    ("agpl", "gnu affero general public licen[cs]e|affero general public licen[cs]e",
     "1 3", ""),
    ("gfdl", "gnu free documentation licen[cs]e", "1.1 1.2 1.3",
     "gnu.org/licenses/fdl"),
    ("apache", "apache licen[cs]e|apache software licen[cs]e", "1.0 1.1 2.0 2",
     "apache.org/licenses/license"),
    ("mit", "mit licen[cs]e|expat licen[cs]e", "", "opensource.org/licenses/mit"),
    ("bsd-2-clause", "bsd 2 clause licen[cs]e|simplified bsd licen[cs]e", "",
     "opensource.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", "bsd 3 clause licen[cs]e|new bsd licen[cs]e|modified bsd licen[cs]e",
     "", "opensource.org/licenses/bsd-3-clause"),
    ("bsd-4-clause", "bsd 4 clause licen[cs]e|original bsd licen[cs]e", "", ""),
    ("bsd", "bsd licen[cs]e", "", ""),
    ("isc", "isc licen[cs]e", "", "opensource.org/licenses/isc"),
    ("mpl", "mozilla public licen[cs]e", "1.0 1.1 2.0 2", "mozilla.org/mpl"),
    ("epl", "eclipse public licen[cs]e", "1.0 2.0", "eclipse.org/legal/epl"),
    ("cddl",
     "common development and distribution licen[cs]e", "1.0 1.1", ""),
    ("eupl", "european union public licen[cs]e", "1.0 1.1 1.2", ""),
    ("osl", "open software licen[cs]e", "1.0 2.0 2.1 3.0", ""),
    ("afl", "academic free licen[cs]e", "1.1 1.2 2.0 2.1 3.0", ""),
    ("artistic", "artistic licen[cs]e", "1.0 2.0", ""),
    ("bsl", "boost software licen[cs]e", "1.0", "boost.org/license"),
    ("zlib", "zlib licen[cs]e|zlib libpng licen[cs]e", "", ""),
    ("python", "python software foundation licen[cs]e|psf licen[cs]e", "2 2.0", ""),
    ("php", "php licen[cs]e", "3.0 3.01", "php.net/license"),
    ("ruby", "ruby licen[cs]e", "", ""),
    ("perl", "same terms as perl itself", "", ""),
    ("w3c", "w3c software licen[cs]e|w3c software notice and licen[cs]e", "", ""),
    ("x11", "x11 licen[cs]e|x consortium licen[cs]e", "", ""),
    ("openssl", "openssl licen[cs]e", "", ""),
    ("wtfpl", "do what the fuck you want to public licen[cs]e", "1 2", ""),
    ("unlicense", "the unlicense|unlicense", "", "unlicense.org"),
    ("ms-pl", "microsoft public licen[cs]e", "", ""),
    ("ms-rl", "microsoft reciprocal licen[cs]e", "", ""),
    ("ofl", "sil open font licen[cs]e|open font licen[cs]e", "1.0 1.1", ""),
    ("lppl", "latex project public licen[cs]e", "1.0 1.1 1.2 1.3 1.3c", ""),
    ("ncsa", "university of illinois ncsa open source licen[cs]e", "", ""),
    ("odbl", "open database licen[cs]e", "1.0", "opendatacommons.org/licenses/odbl"),
    ("odc-by", "open data commons attribution licen[cs]e", "1.0", ""),
    ("pddl", "public domain dedication and licen[cs]e", "1.0", ""),
    ("cc0", "cc0|cc0 1 0 universal", "1.0", "creativecommons.org/publicdomain/zero"),
    ("public-domain",
     "dedicated to the public domain|released into the public domain|in the public domain", "", ""),
    ("bigscience-rail", "bigscience rail licen[cs]e|openrail m licen[cs]e", "1.0", ""),
    ("llama", "llama community licen[cs]e|llama 2 community licen[cs]e", "", ""),
    ("elastic", "elastic licen[cs]e", "2.0", "elastic.co/licensing"),
    ("sspl", "server side public licen[cs]e", "1", ""),
    ("busl", "business source licen[cs]e", "1.1", ""),
    ("commons-clause", "commons clause licen[cs]e condition", "1.0", ""),
    ("proprietary", "all rights reserved", "", ""),
    ("proprietary", "proprietary licen[cs]e|commercial licen[cs]e agreement", "", ""),
)
CC_KINDS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_WORDS = {
    "by": "attribution", "sa": "share ?alike", "nd": "no ?derivati?ve?s?", "nc": "non ?commercial",
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

GAP = rf"(?:{NOT_WORD}+)"  # of any length; possessive, as a word always follows
START, END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
NUMBER = rf"(?:{GAP}(?:the{GAP})?)?(?:version{GAP}|ver{GAP}|v{GAP}|v)?"


def spaced(words: str) -> str:
    """A regex of words; a blank stands for what may come between two words."""
    return words.replace(" ?", "\0").replace(" ", GAP).replace("\0", f"(?:{GAP})?")


def numbered(version: str) -> str:
    """A version, with or without its trailing .0, not as the start of a longer one."""
    short = re.escape(version[:-2]) + r"(?:\.0)?" if version.endswith(".0") else re.escape(version)
    return short + r"(?![0-9A-Za-z]|\.[0-9])"


def keyword_of(words: str) -> str:
    """The fixed words a match of `words` begins with, as they stand between single blanks."""
    fixed = words.split("[")[0].replace(" ?", "?").split("?")[0]
    return re.sub(NOT_WORD, " ", fixed.lower()).strip()


def anchors_of(keywords: Iterable[str]) -> list[str]:
    """For each keyword a part of one of its words. "cc by" has no rare one; see CC_BY."""
    return sorted({
        next((part for part in ANCHOR_PARTS if part in keyword), max(keyword.split(), key=len))
        for keyword in keywords
        if not f"{keyword} ".startswith("cc by ")
    })


def rules() -> list[tuple[int, str, str, str]]:
    """(priority, label, keyword, regex) in order; all match in either case."""
    out = []

    def add(priority, label, keyword, regex):
        out.append((priority, label, keyword, f"(?i){START}{regex}"))

    notice = spaced("(?:licen[cs]ed|released|distributed|available|provided) under ") + (
        rf"(?:the{GAP}|an?{GAP})?(?:terms{GAP}of{GAP}(?:the{GAP})?)?"
    )
    for label, names, versions, address in FAMILIES:
        for version in versions.split():
            tag = label + "-" + (version if "." in version else version + ".0")
            if label in ("python", "artistic", "php"):
                tag = f"{label}-{version}"
            for words in names.split("|"):
                name, keyword = spaced(words), keyword_of(words)
                add(1, tag, keyword, f"{notice}{name}{NUMBER}{numbered(version)}")
                add(2, tag, keyword, f"{name}{NUMBER}{numbered(version)}")
            add(1, tag, "spdx", rf"spdx-license-identifier:\s*+{re.escape(tag)}")
        for words in names.split("|"):
            add(1, label, keyword_of(words), f"{notice}{spaced(words)}{END}")
            add(3, label, keyword_of(words), spaced(words) + END)
        if not versions:
            add(1, label, "spdx", rf"spdx-license-identifier:\s*+{re.escape(label)}{END}")
        if address:
            add(1, label, keyword_of(address), re.escape(address) + r"[\w./-]{0,24}")
    for kind in CC_KINDS:
        words = GAP.join(spaced(CC_WORDS[part]) for part in kind.split("-"))
        code = "cc" + GAP + kind.replace("-", GAP)
        short = "cc " + kind.replace("-", " ")
        for version in CC_VERSIONS:
            tag = f"cc-{kind}-{version}"
            add(1, tag, short, f"{notice}{code}{NUMBER}{numbered(version)}")
            add(2, tag, short, f"{code}{NUMBER}{numbered(version)}")
            add(1, tag, "creative commons attribution",
                f"{spaced('creative commons ')}{words}{NUMBER}{GAP}?"
                f"(?:{spaced('(?:international|generic|unported) ')})?"
                f"(?:licen[cs]e{GAP})?{numbered(version)}")
            add(1, tag, keyword_of(f"creativecommons.org/licenses/{kind}/{version}"),
                rf"creativecommons\.org/licenses/{kind}/{re.escape(version)}")
        add(2, f"cc-{kind}", short, code + END + f"(?!{GAP}(?:sa|nd|nc){END})")
        add(2, f"cc-{kind}", "creative commons attribution",
            f"{spaced('creative commons ')}{words}{END}(?!{GAP}(?:share|no|non))")
    add(3, "creative-commons", "creative commons", spaced("creative commons") + END)
    add(3, "license-reference", "licen", spaced("see (?:the )?licen[cs]e(?: file)?") + END)
    add(3, "license-notice", "licen", spaced("licen[cs]ed under") + END)
    add(3, "copyright-notice", "copyright", spaced("copyright") + rf"{GAP}(?:c{GAP})?[12][0-9]{{3}}")
    return out


def rule_array(table: list[tuple[int, str, str, str]]) -> Column:
    """The rules as a literal array. Bounded: it is the rules, not data."""
    def part(i: int) -> Column:
        return F.array(*[F.lit(r[i]) for r in table])

    numbers = F.array(*[F.lit(i) for i in range(len(table))])
    return F.arrays_zip(
        numbers.alias("rule"), part(0).alias("priority"), part(1).alias("label"),
        part(2).alias("keyword"), part(3).alias("regex"),
    )


def _hits(text: Column, norm: Column, table: list) -> Column:
    """What each rule with its keyword in the words finds: lengths of the matches, and of what
    stands before each of them. Places come from their sums."""
    def of_rule(rule: Column) -> Column:
        pieces = F.split(text, rule["regex"], -1)
        matches = F.regexp_extract_all(text, rule["regex"], F.lit(0))
        return F.struct(
            rule["rule"].alias("rule"), rule["priority"].alias("priority"),
            rule["label"].alias("label"),
            F.arrays_zip(
                F.transform(pieces, F.length).alias("gap"),
                F.transform(matches, F.length).alias("size"),
            ).alias("places"),
        )

    gated = F.filter(rule_array(table), lambda r: F.contains(norm, r["keyword"]))
    found = F.filter(gated, lambda r: F.regexp_like(text, r["regex"]))
    return F.transform(found, of_rule)


def _base(norm: Column, n_words: Column) -> Column:
    """Places of the fixed phrases in words parted by single blanks."""
    def words(c: Column) -> Column:
        return F.regexp_count(c, F.lit("[^ ]+"))

    pieces = {label: F.split(norm, f"(?<= ){phrase}(?= )", -1) for phrase, label in PHRASES}
    counts = {label: F.size(p) - 1 for label, p in pieces.items()}
    first = [F.when(counts[x] > 0, words(F.element_at(p, 1))) for x, p in pieces.items()]
    last = [
        F.when(
            counts[label] > 0,
            n_words - words(F.element_at(pieces[label], -1)) - len(phrase.split()),
        )
        for phrase, label in PHRASES
    ]
    labels = F.array(*[F.when(counts[label] > 0, F.lit(label)) for _, label in PHRASES])
    return F.struct(
        sum(counts.values(), F.lit(0)).cast("bigint").alias("n_base"),
        F.least(*first).cast("bigint").alias("first_word"),
        F.greatest(*last).cast("bigint").alias("last_word"),
        F.array_sort(F.array_compact(labels)).alias("base"),
    )


def scan_licenses(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    table: list[tuple[int, str, str, str]] | None = None,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of whole
    texts, and n_found, the detections that stay."""
    table = table or rules()
    text, low = F.col("text"), F.col("low")
    marked = F.coalesce(F.rlike(text, F.lit(CC_BY)), F.lit(False))
    phrases = [phrase for phrase, _ in PHRASES]
    for anchor in anchors_of([*phrases, *(keyword for _, _, keyword, _ in table)]):
        marked = marked | F.coalesce(F.contains(low, F.lit(anchor)), F.lit(False))
    norm = F.concat(
        F.lit(" "), F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), NOT_WORD, " ")),
        F.lit(" "),
    )
    plain = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    gated = (
        plain.withColumn("low", F.lower("text"))
        .withColumn("marked", marked)
        .withColumn("n_words", F.regexp_count("text", F.lit(WORD)).cast("bigint"))
        .withColumn("norm", F.when(F.col("marked"), norm))
        # a generator is a barrier: nothing below is computed again for each use
        .withColumn("held", F.explode(F.array(F.struct("norm", "text", "n_words"))))
        .select("doc_id", "marked", "held.*")
    )
    none = F.struct(
        F.lit(0).cast("bigint").alias("n_base"), F.lit(None).cast("bigint").alias("first_word"),
        F.lit(None).cast("bigint").alias("last_word"),
        F.array().cast("array<string>").alias("base"),
    )
    scanned = gated.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "n_words",
        F.when(F.col("marked"), _base(F.col("norm"), F.col("n_words"))).otherwise(none).alias("b"),
        F.when(F.col("marked"), _hits(text, F.col("norm"), table)).alias("hits"),
    )
    rows = (
        scanned.select("row", "doc_id", "n_words", "b", F.explode_outer("hits").alias("hit"))
        .select(
            "row", "doc_id", "n_words", "b", "hit.rule", "hit.priority", "hit.label",
            F.posexplode_outer("hit.places").alias("k", "place"),
        )
        .repartition("row")
    )
    before = Window.partitionBy("row", "rule").orderBy("k")
    size = F.coalesce(F.col("place.size"), F.lit(0))
    placed = rows.withColumn(
        "end", F.sum(F.col("place.gap") + size).over(before)
    ).withColumn("start", F.col("end") - size)
    # the piece after the last match is no detection
    placed = placed.where(F.col("place.size").isNotNull() | F.col("rule").isNull())
    order = [F.col("start"), F.col("end").desc(), F.col("priority"), F.col("rule"), F.col("k")]
    back = [
        F.col("start").desc(), F.col("end"), F.col("priority").desc(), F.col("rule").desc(),
        F.col("k").desc(),
    ]
    earlier = Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("row").orderBy(*back).rowsBetween(Window.unboundedPreceding, -1)
    end, start, priority = F.col("end"), F.col("start"), F.col("priority")
    for level in (1, 2, 3):
        of_level = priority <= level
        placed = placed.withColumn(f"end{level}", F.max(F.when(of_level, end)).over(earlier))
    for level in (1, 2):
        placed = placed.withColumn(
            f"start{level}", F.min(F.when(priority <= level, start)).over(later)
        )

    def at_level(prefix: str, shift: int) -> Column:
        """The running value over the levels up to this priority minus shift."""
        out = F.lit(None).cast("bigint")
        for p in (1, 2, 3):
            if p - shift >= 1:
                out = F.when(priority == p, F.col(f"{prefix}{p - shift}")).otherwise(out)
        return out

    inside = F.coalesce(at_level("end", 0) >= end, F.lit(False))
    overlapped = F.coalesce(at_level("end", 1) > start, F.lit(False)) | F.coalesce(
        at_level("start", 1) < end, F.lit(False)
    )
    kept = F.col("rule").isNotNull() & ~inside & ~overlapped
    found = placed.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.first("b").alias("b"),
        F.collect_set(F.when(kept, F.col("label"))).alias("own"),
        F.sum(kept.cast("bigint")).alias("n_found"),
        F.min(F.when(kept, priority)).alias("best"),
    )
    score = F.greatest(
        *[F.when(F.col("best") == p, F.lit(s)) for p, s in SCORES.items()],
        F.when(F.col("b.n_base") > 0, F.lit(BASE_SCORE)),
        F.lit(0.0),
    )
    return found.select(
        "doc_id",
        "n_words",
        "b.n_base",
        "b.first_word",
        "b.last_word",
        F.array_join("b.base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("b.base", "own")), ",").alias("labels"),
        score.alias("score"),
        "n_found",
    )
