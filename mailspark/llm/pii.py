"""Personal data by weak supervision.

Fixed patterns give the base spans. Further candidates (numbers and addresses written in
other ways, named people) are only proposed. Labelers then vote on every span: a pattern
labeler (its checks), a gazetteer labeler (known domains' endings, networks, given names), and
context labelers (words before the span that speak for or against its kind, what touches it).
Expectation-maximisation over the counted vote vectors estimates how reliable each labeler is,
without labels; its posteriors train the final span classifier, a logistic regression on votes,
kind and shape. The classifier decides on the proposed spans; base spans always stay.

Only counts of distinct (kind, votes, shape) rows reach the driver: at most KINDS x 3^labelers x
shapes rows, whatever the size of the input.

Nulls and empty texts have no spans. Repeated rows and ids stay as they are. Spans are in code
points, end exclusive. With no candidates at all the prior rules stand.

Very long texts are one row of one task. An empty table teaches no reliabilities and gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mailspark.llm.common import map_batches, strings, with_id
from mailspark.llm.secret_scan import joined, sha256
from mailspark.session import cut_lineage

BASE = ("email", "ip", "card", "phone")
ADDED = ("email_words", "ip6", "phone_local", "iban", "national_id", "person")
KINDS = BASE + ADDED
LABELERS = ("pattern", "gazetteer", "context_for", "context_against", "edges")
SHAPES = 4
THRESHOLD = 0.5
CONTEXT = 32

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
PART = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

PROPOSED = {
    "email_words": re.compile(
        r"\b[a-z0-9_-]{2,40}+ ?[\[(]? ?(?:at|AT) ?[\])]? ?[a-z0-9-]{2,40}+ ?"
        r"[\[(]? ?(?:dot|DOT) ?[\])]? ?[a-z]{2,6}\b"
    ),
    "ip6": re.compile(r"(?<![0-9A-Za-z:])(?:[0-9a-f]{1,4}:){4,7}[0-9a-f]{1,4}(?![0-9A-Za-z:])"),
    "phone_local": re.compile(
        r"(?<![0-9A-Za-z+.])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9A-Za-z])"
    ),
    "iban": re.compile(
        r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
    ),
    "national_id": re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    "person": re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof)\. [A-Z][a-z]+(?: [A-Z][a-z]+)?"),
}
# Generic endings of domains; those of two letters are countries'.
ENDINGS = frozenset(
    "com org net edu gov mil int info biz name pro aero coop museum jobs mobi tel travel cat asia "
    "post app dev online site shop store tech cloud email page blog example test invalid".split()
)
# How many characters an account number of a country has.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_LENGTHS = {land: n for n, lands in IBAN_LENGTHS.items() for land in lands.split()}
GIVEN_NAMES = frozenset(
    "james mary john anna maria peter paul linda robert susan david laura hans karl julia marie "
    "jean pierre luc claire jose juan carlos carmen ana luis elena thomas michael sarah".split()
)
WORDS_FOR = {
    "email": "mail e-mail contact write reach courriel correo", "ip": "ip host address server",
    "card": "card visa credit mastercard karte carte tarjeta", "phone": "phone call tel fax mobile",
    "email_words": "mail e-mail contact write reach", "ip6": "ip host address server",
    "phone_local": "phone call tel fax mobile telephone", "iban": "iban account bank konto",
    "national_id": "ssn social security", "person": "name dear signed by patient",
}
WORDS_AGAINST = frozenset(
    "version release isbn order invoice section chapter page figure table build sku".split()
)
WORDS_FOR = {k: frozenset(v.split()) for k, v in WORDS_FOR.items()}
WORD = re.compile(r"[a-z-]{2,}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int, str]]:
    """Works from each @ outwards, so a long run of letters is read once."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        end = at + 1
        if start < at and (m := DOMAIN.match(text, at)):
            end = done = m.end()
            found.append((start, end, "email"))
        else:
            done = end
        at = text.find("@", end)
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = emails(text) if "@" in text else []
    if not DIGIT.search(text):
        return found
    for m in DOTTED.finditer(text):
        parts = [(p.start(), p.end()) for p in PART.finditer(text, *m.span())]
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            if all(int(text[a:b].lstrip("0")[:4] or "0") <= 255 for a, b in four):
                found.append((four[0][0], four[3][1], "ip"))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((*m.span(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m[0])) <= 15:
                found.append((*m.span(), "phone"))
    return found


def proposed_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Candidates beside the base spans; of overlapping ones the first stays, and on a tie
    the longer."""
    found = []
    digits = DIGIT.search(text) is not None
    dot = "dot" in text or "DOT" in text
    for kind, pattern in PROPOSED.items():
        if kind == "email_words" and not dot or kind == "person" and ". " not in text:
            continue
        if kind not in ("email_words", "person", "ip6") and not digits:
            continue
        if kind == "ip6" and text.count(":") < 4:
            continue
        found += [(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    # both lists by place, so each base span is passed once; kinds of base spans may overlap
    kept, spans, at, reached = [], sorted(base), 0, 0
    for a, b, kind in sorted(found, key=lambda s: (s[0], -s[1], KINDS.index(s[2]))):
        while at < len(spans) and spans[at][0] <= a:
            reached = max(reached, spans[at][1])
            at += 1
        free = reached <= a and (at == len(spans) or b <= spans[at][0])
        if free and (not kept or kept[-1][1] <= a):
            kept.append((a, b, kind))
    return kept


def in_number_plan(digits: list[str]) -> bool:
    """Ten digits of the North American plan: area and exchange begin with 2 to 9 and are no
    service codes."""
    return all(d[0] > "1" and d[1:] != ["1", "1"] for d in (digits[:3], digits[3:6]))


def is_iban(body: str) -> bool:
    """The length of its country, and the check digits."""
    plain = body.replace(" ", "")
    moved = plain[4:] + plain[:4]
    return len(plain) == IBAN_LENGTHS.get(plain[:2]) and (
        int("".join(str(int(c, 36)) for c in moved)) % 97 == 1
    )


def is_ending(last: str) -> bool:
    return last in ENDINGS or len(last) == 2


def votes(text: str, span: tuple[int, int, str]) -> list[int]:
    """One vote of each labeler: 1 for personal data, -1 against, 0 no opinion."""
    start, end, kind = span
    body = text[start:end]
    before = WORD.findall(text[max(0, start - CONTEXT) : start].lower())
    digits = [c for c in body if c.isdigit()]
    # pattern: the strict forms pass their checks; a number of one repeated digit is none
    pattern = 1 if kind in BASE or kind == "ip6" else 0
    if kind == "phone_local":
        pattern = 1 if in_number_plan(digits) else -1
    if kind == "iban":
        pattern = 1 if is_iban(body) else -1
    if kind == "national_id":
        pattern = -1 if body[:3] in ("000", "666") or body[0] == "9" or body[4:6] == "00" else 1
    if len(digits) > 5 and len(set(digits)) == 1:
        pattern = -1
    gazetteer = 0
    if kind in ("email", "email_words"):
        gazetteer = 1 if is_ending(re.split(r"[^a-z]+", body.lower())[-1]) else -1
    elif kind == "ip":
        gazetteer = -1 if body.startswith(("127.", "0.", "255.")) else 1
    elif kind == "person":
        gazetteer = 1 if body.split()[1].lower() in GIVEN_NAMES else 0
    elif kind == "card":
        gazetteer = 1 if digits[0] in "3456" else -1
    elif kind == "iban":
        gazetteer = 1 if body[:2] in IBAN_LENGTHS else -1
    edge = text[start - 1 : start] + text[end : end + 1]
    return [
        pattern,
        gazetteer,
        1 if WORDS_FOR[kind] & set(before) else 0,
        -1 if WORDS_AGAINST & set(before[-2:]) else 0,
        -1 if any(c.isalnum() or c in "_/=" for c in edge) else 1,
    ]


def find_candidates(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Each document with its spans and, for each span, kind, votes and shape as a key."""

    def run(batch: pa.RecordBatch) -> dict:
        ids, base_out, starts, ends, keys = batch.column(0), [], [], [], []
        for text in strings(batch.column(1)):
            base = base_spans(text)
            both = base + proposed_spans(text, base)
            base_out.append(joined(base, KINDS))
            starts.append([a for a, _, _ in both])
            ends.append([b for _, b, _ in both])
            keys.append([
                f"{s[2]}|{'|'.join(map(str, votes(text, s)))}|{min((s[1] - s[0]) // 8, SHAPES - 1)}"
                for s in both
            ])
        return {
            "doc_id": ids, "base": base_out, "starts": starts, "ends": ends, "keys": keys
        }

    return map_batches(
        with_id(docs, text_col, id_col),
        run,
        "doc_id bigint, base string, starts array<bigint>, ends array<bigint>, keys array<string>",
    )


def expectation_maximisation(
    vote: np.ndarray, kind: np.ndarray, n: np.ndarray, rounds: int = 50
) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of the distinct rows, and each labeler's P(vote | truth).

    vote: rows x labelers in {-1, 0, 1}; kind: the row's kind, which has its own prior; n: how
    often the row occurs. Labelers are independent given the truth; counts are smoothed.
    """
    rows, labelers = vote.shape
    given = np.empty((labelers, 2, 3))  # labeler, truth, vote + 1
    given[:, 1], given[:, 0] = (0.1, 0.3, 0.6), (0.6, 0.3, 0.1)
    # the pattern's vote against is a check that failed: hardly ever so for real data
    given[LABELERS.index("pattern"), 1] = (0.01, 0.39, 0.6)
    prior = np.full(len(KINDS), 0.5)
    post = np.full(rows, 0.5)
    start = given * 20
    for _ in range(rounds):
        at = np.arange(labelers)
        logs = np.log(given[at, :, vote + 1]).sum(axis=1)  # rows x truth
        odds = logs[:, 1] - logs[:, 0] + np.log(prior[kind] / (1 - prior[kind]))
        post = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        weight = np.stack([(1 - post) * n, post * n])
        for v in range(3):
            given[:, :, v] = start[:, :, v] + (weight @ (vote == v - 1)).T
        given /= given.sum(axis=2, keepdims=True)
        yes = np.bincount(kind, post * n, len(KINDS)) + 5
        prior = yes / (np.bincount(kind, n, len(KINDS)) + 10)
    return post, given


def features(vote: np.ndarray, kind: np.ndarray, shape: np.ndarray) -> np.ndarray:
    return np.concatenate(
        [vote == 1, vote == -1, np.eye(len(KINDS))[kind], np.eye(SHAPES)[shape]], axis=1
    ).astype(float)


def fit_classifier(x: np.ndarray, y: np.ndarray, n: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft labels, by Newton steps with a ridge."""
    w = np.zeros(x.shape[1])
    scale = n / max(1.0, n.sum()) * len(n)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (scale * (y - p)) - 0.1 * w
        curve = (x * (scale * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w += np.linalg.solve(curve, slope)
    return w


def learn_decisions(candidates: DataFrame) -> dict[str, float]:
    """key -> probability of personal data, by the classifier."""
    counted = (
        candidates.select(F.explode("keys").alias("key")).groupBy("key").count().collect()
    )  # bounded: distinct keys only
    if not counted:
        return {}
    rows = sorted((r["key"], r["count"]) for r in counted)
    parts = [key.split("|") for key, _ in rows]
    kind = np.array([KINDS.index(p[0]) for p in parts])
    vote = np.array([[int(v) for v in p[1:-1]] for p in parts])
    shape = np.array([int(p[-1]) for p in parts])
    n = np.array([count for _, count in rows], dtype=float)
    post, _ = expectation_maximisation(vote, kind, n)
    x = features(vote, kind, shape)
    w = fit_classifier(x, post, n)
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return {key: float(v) for (key, _), v in zip(rows, p)}


def find_personal_data(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of whole texts.

    Texts are read once; the candidates, far smaller, are checkpointed, counted, and judged.
    """
    candidates = cut_lineage(find_candidates(docs, text_col, id_col))
    decided = learn_decisions(candidates)

    def run(batch: pa.RecordBatch) -> dict:
        out: dict = {k: [] for k in (*BASE, "sha", "spans", "added")}
        lists = (batch.column(i).to_pylist() for i in range(1, 5))
        for base, starts, ends, keys in zip(*lists):
            spans = [(a, b, k.split("|")[0]) for a, b, k in zip(starts, ends, keys)]
            kept = [
                s for s, k in zip(spans, keys) if s[2] in BASE or decided[k] >= threshold
            ]
            kinds = [kind for _, _, kind in kept]
            for kind in BASE:
                out[kind].append(kinds.count(kind))
            out["sha"].append(sha256(base))
            out["spans"].append(joined(kept, KINDS))
            out["added"].append(sum(kind in ADDED for kind in kinds))
        return {
            "doc_id": batch.column(0),
            **{f"n_{k}": out[k] for k in BASE},
            "base_sha256": out["sha"], "spans": out["spans"], "n_added": out["added"],
        }

    return map_batches(
        candidates,
        run,
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
        "base_sha256 string, spans string, n_added bigint",
    )
