"""Secret scans: fixed patterns, and a token-efficiency test for what they miss.

A tokenizer packs language into few tokens and random strings into many. A run of 16 or more
key characters with a letter is a candidate; it is reported as `random` if it has at most 2.2
characters per token. Keys and values are parted at =, and paths at /, before that. Left out are
digests (by length, or listed as known), UUIDs, timestamps, names made of numbers and of words that
themselves cost few tokens, e-mail addresses and host names. What stands after : . or @ is tested
like all else, and so is the password in user:password@host. Runs of digits alone are not tested:
any number costs many tokens.

Nulls and empty texts have no spans. Repeated rows and ids stay as they are. Spans are in
code points, end exclusive, ordered by start and then by kind.

Very long texts are one row of one task. An empty table gives no rows; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame

from mailspark.llm.common import map_batches, strings, with_id, worker_state

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
KINDS = ("assign", "access", "hex", "random")
MIN_LENGTH = 16
MOST_CHARS_PER_TOKEN = 2.2

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""",
    re.ASCII | re.IGNORECASE,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}+")
HEX = re.compile(r"[0-9a-f]{24,}+")
RUN = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{16,}+")
PART = re.compile(r"[^=]++")
SEGMENT = re.compile(r"[^=/]++")
LETTERS = re.compile(r"[A-Z]?[a-z]++|[A-Z]++")
NAME = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@{NAME}(?:\.{NAME})+")
# user:password@host and ://key@host are no addresses; "mail:name@host" is one
LOGIN = re.compile(r"(?<![A-Za-z0-9])([A-Za-z0-9._%+-]+):$")
MAIL_WORDS = frozenset("mailto mail email e-mail from to cc bcc reply-to contact address".split())
HOST = re.compile(
    rf"(?<=://){NAME}(?:\.{NAME})+(?![A-Za-z0-9-]|:[^0-9\s]|[._%+-]*@)"
    rf"|(?<=@){NAME}(?:\.{NAME})+"
    r"|(?<![A-Za-z0-9._-])(?:[a-z0-9-]++\.)+(?:com|org|net|edu|gov|io|de|fr|es|uk|info|dev|cloud)"
    r"(?![A-Za-z0-9-]|\.[A-Za-z0-9])"
)
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
DIGEST = re.compile("|".join(rf"[0-9a-fA-F]{{{n}}}" for n in DIGEST_LENGTHS))
FIXED = re.compile(
    r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"  # UUID
    r"|\d{4}-?\d\d-?\d\d(?:[T_-]?\d\d-?\d\d(?:-?\d\d)?Z?)?"  # date and time
)
IDENTIFIER = re.compile(
    # words, each with a number at its end: user_id_2024, Licence-v2, chapter12Section4
    # possessive: letters belong to one word only, so a run that fails is not tried in other splits
    r"(?:[-_/=+]*+(?:[A-Z]?[a-z]{3,}+|[A-Z]{3,}+|v)[0-9]{0,4}+)++"
    r"(?:[-_/=+]++[0-9]{1,8}+)*+[-_/=+]*+"
)


def load_ranks(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        found += [
            (m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6
        ]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def addresses(text: str) -> list[tuple[int, int]]:
    """Places of e-mail addresses and host names."""
    found = []
    if "@" in text:
        for m in EMAIL.finditer(text):
            start = m.start()
            login = LOGIN.search(text, max(0, start - 64), start)
            if login and login[1].lower() not in MAIL_WORDS:
                continue
            if text[max(0, start - 3) : start] != "://":
                found.append(m.span())
    if "." in text:
        found += [m.span() for m in HOST.finditer(text)]
    return found


def is_name(run: str, count, most: float) -> bool:
    """Digests, UUIDs, times, and names of words and numbers; not letters that are no words."""
    if DIGEST.fullmatch(run) or FIXED.fullmatch(run):
        return True
    if not IDENTIFIER.fullmatch(run):
        return False
    words = LETTERS.findall(run)
    return sum(map(len, words)) > most * sum(map(count, words))


def random_spans(
    text: str, taken: list[tuple[int, int, str]], count, most: float, known: frozenset
) -> list[tuple[int, int, str]]:
    """Runs that cost too many tokens and overlap none of `taken`."""
    found, named = [], None
    for m in RUN.finditer(text):
        start, end = m.span()
        if any(a < end and start < b for a, b, _ in taken):
            continue
        path = "/" in m[0] and is_path(text, start, m[0], count, most)
        for piece in (SEGMENT if path else PART).finditer(text, start, end):
            run = piece[0].strip("-_/+")
            if len(run) < MIN_LENGTH or not any(c.isalpha() for c in run):
                continue
            if len(run) > most * count(run):
                continue
            if run.lower() in known or is_name(run, count, most):
                continue
            at = piece.start() + piece[0].index(run)
            if named is None:
                named = addresses(text)
            if not any(a < at + len(run) and at < b for a, b in named):
                found.append((at, at + len(run), "random"))
    return found


def is_path(text: str, start: int, run: str, count, most: float) -> bool:
    """Slashes part a path if it begins like one or a part of it is a word; base64 has them too."""
    if run[0] == "/" or text[start - 1 : start] in (".", "~", ":", "@") and start:
        return True
    return any(
        len(x) > 2 and x.isalpha() and IDENTIFIER.fullmatch(x) and len(x) > most * count(x)
        for x in run.split("/")
    )


def joined(spans: list[tuple[int, int, str]], kinds: tuple[str, ...]) -> str:
    """kind:start:end by start, then by the place of the kind in `kinds`."""
    order = sorted(spans, key=lambda s: (s[0], kinds.index(s[2]), s[1]))
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in order)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def scan_secrets(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    path: str = VOCABULARY,
    most_chars_per_token: float = MOST_CHARS_PER_TOKEN,
    known_digests: frozenset = frozenset(),
) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of whole texts;
    narrow, no shuffle. `known_digests` are lower-case strings that are no secrets."""

    def run(batch: pa.RecordBatch) -> dict:
        encoding = worker_state(("ranks", path), lambda: load_ranks(path))

        def count(run: str) -> int:
            return len(encoding.encode_ordinary(run))

        out: dict = {k: [] for k in ("assign", "access", "hex", "base", "spans", "random")}
        for text in strings(batch.column(1)):
            base = base_spans(text)
            more = random_spans(text, base, count, most_chars_per_token, known_digests)
            kinds = [kind for _, _, kind in base]
            for kind in KINDS[:3]:
                out[kind].append(kinds.count(kind))
            out["base"].append(sha256(joined(base, KINDS)))
            out["spans"].append(joined(base + more, KINDS))
            out["random"].append(len(more))
        return {
            "doc_id": batch.column(0),
            "n_assign": out["assign"],
            "n_access": out["access"],
            "n_hex": out["hex"],
            "base_sha256": out["base"],
            "spans": out["spans"],
            "n_random": out["random"],
        }

    return map_batches(
        with_id(docs, text_col, id_col),
        run,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, "
        "base_sha256 string, spans string, n_random bigint",
    )
