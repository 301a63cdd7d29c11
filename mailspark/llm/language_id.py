"""Language of each span of a mixed-language text.

Script ranges narrow the languages a word can be in. A word's score for each of them is the
sum of its trigrams' log probabilities; the best labelling of all words is Viterbi's, with a
penalty for each switch of language. The text's language is the one with most letters.

The model is fitted on a bounded sample of labelled rows (`train_docs` a language, chosen by a
hash of the id); its tables grow with that sample, not with the corpus. Prediction reads the
text alone and is narrow.

Words are letters (Unicode's, with the marks after them): digits and other numbers are none. A text
whose words all score best in one language is that language's without a search. Memory of the
search is a few bytes a word and language. Null texts, texts without a letter, and all texts if nothing was learned are `und`, with score
0. Ties go to the language first in order. Repeated rows and ids stay as they are; rows without
id or language are not learned from. An empty table teaches nothing and gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailspark.llm.common import as_rows, map_batches, only_state, strings, with_id

UNDETERMINED = "und"
TRAIN_DOCS = 2000
GRAMS_A_LANGUAGE = 10_000
SWITCH_PENALTY = 14.0
OUTSIDE_SCRIPT = -60.0
LEAST_SHARE = 0.01
CACHE_BYTES = 48 * 1024 * 1024
HELD_OUT = (4, 2)  # crc32 of the id, modulo and remainder

# A letter, and the letters and marks after it; no digits or other characters that are numbers
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
# First code point of each block of letters, and its script.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "other"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1380, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB1D, "hebrew"),
    (0xFB50, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"), (0x10000, "other"),
    (0x20000, "han"), (0x32000, "other"),
]
STARTS = [start for start, _ in SCRIPTS]


def script_of(char: str) -> str:
    return SCRIPTS[bisect_right(STARTS, ord(char)) - 1][1]


def grams_of(word: str) -> list[str]:
    """Trigrams of a word between blanks."""
    padded = f" {word} "
    return [padded[i : i + 3] for i in range(len(word))]


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def is_held_out(id_col: Column) -> Column:
    modulo, rest = HELD_OUT
    code = F.crc32(id_col.cast("string").cast("binary"))
    return F.coalesce(F.pmod(code, F.lit(modulo)) == rest, F.lit(False))


class Model:
    """Languages, trigram log probabilities, and the scripts each language is written in."""

    def __init__(self, langs: list, grams: list, logs: np.ndarray, outside: dict):
        self.langs = langs
        self.index = {g: i for i, g in enumerate(grams)}
        self.logs = np.vstack([logs, np.zeros((1, len(langs)))])  # last: grams not learned
        self.outside = outside  # script -> which languages are not written in it
        self.words: dict[str, int] = {}
        self.limit = max(1000, CACHE_BYTES // (8 * len(langs) + 150))
        self.scores = np.empty((0, len(langs)))

    def parts(self) -> tuple:
        """What to broadcast; Model(*parts) is the model."""
        return self.langs, list(self.index), self.logs[:-1], self.outside

    def rows(self, words: list[str]) -> np.ndarray:
        """Index of each word in self.scores, where unknown words are added."""
        if len(self.words) > self.limit:
            self.words, self.scores = {}, np.empty((0, len(self.langs)))
        known = self.words
        new = [w for w in dict.fromkeys(words) if w not in known]
        if new:
            missing = len(self.index)
            grams = [grams_of(w) for w in new]
            at = np.fromiter(
                (self.index.get(g, missing) for gs in grams for g in gs), dtype=np.int64
            )
            sizes = np.fromiter(map(len, grams), dtype=np.int64, count=len(grams))
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            scores = np.add.reduceat(self.logs[at], starts, axis=0)
            for i, w in enumerate(new):
                outside = self.outside.get(script_of(w[0]))
                if outside is not None:
                    scores[i, outside] += OUTSIDE_SCRIPT
                known[w] = len(self.scores) + i
            self.scores = np.vstack([self.scores, scores])
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def label(self, texts: list[str]) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
        """Language, share of its letters, and spans (language, first word, end) of each."""
        docs = [words_of(t) for t in texts]
        out: list = [(UNDETERMINED, 0.0, []) for _ in docs]
        order = sorted((i for i, d in enumerate(docs) if d), key=lambda i: -len(docs[i]))
        if not order or not self.langs:
            return out
        rows = self.rows([w for i in order for w in docs[i]])
        sizes = np.array([len(docs[i]) for i in order])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        path = labels(self.scores, rows, starts, sizes)
        letters = np.fromiter((len(w) for i in order for w in docs[i]), dtype=np.int64)
        k = len(self.langs)
        doc = np.repeat(np.arange(len(order)), sizes)
        share = np.bincount(doc * k + path, letters, len(order) * k).reshape(-1, k)
        best = share.argmax(axis=1)
        score = share[np.arange(len(order)), best] / share.sum(axis=1)
        first = np.ones(len(path), dtype=bool)
        first[1:] = (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])
        cuts = np.flatnonzero(first)
        ends = np.append(cuts[1:], len(path))
        for a, b in zip(cuts.tolist(), ends.tolist()):
            d = doc[a]
            i = order[d]
            out[i][2].append((self.langs[path[a]], int(a - starts[d]), int(b - starts[d])))
        for d, i in enumerate(order):
            out[i] = (self.langs[best[d]], float(score[d]), out[i][2])
        return out


def labels(
    scores: np.ndarray, rows: np.ndarray, starts: np.ndarray, sizes: np.ndarray
) -> np.ndarray:
    """Best language of every word. Where one language is best for each word of a text, it is the
    text's: no labelling scores more, and none of those that score as much comes before it. Other
    texts are searched."""
    path = np.empty(len(rows), dtype=np.int64)
    if not len(rows):
        return path
    top = scores[rows].max(axis=1)
    reaches = np.logical_and.reduceat(scores[rows] == top[:, None], starts, axis=0)
    plain = reaches.any(axis=1)
    path[:] = np.repeat(reaches.argmax(axis=1), sizes)
    hard = np.flatnonzero(~plain)
    if len(hard):
        of_word = np.repeat(~plain, sizes)
        own = sizes[hard]
        path[of_word] = viterbi(scores, rows[of_word], np.cumsum(own) - own, own)
    return path


def viterbi(
    scores: np.ndarray,
    rows: np.ndarray,
    starts: np.ndarray,
    sizes: np.ndarray,
    penalty: float = SWITCH_PENALTY,
) -> np.ndarray:
    """Best language of every word, for all texts at once: step t handles the t-th word of
    each text that has one. Texts come longest first."""
    steps = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # texts longer than t
    value = scores[rows[starts]]
    own_states = np.arange(scores.shape[1])
    narrow = np.uint8 if scores.shape[1] < 256 else np.uint16
    back = [None]
    for t in range(1, steps):
        n = active[t]
        now = value[:n]
        best = now.argmax(axis=1)
        jump = now.max(axis=1)[:, None] - penalty
        move = now < jump
        value[:n] = np.where(move, jump, now) + scores[rows[starts[:n] + t]]
        # language to come from: its own, or the best one
        back.append(np.where(move, best[:, None], own_states[None, :]).astype(narrow))
    path = np.empty(len(rows), dtype=np.int64)
    state = value.argmax(axis=1)
    every = np.arange(len(sizes))
    for t in range(steps - 1, 0, -1):
        n = active[t]
        path[starts[:n] + t] = state[:n]
        state[:n] = back[t][every[:n], state[:n]]
    path[starts] = state
    return path


def learn(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    train_docs: int = TRAIN_DOCS,
    grams_a_language: int = GRAMS_A_LANGUAGE,
) -> Model:
    """Fits the model on about `train_docs` rows of each language, all not held out, and its
    `grams_a_language` commonest trigrams."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).where(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~is_held_out(F.col("id")))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], [], np.empty((0, 0)), {})
    rate = F.create_map(*[F.lit(x) for k in langs for x in (k, train_docs / sizes[k])])
    uniform = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = rows.where(uniform < rate[F.col("lang")]).select("lang", "text")

    def count(batches):
        only_state(("language",), dict)  # what steps before have left in the worker goes
        grams: Counter = Counter()
        for batch in batches:
            words: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), strings(batch.column(1))):
                words.update((lang, w) for w in words_of(text))
            for (lang, word), n in words.items():
                for g in grams_of(word):
                    grams[lang, "gram", g] += n
                grams[lang, "script", script_of(word[0])] += n
        if grams:
            columns = [list(x) for x in zip(*[(*k, n) for k, n in grams.items()])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["lang", "kind", "part", "n"]
            )

    commonest = Window.partitionBy("lang", "kind").orderBy(F.col("n").desc(), "part")
    counted = (
        sample.mapInArrow(count, "lang string, kind string, part string, n bigint")
        .groupBy("lang", "kind", "part")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(commonest))
        .where(F.col("place") <= grams_a_language)
        .collect()
    )  # so many trigrams a language, and a few scripts
    of = {lang: i for i, lang in enumerate(langs)}
    grams = sorted({r["part"] for r in counted if r["kind"] == "gram"})
    at = {g: i for i, g in enumerate(grams)}
    counts, scripts = np.full((len(grams), len(langs)), 0.5), {}
    for r in counted:
        if r["kind"] == "gram":
            counts[at[r["part"]], of[r["lang"]]] += r["n"]
        else:
            scripts.setdefault(r["part"], np.zeros(len(langs)))[of[r["lang"]]] = r["n"]
    logs = np.log(counts / counts.sum(axis=0)) if grams else counts
    words = sum(scripts.values()) if scripts else np.ones(len(langs))
    outside = {s: n < LEAST_SHARE * np.maximum(words, 1) for s, n in scripts.items()}
    return Model(langs, grams, logs, {s: o for s, o in outside.items() if not o.all()})


def identify(
    docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, spans) of whole texts. Spans are language:first
    word:end, in words; score is the share of letters in spans of the language."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model.parts()), uuid.uuid4().hex

    def run(batch: pa.RecordBatch) -> dict:
        own = only_state(("language", key), lambda: Model(*shared.value))
        found = own.label(strings(batch.column(1)))
        return {
            "doc_id": batch.column(0),
            "lang_pred": [lang for lang, _, _ in found],
            "score": [score for _, score, _ in found],
            "spans": [",".join(f"{x}:{a}:{b}" for x, a, b in spans) for _, _, spans in found],
        }

    labelled = map_batches(
        with_id(docs, text_col, id_col),
        run,
        "doc_id bigint, lang_pred string, score double, spans string",
    )
    held_out = is_held_out(F.col("doc_id")).alias("held_out")
    return labelled.select("doc_id", held_out, "lang_pred", "score", "spans")


def keep_identified(
    docs: DataFrame, model: Model, text_col: str = "text", least_score: float = 0.0
) -> DataFrame:
    """The rows, with all their columns, whose text has a language; `und` goes, and so does
    what scores below `least_score`."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model.parts()), uuid.uuid4().hex
    rows = as_rows(docs)

    def run(batches):
        for batch in batches:
            own = only_state(("language", key), lambda: Model(*shared.value))
            found = own.label(strings(batch.column(0).field(text_col)))
            yield batch.filter(
                pa.array([x != UNDETERMINED and s >= least_score for x, s, _ in found], pa.bool_())
            )

    return rows.mapInArrow(run, rows.schema).select("__row.*")
