"""Periodic runs of words: stretches with a smallest period that repeat it three times or more.

A run of period q is a stretch of places i at which word i equals word i + q, and q words more.
Periods are taken by octaves, from one power of two to the next. For an octave a text is cut into
tiles that overlap: one for each boundary, from `stride` words before it to four strides after it.
A run's stretch covers two strides at least, so the whole block after some boundary, of one
stride, lies in it; only tiles whose block comes again a period later are looked at further.
There the Z-functions of the words after the boundary, and of those before it in reverse, give how
far each period reaches within the tile. That is a fragment (period, start, end); a fragment that
has a shorter period dividing its own belongs to that one's run and is left out.

Tiles are solved without knowing of each other, where the text is: a text is one value of one row,
so sending its tiles elsewhere would only copy it. Fragments are shuffled by document and period
and stitched where they touch. Texts with fragments meet their runs in one shuffle; all others
never move.

Null and empty texts have no words. Very long texts take memory and time in proportion to their
words and the number of octaves. Repeated rows and ids are documents of their own. An empty table
gives no rows; other columns are ignored by the report and kept by collapse_runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from mailspark.llm.common import as_rows, with_id
from mailspark.session import scratch_dir

# A run has at least so many words, and so many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
LEAST_STRIDE = 8
FRAGMENTS = "array<struct<period: bigint, start: bigint, end: bigint>>"
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
REPORT = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, "
    "exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"
)
U64 = np.uint64


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of the texts in turn, the same for the same word, and how many
    words each text has. Words are what stands between blanks and characters 9 to 13."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat = split.flatten()
    text = np.repeat(np.arange(len(texts)), np.asarray(pc.list_value_length(split)))
    full = np.asarray(pc.not_equal(flat, ""))
    coded = flat.filter(pa.array(full)).dictionary_encode()
    return (
        np.asarray(coded.indices).astype(np.int64),
        np.bincount(text[full], minlength=len(texts)).astype(np.int64),
    )


def joined_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of the hashes of two neighbouring stretches that of both."""
    x = a * U64(0x9E3779B97F4A7C15) ^ (b + U64(0x632BE59BD9B4E019)) * U64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> U64(29))


def z_function(word: list) -> list[int]:
    """For each place the length of the longest prefix of the whole that begins there."""
    n = len(word)
    out = [0] * n
    if n:
        out[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(out[i - left], right - i) if i < right else 0
        while i + k < n and word[k] == word[i + k]:
            k += 1
        out[i] = k
        if i + k > right:
            left, right = i, i + k
    return out


def prime_factors(n: int) -> list[int]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*out, n] if n > 1 else out


def solve_tile(words: list, boundary: int, stride: int, periods: list[int]) -> list[tuple]:
    """(period, start, end) of each of some periods around a boundary of a tile; places are
    those of the tile."""
    after = z_function(words[boundary:])
    span = min(len(words), boundary + 2 * stride)
    before = words[:boundary][::-1]
    # None equals no word
    back = z_function([*before, None, *words[:span][::-1]])[len(before) + 1 :]

    def reach(q: int) -> tuple[int, int]:
        end = boundary + q
        return min(boundary, back[span - end] if end < span else 0), after[q]

    out = []
    for q in periods:
        b, f = reach(q)
        for prime in prime_factors(q):
            d = q // prime
            less, more = reach(d)
            if less >= b and more + d >= f + q:
                break
        else:
            out.append((q, boundary - b, boundary + f))
    return out


def fragments(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, period, start, end) of the fragments of all texts of a batch, octave by octave;
    places are those of the text."""
    found = []
    ends = np.cumsum(counts)
    low = 1
    texts = np.flatnonzero(counts >= LEAST_WORDS)
    while True:
        texts = texts[counts[texts] >= LEAST_PERIODS * low]
        if not len(texts):
            break
        stride = max(LEAST_STRIDE, low)
        # the texts end to end; a word of its own after each keeps stretches inside their text
        parts = [codes[ends[t] - counts[t] : ends[t]] for t in texts]
        own = np.arange(len(texts)) + len(codes) + 1
        words = np.concatenate([x for part, sep in zip(parts, own) for x in (part, [sep])])
        sizes = counts[texts] + 1
        starts = np.cumsum(sizes) - sizes
        found.extend(_octave(words, texts, starts, counts[texts], low, stride))
        low *= 2
    if not found:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    return tuple(np.array(x, dtype=np.int64) for x in zip(*found))


def _octave(words, texts, starts, counts, low, stride) -> Iterator[tuple]:
    blocks, size = words.astype(U64), 1
    while size < stride:
        blocks = joined_hash(blocks[:-size], blocks[size:])
        size *= 2
    # every boundary of every text, and the hashes of the blocks a period after it
    n_tiles = -(-counts // stride)
    of = np.repeat(np.arange(len(texts)), n_tiles)
    inside = (np.arange(len(of)) - np.repeat(np.cumsum(n_tiles) - n_tiles, n_tiles)) * stride
    at = starts[of] + inside
    fits = at + low + stride <= len(words)
    of, inside, at = of[fits], inside[fits], at[fits]
    padded = np.concatenate([blocks, np.zeros(low, dtype=U64)])
    later = np.lib.stride_tricks.sliding_window_view(padded, low)
    step = max(1, 4_000_000 // low)
    for first in range(0, len(at), step):
        some = at[first : first + step]
        same = later[some + low] == blocks[some][:, None]
        # a block needs a whole stride of words
        same &= (some[:, None] + low + np.arange(low) + stride) <= len(words)
        tile, shift = np.nonzero(same)
        if not len(tile):
            continue
        cuts = np.flatnonzero(np.diff(tile, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            k = first + int(tile[a])
            text = int(of[k])
            start = max(0, int(inside[k]) - stride)
            end = min(int(counts[text]), int(inside[k]) + 4 * stride)
            own = int(starts[text])
            part = words[own + start : own + end].tolist()
            boundary = int(inside[k]) - start
            periods = [
                q for q in (shift[a:b] + low).tolist()
                if q * LEAST_PERIODS <= counts[text] and boundary + q < len(part)
            ]
            for q, x, y in solve_tile(part, boundary, stride, periods):
                if y - boundary >= stride:
                    yield int(texts[text]), q, start + x, start + y


def _fragment_lists(batch: pa.Array) -> pa.Array:
    codes, counts = word_codes(batch)
    text, period, start, end = fragments(codes, counts)
    order = np.lexsort((start, period, text))
    values = pa.StructArray.from_arrays(
        [pa.array(x[order]) for x in (period, start, end)], names=["period", "start", "end"]
    )
    cuts = np.searchsorted(text[order], np.arange(len(batch) + 1))
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), values)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _staged(docs: DataFrame, keep_texts: bool) -> DataFrame:
    """(row, doc_id, text, sha, fragments), written and read again. A text without fragments is
    kept only if asked for; else the digest of its words stands for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = _fragment_lists(batch.column(1))
            none = np.asarray(pc.equal(pc.list_value_length(found), 0))
            texts = batch.column(1)
            digests = pa.nulls(batch.num_rows, pa.string())
            if not keep_texts:
                digests = pa.array([
                    _sha(b" ".join(words_of(t))) if alone else None
                    for t, alone in zip(texts.to_pylist(), none.tolist())
                ], pa.string())
                texts = pc.if_else(pa.array(none), pa.scalar(None, texts.type), texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), texts, digests, found],
                names=["doc_id", "text", "sha", "fragments"],
            )

    path = scratch_dir(docs.sparkSession, "fragments")
    (
        docs.mapInArrow(run, f"doc_id bigint, text string, sha string, fragments {FRAGMENTS}")
        .withColumn("row", F.monotonically_increasing_id())
        .write.parquet(path)
    )
    return docs.sparkSession.read.parquet(path)


def _stitched(staged: DataFrame) -> DataFrame:
    """(row, start, length, period) of the runs: fragments of a document and period that touch
    or overlap are one."""
    pieces = staged.select("row", F.inline("fragments"))
    by_start = Window.partitionBy("row", "period").orderBy("start", "end")
    before = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    is_new = (before.isNull() | (F.col("start") > before)).cast("int")
    island = F.sum("is_new").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    merged = (
        pieces.withColumn("is_new", is_new).withColumn("island", island)
        .groupBy("row", "period", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    length = F.col("end") - F.col("start") + F.col("period")
    least = F.greatest(F.lit(LEAST_WORDS), LEAST_PERIODS * F.col("period"))
    return merged.select("row", "start", length.alias("length"), "period").where(length >= least)


def find_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, start, length, period) of every run; start counts words from 0."""
    staged = _staged(with_id(docs, text_col, id_col), keep_texts=False)
    return _stitched(staged).join(staged.select("row", "doc_id"), "row").select(
        "doc_id", "start", "length", "period"
    )


def _with_runs(staged: DataFrame) -> DataFrame:
    """Texts with fragments, and their runs by start and period."""
    runs = _stitched(staged).groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs")
    )
    return staged.where(F.size("fragments") > 0).join(runs, "row", "left").withColumn(
        "runs", F.coalesce("runs", F.array().cast(RUNS))
    )


def kept_words(words: list[bytes], runs: list[dict]) -> list[bytes]:
    """Without those that a run holds after its first period."""
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for r in runs:
        edges[r["start"] + r["period"]] += 1
        edges[r["start"] + r["length"]] -= 1
    inside = np.cumsum(edges)[:-1] > 0
    return [w for w, out in zip(words, inside.tolist()) if not out]


def strongest(runs: list[dict]) -> dict | None:
    """The run of greatest length / period; ties: the smallest start, then period."""
    best = None
    for r in runs:
        if best is None:
            best = r
            continue
        a, b = r["length"] * best["period"], best["length"] * r["period"]
        if a > b or (a == b and (r["start"], r["period"]) < (best["start"], best["period"])):
            best = r
    return best


def run_report(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row a document: number of runs, the strongest one, and digests of all runs and of the
    text without repetitions."""
    staged = _staged(with_id(docs, text_col, id_col), keep_texts=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, runs in zip(*(batch.column(i).to_pylist() for i in range(3))):
                lines = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs)
                top = strongest(runs) or dict.fromkeys(("start", "length", "period"))
                share = top["length"] and 1000 * top["length"] // top["period"]
                kept = b" ".join(kept_words(words_of(text), runs))
                out.append((doc_id, len(runs), top["start"], top["length"], top["period"], share,
                            _sha(lines.encode()), _sha(kept)))
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            columns = list(zip(*out)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds)],
                names=[field.split()[0] for field in REPORT.split(", ")],
            )

    found = _with_runs(staged).select("doc_id", "text", "runs").mapInArrow(run, REPORT)
    null = F.lit(None).cast("bigint")
    others = staged.where(F.size("fragments") == 0).select(
        "doc_id", F.lit(0).cast("bigint").alias("n_runs"),
        *[null.alias(c) for c in ("start", "length", "period", "exponent_milli")],
        F.lit(_sha(b"")).alias("runs_sha256"), F.col("sha").alias("collapsed_sha256"),
    )
    return found.unionByName(others)


def collapse_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with all their columns; of each run only the first period stays. Texts
    without runs stay as they are, others become their kept words with a blank between."""
    text = F.col(f"__row.`{text_col.replace('`', '``')}`").cast("string")
    rows = as_rows(docs)
    path = scratch_dir(docs.sparkSession, "runs-of-rows")
    rows.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    staged = _staged(rows.select(F.col("row").alias("doc_id"), text.alias("text")), False)

    @F.arrow_udf("string")
    def collapsed(texts: pa.Array, runs: pa.Array) -> pa.Array:
        return pa.array([
            b" ".join(kept_words(words_of(t), r)).decode() if r else t
            for t, r in zip(texts.to_pylist(), runs.to_pylist())
        ], pa.string())

    changed = _with_runs(staged).where(F.size("runs") > 0).select(
        F.col("doc_id").alias("row"), collapsed("text", "runs").alias("text"),
        F.lit(True).alias("changed"),
    )
    joined = rows.join(changed, "row", "left")
    new = F.when(F.col("changed"), F.col("text")).otherwise(text)
    return joined.select(F.col("__row").withField(f"`{text_col}`", new).alias("__row")).select(
        "__row.*"
    )


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where a tenth of the texts repeat a stretch of their own words to the end:
    with h the crc32 of the decimal doc_id and g = floor(h / 10), if h ends in 0, word i from
    a = g % n on becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8))."""
    words = "filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"
    place = "IF(i < v.a, i, v.a + (i - v.a) % v.p)"
    edited = f"""transform(array({words}), ws -> IF(size(ws) = 0, '', array_join(
        transform(
            array(named_struct(
                'a', CAST(g % size(ws) AS INT),
                'p', CAST(1 + (size(ws) - g % size(ws)) div (3 + g % 8) AS INT))),
            v -> transform(sequence(0, size(ws) - 1), i -> ws[{place}])
        )[0], ' ')))[0]"""
    hashed = F.crc32(F.col("doc_id").cast("string"))
    return with_id(docs).withColumn("h", hashed).withColumn(
        "g", F.floor(F.col("h") / 10)
    ).select(
        "doc_id",
        F.when((F.col("h") % 10 == 0) & F.col("text").isNotNull(), F.expr(edited))
        .otherwise(F.col("text")).alias("text"),
    )
