"""Benchmark decontamination with an FM-index for each shard of the training text.

A shard is a run of rows inside a partition, about SHARD_BYTES of text. Its words become
numbers; stretches in which no test phrase can lie (a phrase needs its own words side by side)
are squeezed out, and the rest, stretch by stretch, is indexed: suffix order, last column, a
wavelet matrix for ranks, and sampled suffix positions. All phrases are searched backwards at
once; the rows of a found interval are walked to the next sampled position. Occurrences are
merged into spans of words to be removed.

The test set is read in slices of at most SLICE_BYTES, the bound of what is broadcast; a larger
set takes one pass for each slice, chained in the same stage. Documents are never shuffled.

A window is 13 consecutive words of an item, or a whole shorter item; items without words have
none. Null texts have no words. Items without id are found but not listed; repeated items and
rows change nothing. An empty test set hits nothing.

Very long texts are a shard of their own. Empty tables of documents give no rows; without test
items nothing is hit. Other columns are kept, whatever their names. A test set above SLICE_BYTES is
searched for slice by slice: one slice at a time is on the driver and with the workers, and what
was found so far is written in between.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from mailspark.llm.common import as_rows, latest_state, own_columns, with_id
from mailspark.session import scratch_dir

WINDOW = 13
# contaminated: at least one word in SHARE is hit
SHARE = 20
SHARD_BYTES = 24 * 1024 * 1024
SLICE_BYTES = 16 * 1024 * 1024
SAMPLED = 8
FOUND = (
    "struct<n_words: bigint, spans: array<struct<start: bigint, end: bigint>>, "
    "items: array<string>>"
)

# bytes.split() on this gives the words: A-Z lowered, all ASCII but letters and digits blank
_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
TO_WORDS = bytes(
    c if c in _KEPT else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(TO_WORDS).split() if text else []


class Phrases:
    """The windows of a slice of the test set as numbers of its own words."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple, set] = {}
        pairs, single = set(), set()
        for item_id, text in items:
            words = [self.number(w) for w in words_of(text)]
            if not words:
                continue
            size = min(window, len(words))
            pairs.update(zip(words, words[1:]))
            if size == 1:
                single.add(words[0])
            for i in range(len(words) - size + 1):
                windows.setdefault(tuple(words[i : i + size]), set()).add(item_id)
        ordered = sorted(windows, key=lambda w: (len(w), w))
        self.items = [sorted(x for x in windows[w] if x is not None) for w in ordered]
        self.sizes = np.array([len(w) for w in ordered], dtype=np.int64)
        # right-aligned: the last word of each window in the last column
        self.table = np.zeros((len(ordered), window), dtype=np.int64)
        for i, w in enumerate(ordered):
            self.table[i, window - len(w) :] = w
        self.alphabet = len(self.vocabulary) + 1  # 0 stands between stretches
        self.pairs = np.array(sorted(a * self.alphabet + b for a, b in pairs), dtype=np.int64)
        self.single = np.zeros(self.alphabet, dtype=bool)
        self.single[list(single)] = True
        self.least = int(self.sizes.min()) if len(ordered) else 0

    def number(self, word: bytes) -> int:
        return self.vocabulary.setdefault(word, len(self.vocabulary) + 1)

    def stretches(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First place and end of every stretch that can hold a window."""
        linked = (words[:-1] > 0) & (words[1:] > 0)
        at = np.flatnonzero(linked)
        keys = words[at] * self.alphabet + words[at + 1]
        place = np.searchsorted(self.pairs, keys)
        place[place == len(self.pairs)] = 0
        known = self.pairs[place] == keys if len(self.pairs) else np.zeros(len(at), dtype=bool)
        linked[:] = False
        linked[at[known]] = True
        alone = self.single[words]
        alone[:-1] &= ~linked
        alone[1:] &= ~linked
        edge = np.diff(np.concatenate([[0], linked.astype(np.int8), [0]]))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        long = ends - starts >= max(2, self.least)
        single = np.flatnonzero(alone)
        starts = np.concatenate([starts[long], single])
        ends = np.concatenate([ends[long], single + 1])
        order = np.argsort(starts)
        return starts[order], ends[order]


class WaveletMatrix:
    """Ranks of a symbol in a prefix, by one bit vector for each bit of the symbols."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.ones, self.zeros = [], []
        now = symbols
        for level in range(self.bits - 1, -1, -1):
            bit = (now >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(len(now) - int(self.ones[-1][-1]))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        start = np.zeros_like(end)
        for k in range(self.bits):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            ones, zeros = self.ones[k], self.zeros[k]
            start = np.where(one, zeros + ones[start], start - ones[start])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return end - start

    def symbol_and_rank(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it occurs before it."""
        symbol, start, end = np.zeros_like(place), np.zeros_like(place), place
        for k in range(self.bits):
            ones, zeros = self.ones[k], self.zeros[k]
            one = ones[end + 1] > ones[end]
            symbol = symbol * 2 + one
            start = np.where(one, zeros + ones[start], start - ones[start])
            end = np.where(one, zeros + ones[end], end - ones[end])
        return symbol, end - start


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Places in the order of their suffixes. Each 0 ends its suffixes: zeros are ordered by
    place, so doubling ends with the longest stretch."""
    n = len(text)
    zeros = np.flatnonzero(text == 0)
    rank = text + len(zeros)
    rank[zeros] = np.arange(len(zeros))
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        ordered = rank[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        if n == 0 or fresh[-1] == n - 1:
            return order
        after = np.zeros(n, dtype=np.int64)
        after[: n - width] = rank[width:] + 1
        order = np.argsort(rank * (n + 1) + after, kind="stable")
        rank = (rank * (n + 1) + after)
        width *= 2


class FMIndex:
    """Index of a text of numbers; every stretch is followed by a 0."""

    def __init__(self, text: np.ndarray, alphabet: int):
        n = len(text)
        order = suffix_order(text)
        last = text[order - 1]  # order 0 wraps to the final 0
        self.matrix = WaveletMatrix(last, alphabet)
        counts = np.bincount(text, minlength=alphabet)
        self.before = np.concatenate([[0], np.cumsum(counts)[:-1]])
        self.counts = counts
        # sampled: every SAMPLED-th place, and the first of a stretch, where walks must end
        sampled = order % SAMPLED == 0
        sampled |= last == 0
        self.sampled, self.position = sampled, np.where(sampled, order, -1)

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Phrases found, and first row and end of the rows of each."""
        width = phrases.shape[1]
        present = (self.counts[phrases] > 0) | (phrases == 0)
        alive = np.flatnonzero(present.all(axis=1))
        symbol = phrases[alive, width - 1]
        low, high = self.before[symbol], self.before[symbol] + self.counts[symbol]
        done = [(alive[sizes[alive] == 1], low[sizes[alive] == 1], high[sizes[alive] == 1])]
        for step in range(1, width):
            going = (sizes[alive] > step) & (low < high)
            alive, low, high = alive[going], low[going], high[going]
            if not len(alive):
                break
            symbol = phrases[alive, width - 1 - step]
            low = self.before[symbol] + self.matrix.rank(symbol, low)
            high = self.before[symbol] + self.matrix.rank(symbol, high)
            over = (sizes[alive] == step + 1) & (low < high)
            done.append((alive[over], low[over], high[over]))
        return tuple(np.concatenate(x) for x in zip(*done))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of index rows: steps back to a sampled place, and adds the steps."""
        place, steps = np.full(len(rows), -1), np.zeros(len(rows), dtype=np.int64)
        open_, now = np.arange(len(rows)), rows
        while len(open_):
            hit = self.sampled[now]
            place[open_[hit]] = self.position[now[hit]] + steps[open_[hit]]
            open_, now = open_[~hit], now[~hit]
            symbol, rank = self.matrix.symbol_and_rank(now)
            now = self.before[symbol] + rank
            steps[open_] += 1
        return place


def search_shard(
    texts: list[str | None], phrases: Phrases
) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
    """Number of words, merged hit spans (in words) and item ids of each text."""
    get = phrases.vocabulary.get
    parts, sizes = [], []
    for text in texts:
        words = words_of(text)
        sizes.append(len(words))
        # a 0 after each text keeps phrases from crossing texts
        parts.append(np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words)))
        parts.append(np.zeros(1, dtype=np.int64))
    found: list = [(n, [], []) for n in sizes]
    words = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
    if not len(phrases.sizes) or not len(words):
        return found
    starts, ends = phrases.stretches(words)
    if not len(starts):
        return found
    # stretch by stretch, each followed by a 0
    lengths = ends - starts + 1
    offset = np.concatenate([[0], np.cumsum(lengths)])
    source = np.arange(offset[-1]) - np.repeat(offset[:-1] - starts, lengths)
    text = words[np.minimum(source, len(words) - 1)]
    text[offset[1:] - 1] = 0
    index = FMIndex(text, phrases.alphabet)
    hits, low, high = index.search(phrases.table, phrases.sizes)
    if not len(hits):
        return found
    times = high - low
    first = np.concatenate([[0], np.cumsum(times)[:-1]])
    rows = np.arange(times.sum()) - np.repeat(first - low, times)
    window = np.repeat(hits, times)
    place = source[index.locate(rows)]
    bounds = np.concatenate([[0], np.cumsum(np.array(sizes) + 1)])
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(covered, place, 1)
    np.add.at(covered, place + phrases.sizes[window], -1)
    inside = np.cumsum(covered)[:-1] > 0
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
        doc = int(np.searchsorted(bounds, a, side="right")) - 1
        found[doc][1].append((a - int(bounds[doc]), b - int(bounds[doc])))
    doc = np.searchsorted(bounds, place, side="right") - 1
    for d, w in np.unique(np.stack([doc, window], axis=1), axis=0).tolist():
        found[d][2].extend(phrases.items[w])
    return [(n, spans, sorted(set(items))) for n, spans, items in found]


def _slices(
    benchmark: DataFrame, text_col: str, item_col: str, slice_bytes: int
) -> Iterator[tuple[list[tuple], bool]]:
    """The test set in parts of at most about slice_bytes, cut by a hash of the text, and whether
    a part is the last. One part is collected when it is asked for."""
    items = benchmark.select(
        F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")
    ).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n = max(1, -(-size // slice_bytes))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        yield [tuple(r) for r in part.collect()], k == n - 1


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_text_col: str = "text",
    item_col: str = "item_id",
    window: int = WINDOW,
    slice_bytes: int = SLICE_BYTES,
    keep_text: bool = True,
) -> DataFrame:
    """All columns of the documents, and `__found`: n_words, spans (array of start and end, in
    words, merged) and items (array of ids). Narrow; with a test set of several slices the rows
    are written after each but the last."""
    spark = docs.sparkSession
    out = as_rows(docs)
    slices = _slices(benchmark, item_text_col, item_col, slice_bytes)
    for number, (items, is_last) in enumerate(slices):
        shared, key = spark.sparkContext.broadcast(items), uuid.uuid4().hex
        dropped = "" if keep_text or not is_last else text_col
        kept = [f for f in out.schema["__row"].dataType if f.name != dropped]
        row = StructField("__row", StructType(kept), False)
        schema = StructType([row, *StructType.fromDDL(f"__found {FOUND}")])
        out = out.mapInArrow(
            _searcher(shared, key, text_col, [f.name for f in kept], window, number > 0), schema
        )
        if not is_last:
            path = scratch_dir(spark, "searched")
            out.write.parquet(path)
            out = spark.read.parquet(path)
            shared.destroy()
    return out.select("__row.*", "__found")


def _searcher(shared, key, text_col, kept, window, merge):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kind = pa.struct([("n_words", pa.int64()), ("spans", span), ("items", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column(0).field(text_col).nbytes
            if size >= SHARD_BYTES:
                yield from search(held)
                held, size = [], 0
        yield from search(held)

    def search(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        phrases = latest_state("phrases", key, lambda: Phrases(shared.value, window))
        found = iter(
            search_shard([t for b in held for t in b.column(0).field(text_col).to_pylist()], phrases)
        )
        for batch in held:
            rows = [next(found) for _ in range(batch.num_rows)]
            if merge:
                rows = [merged(old, new) for old, new in zip(batch.column(1).to_pylist(), rows)]
            values = [
                {"n_words": n, "spans": [{"start": a, "end": b} for a, b in s], "items": i}
                for n, s, i in rows
            ]
            whole = batch.column(0)
            row = pa.StructArray.from_arrays([whole.field(c) for c in kept], names=kept)
            yield pa.RecordBatch.from_arrays(
                [row, pa.array(values, type=kind)], names=["__row", "__found"]
            )

    return run


def merged(old: dict, new: tuple) -> tuple:
    """Spans and items of two slices of the test set."""
    spans: list[tuple[int, int]] = []
    for a, b in sorted([(s["start"], s["end"]) for s in old["spans"]] + new[1]):
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return new[0], spans, sorted({*old["items"], *new[2]})


def n_hit() -> Column:
    return F.aggregate(
        "__found.spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]
    )


def is_contaminated(share: int = SHARE) -> Column:
    return (n_hit() > 0) & (F.lit(share) * n_hit() >= F.col("__found.n_words"))


def contamination_report(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans) of whole texts."""
    found = find_contamination(with_id(docs, text_col, id_col), benchmark, keep_text=False)
    return found.select(
        "doc_id",
        F.col("__found.n_words").alias("n_words"),
        n_hit().alias("n_hit"),
        F.size("__found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("__found.items"), ",").cast("binary"), 256).alias(
            "items_sha256"
        ),
        is_contaminated().alias("contaminated"),
        F.array_join(
            F.transform("__found.spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ","
        ).alias("spans"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents, with their own columns, that are not contaminated."""
    found = find_contamination(docs, benchmark, text_col)
    return found.where(~is_contaminated()).select(*own_columns(docs))
