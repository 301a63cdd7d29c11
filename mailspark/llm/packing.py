"""Best-two-fit packing of documents into sequences of at most so many tokens.

A document is its ids and an end id; one that is too long is cut into full pieces and a rest. A
sequence is filled greedily, the longest piece that fits first. Then, if it holds more than one
piece, its smallest is replaced by two unpacked ones where two fit its gap and the smallest's
place more tightly.

Only lengths matter to that, and there are at most `capacity` different ones. So the pieces are
counted by length, the plan is made of the counts, and a pattern of lengths is repeated as long as
filling one sequence after the other would give it again: the plan is the same as that of single
pieces, and its size is bounded by the capacity, not by the documents. Each piece then finds its
place by arithmetic from its rank among the pieces of its length: tasks number their own pieces of
each length as they cut them, and a task's numbers are shifted by those of the tasks before it. No
piece is sorted, and no length is a group, however many pieces have it.

Null and empty texts are the end id alone. A very long text is one row of one task, its pieces are
rows of their own. Repeated rows and ids are documents of their own. An empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from mailspark.llm.common import with_id, worker_state
from mailspark.llm.word_ids import VOCABULARY, WordIds
from mailspark.session import scratch_dir

CAPACITY = 4096
END_ID = 1
RANK_BITS = 48
PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, shard int, "
    "nth bigint, ids binary"
)


class Plan:
    """Patterns of lengths, each used for a number of sequences.

    `counts[n]` pieces have length n. A pattern is (number of sequences, {length: uses}).
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = {n: c for n, c in counts.items() if c}
        # a bit for each length that is left, so that the longest that fits is found at once
        self.mask = sum(1 << n for n in self.left)
        self.patterns: list[tuple[int, dict[int, int]]] = []
        while self.left:
            self._next()
        self.sequences = sum(times for times, _ in self.patterns)

    def _longest(self, room: int, mask: int) -> int:
        """The longest length in the mask that is at most `room`, 0 if there is none."""
        return max(0, (mask & ((1 << (room + 1)) - 1)).bit_length() - 1)

    def _greedy(self) -> tuple[dict[int, int], int]:
        uses, gap, mask = {}, self.capacity, self.mask
        while n := self._longest(gap, mask):
            k = min(self.left[n], gap // n)
            uses[n] = k
            gap -= k * n
            mask &= (1 << n) - 1  # shorter ones only: this one is used up, or fits no more
        return uses, gap

    def _pair(self, uses: dict[int, int], room: int, least: int) -> tuple[int, int] | None:
        """Two unpacked pieces whose sum is the greatest above `least` and at most `room`."""
        mask = self.mask
        for n, k in uses.items():
            if self.left[n] <= k:
                mask &= ~(1 << n)
        best, found = least, None
        a = self._longest(room, mask)
        while a and 2 * a > best:
            twice = self.left[a] - uses.get(a, 0) >= 2
            b = self._longest(min(a if twice else a - 1, room - a), mask)
            if b and a + b > best:
                best, found = a + b, (a, b)
                if best == room:
                    break
            a = self._longest(a - 1, mask)
        return found

    def _next(self) -> None:
        uses, gap = self._greedy()
        needed = dict(uses)
        if sum(uses.values()) > 1 and gap:
            smallest = min(uses)
            if pair := self._pair(uses, gap + smallest, smallest):
                uses[smallest] -= 1
                for n in pair:
                    uses[n] = uses.get(n, 0) + 1
                    needed[n] = needed.get(n, 0) + 1
        uses = {n: k for n, k in uses.items() if k}
        # sequence after sequence gives the same pattern while what it looked at is there
        times = 1 + min((self.left[n] - needed[n]) // uses[n] for n in uses)
        for n, k in uses.items():
            self.left[n] -= times * k
            if not self.left[n]:
                del self.left[n]
                self.mask &= ~(1 << n)
        self.patterns.append((times, uses))

    def slots(self) -> np.ndarray:
        """Rows (length and first rank as one key, uses, first sequence, offset), by key."""
        rows, ranks, first = [], {}, 0
        for times, uses in self.patterns:
            offset = 0
            for n in sorted(uses, reverse=True):
                k = uses[n]
                rank = ranks.get(n, 0)
                rows.append(((n << RANK_BITS) | rank, k, first, offset))
                ranks[n] = rank + times * k
                offset += n * k
            first += times
        return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def place(slots: np.ndarray, length: np.ndarray, rank: np.ndarray):
    """The sequence of each piece and its offset in it."""
    at = np.searchsorted(slots[:, 0], (length << RANK_BITS) | rank, side="right") - 1
    found = slots[at]
    inside = rank - (found[:, 0] & ((1 << RANK_BITS) - 1))
    return found[:, 2] + inside // found[:, 1], found[:, 3] + inside % found[:, 1] * length


def cut_pieces(
    docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, capacity: int = CAPACITY
) -> DataFrame:
    """PIECES of all documents: `ids` are little-endian 16-bit numbers, ids_crc32 is that of
    32-bit ones, and (shard, length, nth) numbers the pieces of a task by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = worker_state(("words", vocabulary), lambda: WordIds(vocabulary))
        shard, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, sizes = coder.encode(batch.column(1))
            # the end id after each document
            whole = np.insert(ids, np.cumsum(sizes), end_id)
            sizes = sizes + 1
            n_pieces = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), n_pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            length = np.minimum(capacity, sizes[doc] - start)
            at = (np.cumsum(sizes) - sizes)[doc] + start
            narrow = memoryview(whole.astype("<u2").tobytes())
            wide = memoryview(whole.astype("<u4").tobytes())
            spans = list(zip(at.tolist(), (at + length).tolist()))
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            nth = np.empty(len(length), dtype=np.int64)
            nth[order] = np.arange(len(order)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            columns = [
                batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                pa.array(start), pa.array(length),
                pa.array([zlib.crc32(wide[4 * a : 4 * b]) for a, b in spans], pa.int64()),
                pa.array(np.full(len(doc), shard, dtype=np.int32)), pa.array(nth),
                pa.array([bytes(narrow[2 * a : 2 * b]) for a, b in spans], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=[field.split()[0] for field in PIECES.split(", ")]
            )

    return docs.mapInArrow(run, PIECES)


def ranked(pieces: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The pieces with their rank among those of their length, and the number of pieces of each
    length (at most `capacity` numbers reach the driver)."""
    counts = pieces.groupBy("shard", "length").agg(F.count(F.lit(1)).alias("n"))
    # one row a task and length
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = counts.select(
        "shard", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    totals = {
        r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    rank = (F.col("nth") + F.col("shift")).alias("rank")
    return pieces.join(shifts, ["shard", "length"]).select(*pieces.columns, rank), totals


def pack_documents(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    path: str | None = None,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset) of every piece. The
    pieces are written to `path`, or to a folder of their own below the shared one."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "pieces")
    cut_pieces(with_id(docs, text_col, id_col), vocabulary, end_id, capacity).write.parquet(path)
    pieces, totals = ranked(spark.read.parquet(path))
    slots = Plan(totals, capacity).slots()
    # a sequence holds at most some 90 different lengths, and a pattern ends where one runs out
    sent = spark.sparkContext.broadcast(slots)

    @F.arrow_udf("struct<sequence_id: bigint, offset: bigint>")
    def placed(length: pa.Array, rank: pa.Array) -> pa.Array:
        sequence, offset = place(sent.value, np.asarray(length), np.asarray(rank))
        return pa.StructArray.from_arrays(
            [pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"]
        )

    return pieces.withColumn("at", placed("length", "rank")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids", "at.sequence_id", "at.offset"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts) of packed pieces: the ids of a sequence end to end as
    little-endian 16-bit numbers, its documents and where each begins. A group is one sequence."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.expr("aggregate(parts, CAST(X'' AS BINARY), (a, x) -> concat(a, x.ids))").alias("ids"),
        F.col("parts.doc_id").alias("doc_ids"),
        F.col("parts.offset").alias("starts"),
    )
