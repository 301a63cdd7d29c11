"""Token counts by byte-pair merging, without making the ids.

A text is cut into pieces as the tokenizer cuts it. A piece starts as a linked list of byte
symbols; a heap holds the adjacent pairs that have a rank. The pair of the lowest rank, the
leftmost on a tie, is popped and merged until no pair has a rank. Each merge takes one
symbol away, so tokens = bytes - merges.

Nulls and empty texts have 0 bytes and 0 tokens. Repeated rows and ids stay as they are.
Very long texts take time in proportion to their pieces; a piece is merged by a heap, so
a long one is no slower by more than a logarithm. An empty table gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import json
from heapq import heapify, heappop, heappush

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from mailspark.llm.common import BoundedCache, map_batches, strings, with_id, worker_state

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 1024
CACHED_PIECES = 600_000
# Fixed value: how the tokenizer cuts texts, with Unicode's white space spelled out.
SPACE = r"\t-\r \x85\xa0  -     　"
PIECES = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can
    be seen, else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    unseen = (chr(256 + i) for i in range(256))
    return [chr(b) if b in seen else next(unseen) for b in range(256)]


class MergeCounter:
    """Ranked merges of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.of_byte = [vocab[c] for c in byte_alphabet()]
        # pair of ids as one integer -> rank; rank -> id of the merged symbol
        merges = spec["model"]["merges"]
        self.ranks = {(vocab[a] << 20) | vocab[b]: rank for rank, (a, b) in enumerate(merges)}
        self.merged = [vocab[a + b] for a, b in merges]
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.cut = regex.compile(PIECES).findall
        self.cache = BoundedCache(self.count_piece, CACHED_PIECES)

    def count_piece(self, piece: str) -> int:
        data = piece.encode()
        n = len(data)
        if n < 2:
            return n
        of_byte, find, merged = self.of_byte, self.ranks.get, self.merged
        symbols = [of_byte[b] for b in data]
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []  # rank and place in one integer: the lowest rank, then the leftmost
        a = symbols[0]
        for i in range(n - 1):
            b = symbols[i + 1]
            if (rank := find((a << 20) | b)) is not None:
                heap.append((rank << 32) | i)
            a = b
        heapify(heap)
        left = n
        while heap:
            top = heappop(heap)
            i = top & 0xFFFFFFFF
            j = after[i]
            # an entry is stale when one of its symbols was merged meanwhile
            if j >= n or symbols[i] < 0:
                continue
            rank = top >> 32
            if find((symbols[i] << 20) | symbols[j]) != rank:
                continue
            new = symbols[i] = merged[rank]
            symbols[j] = -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := find((new << 20) | symbols[k])) is not None:
                    heappush(heap, (rank << 32) | i)
            k = before[i]
            if k >= 0 and (rank := find((symbols[k] << 20) | new)) is not None:
                heappush(heap, (rank << 32) | k)
        return left

    def count(self, text: str) -> int:
        """Tokens of a text; the strings of added tokens count as one each."""
        total, parts = 0, [text]
        if self.added is not None and self.added.search(text):
            parts = self.added.split(text)
            total = len(parts) - 1
        look = self.cache.__getitem__
        return total + sum(sum(map(look, self.cut(part))) for part in parts)


def count_tokens(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    path: str = VOCABULARY,
    limit: int = LIMIT,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text; narrow, no shuffle."""

    def run(batch: pa.RecordBatch) -> dict:
        counter = worker_state(("merges", path), lambda: MergeCounter(path))
        texts = strings(batch.column(1))
        tokens = [counter.count(t) for t in texts]
        return {
            "doc_id": batch.column(0),
            "n_bytes": [len(t.encode()) for t in texts],
            "n_tokens": tokens,
            "over_limit": [n > limit for n in tokens],
        }

    return map_batches(
        with_id(docs, text_col, id_col),
        run,
        "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    )
