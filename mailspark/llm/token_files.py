"""Token ids in files of independent, checksummed, range-coded blocks.

Documents are dealt to shards by ranges of ascending doc_id; a shard is one file. A file holds
segments, one a row (shard, segment, n_ids, blob). A blob is whole in itself: a header with the
ids and lengths of its documents and where in the shard it starts, and blocks of up to 1,024
token ids, each coded with fresh models (see range_coder) and with the crc32 of its ids. Reading
decodes many blocks of a segment side by side and raises ValueError where a checksum differs.
A segment ends with a document, so it holds SEGMENT ids and at most one document more.

Rows without id come first; rows of equal id follow each other by a hash of their text. A null or
empty text has the end id only. A very long text is one document of one segment, however many ids
it has. An empty table gives no files' rows; other columns are ignored. Ids must be below 2 ** 16.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from mailspark.llm.common import only_state, shuffle_width, with_id
from mailspark.llm.range_coder import BLOCK, checksum, decode, encode
from mailspark.llm.word_ids import VOCABULARY, WordIds
from mailspark.session import scratch_dir

END_ID = 2
SEGMENT = 8_000_000
# blocks that are coded side by side: some 15 KB each of tables and words
SIDE_BY_SIDE = 4096
# texts whose words are numbered at once
GROUP_BYTES = 8 * 1024 * 1024
MAGIC = b"MSID"
HEADER = "<4sIIIQ"  # magic, version, documents, blocks, ids before in the shard


def pack(docs: list[tuple[int | None, bytes]], before: int) -> bytes:
    """A segment of (doc_id, ids as little-endian 16-bit numbers)."""
    ids = np.frombuffer(b"".join(data for _, data in docs), dtype="<u2")
    blocks = [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]
    codes = [
        code for i in range(0, len(blocks), SIDE_BY_SIDE)
        for code in encode(blocks[i : i + SIDE_BY_SIDE])
    ]
    numbers = np.array([i or 0 for i, _ in docs], dtype="<i8")
    missing = np.array([i is None for i, _ in docs], dtype="u1")
    lengths = np.array([len(data) // 2 for _, data in docs], dtype="<u4")
    sizes = np.array([(len(b), len(c), checksum(b)) for b, c in zip(blocks, codes)], dtype="<u4")
    head = struct.pack(HEADER, MAGIC, 1, len(docs), len(blocks), before)
    return b"".join(
        [head, *(x.tobytes() for x in (numbers, missing, lengths, sizes)), *codes]
    )


def unpack(blob: bytes) -> tuple[list, np.ndarray, np.ndarray, int]:
    """doc ids, lengths, all ids, and the ids before the segment in its shard."""
    magic, version, n_docs, n_blocks, before = struct.unpack_from(HEADER, blob)
    if (magic, version) != (MAGIC, 1):
        raise ValueError("not a segment of token ids")
    at = struct.calcsize(HEADER)
    parts = []
    for kind, count in (("<i8", n_docs), ("u1", n_docs), ("<u4", n_docs), ("<u4", 3 * n_blocks)):
        parts.append(np.frombuffer(blob, dtype=kind, count=count, offset=at))
        at += parts[-1].nbytes
    numbers, missing, lengths, sizes = parts
    sizes = sizes.reshape(-1, 3).tolist()
    codes = []
    for _, length, _ in sizes:
        codes.append(blob[at : at + length])
        at += length
    counts, blocks = [n for n, _, _ in sizes], []
    for i in range(0, len(codes), SIDE_BY_SIDE):
        blocks += decode(codes[i : i + SIDE_BY_SIDE], counts[i : i + SIDE_BY_SIDE])
    for block, (_, _, crc) in zip(blocks, sizes):
        if checksum(block) != crc:
            raise ValueError("a block of token ids differs from its checksum")
    doc_ids = [None if m else i for i, m in zip(numbers.tolist(), missing.tolist())]
    ids = np.concatenate(blocks) if blocks else np.zeros(0, dtype=np.uint16)
    return doc_ids, lengths, ids, before


def in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, pa.Array]]:
    """The doc ids and texts of some batches at a time, so that their words are numbered once."""
    held, size = [], 0

    def joined() -> tuple[list, pa.Array]:
        texts = pa.concat_arrays([b.column(1).cast(pa.large_string()) for b in held])
        return [i for b in held for i in b.column(0).to_pylist()], texts

    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= GROUP_BYTES:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


def write_token_files(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    id_col: str = "doc_id",
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    segment: int = SEGMENT,
) -> None:
    """Writes the token ids of whole texts in ascending doc_id order. One shuffle of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = only_state(("words", vocabulary), lambda: WordIds(vocabulary))
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()), pa.array([number], pa.int32()),
                    pa.array([size], pa.int64()), pa.array([pack(held, before)], pa.binary()),
                ],
                names=["shard", "segment", "n_ids", "blob"],
            )

        for doc_ids, texts in in_groups(batches):
            ids, sizes = coder.encode(texts)
            data = np.insert(ids, np.cumsum(sizes), end_id).astype("<u2").tobytes()
            ends = 2 * np.cumsum(sizes + 1)
            starts = ends - 2 * (sizes + 1)
            for doc_id, a, b in zip(doc_ids, starts.tolist(), ends.tolist()):
                held.append((doc_id, data[a:b]))
                size += (b - a) // 2
                if size >= segment:
                    yield packed()
                    number, before, held, size = number + 1, before + size, [], 0
        if held:
            yield packed()

    width = shuffle_width(docs.sparkSession)
    (
        with_id(docs, text_col, id_col)
        # many rows of one id, or of none, are told apart by their texts
        .withColumn("of_text", F.xxhash64("text"))
        .repartitionByRange(width, "doc_id", "of_text")
        .sortWithinPartitions("doc_id", "of_text", "text")
        .select("doc_id", "text")
        .mapInArrow(run, "shard int, segment int, n_ids bigint, blob binary")
        .write.option("compression", "none")  # the blobs are coded already
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, and its ids if asked for. start
    counts the ids of all documents before. The driver holds one number for each file."""
    files = spark.read.parquet(path)
    totals = {
        r["shard"]: r["n"] for r in files.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()
    }
    starts, now = {}, 0
    for shard in sorted(totals):
        starts[shard] = now
        now += totals[shard]
    kind = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    fields = [(f.split()[0], pa.int64()) for f in kind.split(", ")]
    if with_ids:
        kind, fields = f"{kind}, ids array<int>", [*fields, ("ids", pa.list_(pa.int32()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids, lengths, ids, before = unpack(blob.as_py())
                ends = np.cumsum(lengths, dtype=np.int64)
                firsts = ends - lengths
                wide = ids.astype("<u4")
                data = memoryview(wide.tobytes())
                columns = [
                    doc_ids,
                    firsts + before + starts[shard],
                    lengths.astype(np.int64),
                    [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(firsts, ends)],
                ]
                if with_ids:
                    columns.append([wide[a:b] for a, b in zip(firsts, ends)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=t) for c, (_, t) in zip(columns, fields)],
                    names=[n for n, _ in fields],
                )

    return files.select("shard", "blob").mapInArrow(run, kind)


def through_token_files(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", path: str | None = None
) -> DataFrame:
    """Writes the files (to a folder of its own below the shared one, unless named) and reads
    the documents back from them."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "token-ids")
    write_token_files(docs, path, text_col, id_col)
    return read_token_files(spark, path)
