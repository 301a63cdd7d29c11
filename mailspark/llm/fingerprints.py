"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes marks where a text may be cut. Cuts are normalised: no chunk
is shorter than 32 bytes, up to the normal length a cut needs more zero bits than beyond it, and
none is longer than the maximum. The fingerprint is the set of chunk digests, each with the
bytes it stands for. An insertion moves the bytes but not the chunks, so what two texts share
keeps its digests. Likeness is containment: the bytes of shared digests over the bytes of the
smaller text.

Equal texts have equal fingerprints; an empty or null text has the empty one. Two empty
fingerprints have likeness 1, an empty and another one 0.

Very long texts are chunked in one pass and hold one digest for each chunk. An empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from mailspark.llm.common import shuffle_width, strings, with_id

SHORTEST, NORMAL, LONGEST = 32, 64, 256
STRICT_BITS, LOOSE_BITS = 7, 4
SEED = 20240229


def _gear() -> np.ndarray:
    """256 random 32-bit numbers, from a rule so that every worker has the same."""
    digests = (hashlib.sha256(f"{SEED}:{b}".encode()).digest()[:4] for b in range(256))
    return np.frombuffer(b"".join(digests), dtype=np.uint32)


GEAR = _gear()


def gear_hash(data: np.ndarray) -> np.ndarray:
    """sum of GEAR[byte] << distance over the last 32 bytes, at every byte: five doublings."""
    h = GEAR[data]
    for width in (1, 2, 4, 8, 16):
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
    return h


def cuts_of(data: bytes, first: int, strict: list[int], loose: list[int], last: int) -> list[int]:
    """Ends of the chunks of data[first:last], given the places where either rule allows one."""
    cuts, start, n_strict, n_loose = [], first, len(strict), len(loose)
    while last - start > SHORTEST:
        normal = start + NORMAL
        i = bisect_left(strict, start + SHORTEST)
        if i < n_strict and strict[i] <= normal:
            end = strict[i]
        else:
            i = bisect_left(loose, normal)
            end = loose[i] if i < n_loose else last
            end = min(end, start + LONGEST)
        if end >= last:
            break
        cuts.append(end)
        start = end
    if start < last:
        cuts.append(last)
    return cuts


def fingerprints_of(texts: list[str]) -> list[dict[str, int]]:
    """Digest -> bytes, for each text. The texts are hashed as one array: the first 32 bytes
    of a text, whose hashes still hold the text before, are never a cut."""
    encoded = [t.encode() for t in texts]
    data = b"".join(encoded)
    if not data:
        return [{} for _ in texts]
    h = gear_hash(np.frombuffer(data, dtype=np.uint8))
    # a cut after byte i is at i + 1
    loose = np.flatnonzero(h >> np.uint32(32 - LOOSE_BITS) == 0)
    strict = loose[h[loose] >> np.uint32(32 - STRICT_BITS) == 0] + 1
    loose = loose + 1
    out, first = [], 0
    for text in encoded:
        last = first + len(text)
        a, b = np.searchsorted(loose, (first, last))
        c, d = np.searchsorted(strict, (first, last))
        sizes: dict[str, int] = {}
        start = first
        for end in cuts_of(data, first, strict[c:d].tolist(), loose[a:b].tolist(), last):
            digest = f"{xxhash.xxh64_intdigest(data[start:end]) >> 20:011x}"
            sizes[digest] = sizes.get(digest, 0) + end - start
            start = end
        out.append(sizes)
        first = last
    return out


def written(sizes: dict[str, int]) -> str:
    """digest:bytes by digest, comma-joined."""
    return ",".join(f"{d}:{n}" for d, n in sorted(sizes.items()))


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    if not a or not b:
        return float(not a and not b)
    if len(b) < len(a):
        a, b = b, a
    shared = sum(min(n, b[d]) for d, n in a.items() if d in b)
    return shared / min(sum(a.values()), sum(b.values()))


def edited(text: str, after: str) -> str:
    """The last third replaced by as many code points from the start of the next text."""
    k = len(text) // 3
    return text[: len(text) - k] + after[:k]


def _range_of(value: Column, bounds: list) -> Column:
    """Number of bounds below the value, in two steps of about sqrt(n) comparisons each."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(g[-1]).cast("bigint") for g in groups])
    table = F.array(*[F.array(*[F.lit(x).cast("bigint") for x in g]) for g in groups])
    group = F.size(F.filter(heads, lambda x: x < value))
    inside = F.size(F.filter(F.get(table, group), lambda x: x < value))
    # beyond the last group there is nothing inside
    below = group * step + F.coalesce(F.greatest(inside, F.lit(0)), F.lit(0))
    return F.least(below, F.lit(len(bounds)))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) in ranges by descending doc_id, one range to a partition, each
    followed by the first row of the next lower range, which is marked as a guest.

    One shuffle of the texts. The driver holds one number for each range. Rows of equal id
    follow each other by text; rows without id come last. The overall last row is followed by
    the first.
    """
    spark = docs.sparkSession
    n = shuffle_width(spark)
    ids = docs.select("doc_id")
    probabilities = F.array(*[F.lit(i / n) for i in range(1, n)])
    bounds = ids.agg(F.percentile_approx("doc_id", probabilities, F.lit(20 * n))).head()[0] or []
    bounds = sorted(set(bounds))
    last = len(bounds)
    # ranges count downwards, so range 0 holds the highest ids; ids that are null the last
    number = F.when(F.col("doc_id").isNull(), last + 1).otherwise(
        F.lit(last) - _range_of(F.col("doc_id"), bounds)
    )
    heads = {
        r["range"]: r["head"]
        for r in ids.groupBy(number.alias("range")).agg(F.max("doc_id").alias("head")).collect()
    }  # one row a range
    used = sorted(heads)
    head_of = F.array(*[F.lit(heads.get(i)).cast("bigint") for i in range(last + 2)])
    host_of = {r: used[i - 1] for i, r in enumerate(used)}
    hosts = F.array(*[F.lit(host_of.get(i, 0)) for i in range(last + 2)])
    is_head = F.col("doc_id").eqNullSafe(F.get(head_of, F.col("_range")))
    places = F.when(is_head, F.array(F.col("_range"), F.get(hosts, F.col("_range")))).otherwise(
        F.array(F.col("_range"))
    )
    return (
        docs.withColumn("_range", number)
        .select("doc_id", "text", F.posexplode(places).alias("_guest", "_range"))
        .repartitionById(last + 2, F.col("_range").cast("int"))
        .sortWithinPartitions("_guest", F.col("doc_id").desc_nulls_last(), "text")
    )


def fingerprint_report(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    of whole texts; see with_next for the order."""
    kind = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])

    def report(rows: list[tuple], after: tuple) -> pa.RecordBatch:
        """Rows are (id, text, fingerprint); `after` follows the last one."""
        follow = rows[1:] + [after]
        changed = [edited(a[1], b[1]) for a, b in zip(rows, follow)]
        marks = fingerprints_of(changed)
        columns = [
            [r[0] for r in rows],
            [len(r[1]) for r in rows],
            [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            [written(r[2]) for r in rows],
            [written(m) for m in marks],
            [likeness(r[2], m) for r, m in zip(rows, marks)],
            [likeness(a[2], b[2]) for a, b in zip(rows, follow)],
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, kind)], schema=kind
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows still to be reported, the last of them always
        for batch in batches:
            texts = strings(batch.column(1))
            rows = zip(
                batch.column(0).to_pylist(), texts, fingerprints_of(texts),
                batch.column(2).to_pylist(),
            )
            for doc_id, text, mark, guest in rows:
                if not guest:
                    held.append((doc_id, text, mark))
                elif held:
                    # the first guest follows the last own row; others repeat its id
                    yield report(held, (doc_id, text, mark))
                    held = []
            if len(held) > 1:
                yield report(held[:-1], held[-1])
                held = held[-1:]

    return with_next(with_id(docs, text_col, id_col)).select("doc_id", "text", "_guest").mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
