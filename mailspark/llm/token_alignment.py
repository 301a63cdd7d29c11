"""Alignment of two tokenizers' ids on the same bytes, and how often they go together.

Both tokenizers encode a blank and the text after it; a token is the bytes it stands for. Where
tokens of both end at the same byte, the text is cut into groups; a token of one and a token of
the other are linked where their bytes overlap. The count of an id pair is the number of documents
in which it is linked.

Both tokenizers cut texts at least where a blank follows what is no white space, so groups and
links lie within these units, and a unit is aligned once and kept.

First pass: the different pairs of each document are counted by task and written. The different
pairs get a minimal perfect hash by shard (BBHash, see perfect_hash). Tasks add their counts up in
dense vectors indexed by it, which are summed in two steps, a tree. Second pass: documents are
aligned again and the pairs of their links looked up, each key verified. The table of counts is
broadcast if it has at most TABLE_BYTES; a larger one is joined with the links of each document.

Null and empty texts, and those whose tokens' bytes are not the blank and the text, have no
tokens. Very long texts are one row and one task's work; memory is a few numbers a unit. Repeated
rows and ids are documents of their own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from mailspark.llm.common import latest_state, with_id
from mailspark.llm.perfect_hash import CountTable, PerfectHash, Shards
from mailspark.llm.token_counts import byte_alphabet
from mailspark.session import scratch_dir

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BLANK = "▁"  # how the second vocabulary writes a blank
# Units that a worker keeps, their characters, and units to a call of the library
KEPT_UNITS = 600_000
KEPT_CHARACTERS = 32_000_000
UNITS_A_CALL = 4000
# Cells of a table of texts and pairs
CELLS = 8_000_000
# Pairs a task holds before it writes them
HELD_PAIRS = 1_000_000
SHARDS = 64
SUMMED_AT_ONCE = 32
TABLE_BYTES = 64 * 1024 * 1024
ROW = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"
REPORT = f"doc_id bigint, {ROW}, n_best bigint, count_sum bigint, groups_sha256 string"


class Grown:
    """A NumPy array that is appended to."""

    def __init__(self):
        self.n, self.room = 0, np.zeros(1024, dtype=np.int64)

    def extend(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.room):
            room = np.zeros(2 * (self.n + len(values)), dtype=np.int64)
            room[: self.n] = self.room[: self.n]
            self.room = room
        self.room[self.n : self.n + len(values)] = values
        self.n += len(values)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each stretch, stretch after stretch."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Aligner:
    """Units of texts and their alignment. A unit is named by what follows its first blank. What a
    worker keeps lies in flat arrays by the unit's number; n_a is -1 where the bytes of the tokens
    are not those of the unit."""

    def __init__(self, byte_level: str, pieces: str, with_groups: bool):
        with open(byte_level, encoding="utf-8") as f:
            spec = json.load(f)
        of_char = {c: i for i, c in enumerate(byte_alphabet())}
        added = {t["id"] for t in spec["added_tokens"]}
        ranks = {
            bytes(of_char[c] for c in token): i
            for token, i in spec["model"]["vocab"].items() if i not in added
        }
        # ids of a byte-level vocabulary are the ranks of its merges; without the added tokens
        # their strings in a text are plain text
        self.a = tiktoken.Encoding(
            "byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
            special_tokens={},
        )
        self.length_a = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for data, i in ranks.items():
            self.length_a[i] = len(data)
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(name[3:-1], 16)]) if self.b.is_byte(i) else name.replace(BLANK, " ").encode()
            for i, name in enumerate(names)
        ]
        self.length_b = np.array([len(x) for x in self.bytes_b])
        self.blank = self.b.piece_to_id(BLANK)
        self.text_of = [str(i) for i in range(max(len(self.length_a), len(names)))]
        self.cut = re.compile(r"(?<=\S)(?= )")
        self.with_groups = with_groups
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.held = 0
        self.n_a, self.n_b, self.n_groups, self.n_links = Grown(), Grown(), Grown(), Grown()
        self.links_before, self.pairs = Grown(), Grown()
        self.groups: list[str] = []

    def split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The units of a blank and each text, and how many each has; empty texts have none."""
        odd = np.asarray(pc.match_substring_regex(texts, r"[\s\p{Z}\x0b\x1c-\x1f\x85] |^ "))
        empty = np.asarray(pc.equal(texts, ""))
        easy = ~(odd | empty)
        split = pc.split_pattern(texts.filter(pa.array(easy)), " ")
        hard = [
            [unit[1:] for unit in self.cut.split(" " + text)]
            for text in texts.filter(pa.array(odd)).to_pylist()
        ]
        counts = np.zeros(len(texts), dtype=np.int64)
        counts[easy] = np.asarray(pc.list_value_length(split))
        counts[odd] = [len(units) for units in hard]
        parts = [split.flatten(), pa.array([u for units in hard for u in units], texts.type)]
        if not hard:
            return parts[0], counts
        # the hard ones go to their places
        order = np.concatenate([np.flatnonzero(easy), np.flatnonzero(odd)])
        starts = np.zeros(len(texts), dtype=np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return pa.concat_arrays(parts).take(pa.array(spread(starts, counts))), counts

    def ids_a(self, names: list[str], n_plain: int) -> np.ndarray:
        """The ids of all units in turn. Many of the first n_plain go to a call; the others end in
        white space, which would run into the next."""
        out, ask = [], self.a.encode_ordinary
        for first in range(0, n_plain, UNITS_A_CALL):
            out += ask(" " + " ".join(names[first : min(n_plain, first + UNITS_A_CALL)]))
        for name in names[n_plain:]:
            out += ask(" " + name)
        return np.array(out, dtype=np.int64)

    def add(self, names: list[str]) -> None:
        """Aligns new units: all are laid end to end and cut at once."""
        loose = [n for n in names if not n or n[-1].isspace()]
        plain = [n for n in names if n and not n[-1].isspace()] if loose else names
        names = [*plain, *loose]
        self._add(names, len(plain))
        start = len(self.number)
        self.number.update((name, start + i) for i, name in enumerate(names))
        self.held += sum(map(len, names))

    def _add(self, names: list[str], n_plain: int) -> None:
        data = [b" " + name.encode() for name in names]
        whole = b"".join(data)
        a = self.ids_a(names, n_plain)
        # a unit of a single blank: the second tokenizer puts its blank only before something
        of_b = [
            ids or ([self.blank] if not name else [])
            for name, ids in zip(names, self.b.encode(names, num_threads=1))
        ]
        flat_b = list(chain.from_iterable(of_b))
        same = b"".join(map(self.bytes_b.__getitem__, flat_b)) == whole
        # byte-level ids stand for their text whatever it is
        if self.length_a[a].sum() != len(whole):
            raise AssertionError("the byte-level ids are not those of the text")
        if not same:
            good = [b"".join(map(self.bytes_b.__getitem__, b)) == d for b, d in zip(of_b, data)]
            if not any(good):
                for kept in (self.n_b, self.n_groups, self.n_links):
                    kept.extend(np.zeros(len(names), dtype=np.int64))
                self.n_a.extend(np.full(len(names), -1))
                self.links_before.extend(np.full(len(names), self.pairs.n))
                self.groups += [""] * len(names)
                return
            # runs of good and of other units, each by itself
            at = 0
            for fine, run in groupby(good):
                end = at + len(list(run))
                self._add(names[at:end], max(0, min(n_plain, end) - at))
                at = end
            return
        b = np.array(flat_b, dtype=np.int64)
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        is_end = np.zeros(len(whole) + 1, dtype=np.int8)
        is_end[ends_a] += 1
        is_end[ends_b] += 2
        cuts, both = np.flatnonzero(is_end), np.flatnonzero(is_end == 3)
        # between two neighbouring cuts lies one token of each: that is a link
        first_a = np.searchsorted(ends_a, cuts)
        first_b = np.searchsorted(ends_b, cuts)
        unit_ends = np.cumsum(np.fromiter(map(len, data), dtype=np.int64, count=len(data)))
        last = [np.searchsorted(ends, unit_ends) + 1 for ends in (ends_a, ends_b, both, cuts)]
        sizes = [np.diff(x, prepend=0) for x in last]
        for kept, n in zip((self.n_a, self.n_b, self.n_groups, self.n_links), sizes):
            kept.extend(n)
        self.links_before.extend(self.pairs.n + last[3] - sizes[3])
        self.pairs.extend((a[first_a] << 32) | b[first_b])
        if self.with_groups:
            self.groups += self._groups(a, b, np.searchsorted(ends_a, both) + 1,
                                        np.searchsorted(ends_b, both) + 1, last[2])

    def _groups(self, a, b, last_a, last_b, last_group) -> list[str]:
        """The groups of each unit as text."""
        ends_a, ends_b, text = last_a.tolist(), last_b.tolist(), self.text_of.__getitem__
        text_a, text_b = list(map(text, a.tolist())), list(map(text, b.tolist()))
        groups = [
            f"{text_a[i] if k == i + 1 else ','.join(text_a[i:k])}|"
            f"{text_b[j] if m == j + 1 else ','.join(text_b[j:m])}"
            for i, k, j, m in zip([0, *ends_a], ends_a, [0, *ends_b], ends_b)
        ]
        out, i = [], 0
        for k in last_group.tolist():
            out.append(groups[i] if k == i + 1 else ";".join(groups[i:k]))
            i = k
        return out

    def units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the units of the texts in turn, and how many units each text has."""
        flat, counts = self.split(texts)
        coded = flat.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.number) + len(names) > KEPT_UNITS or self.held > KEPT_CHARACTERS:
            self.forget()
        gc.disable()  # many strings and no cycles: scanning them finds nothing
        try:
            of = list(map(self.number.get, names))
            places = [i for i, n in enumerate(of) if n is None]
            if places:
                self.add([names[i] for i in places])
                for i in places:
                    of[i] = self.number[names[i]]
        finally:
            gc.enable()
        return np.array(of, dtype=np.int64)[np.asarray(coded.indices)], counts


class Batch:
    """The alignment of a batch of texts."""

    def __init__(self, aligner: Aligner, texts: pa.Array):
        self.aligner = aligner
        numbers, lengths = aligner.units(texts.cast(pa.large_string()).fill_null(""))
        bad = aligner.n_a.room[numbers] < 0
        if bad.any():
            text = np.repeat(np.arange(len(lengths)), lengths)
            fine = np.ones(len(lengths), dtype=bool)
            fine[text[bad]] = False
            numbers = numbers[fine[text]]
            lengths = np.where(fine, lengths, 0)
        # the different units, and of each text's units the place among them
        self.used, self.flat = np.unique(numbers, return_inverse=True)
        self.lengths = lengths
        self.sizes = aligner.n_links.room[self.used]
        self.starts = np.cumsum(self.sizes) - self.sizes
        pairs = aligner.pairs.room[spread(aligner.links_before.room[self.used], self.sizes)]
        # the different pairs of the batch, and the place of each unit's pairs among them
        self.pairs, self.place = np.unique(pairs, return_inverse=True)

    def by_text(self, values: np.ndarray) -> np.ndarray:
        """The sum of a value of each used unit over the units of each text."""
        total = np.concatenate([[0], np.cumsum(values[self.flat])])
        ends = np.cumsum(self.lengths)
        return total[ends] - total[ends - self.lengths]

    def sizes_of(self, kept: Grown) -> np.ndarray:
        return self.by_text(kept.room[self.used])

    def links_of(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the links of some texts: the text, and the place of the pair."""
        ends = np.cumsum(self.lengths)
        units = self.flat[ends[first] - self.lengths[first] : ends[last - 1]]
        text = np.repeat(np.arange(last - first), self.lengths[first:last])
        sizes = self.sizes[units]
        return np.repeat(text, sizes), self.place[spread(self.starts[units], sizes)]

    def documents_of_pairs(self) -> np.ndarray:
        """In how many texts of the batch each pair is linked."""
        out = np.zeros(len(self.pairs), dtype=np.int64)
        step = max(1, CELLS // max(1, len(self.pairs)))
        for first in range(0, len(self.lengths), step):
            last = min(len(self.lengths), first + step)
            linked = np.zeros((last - first, len(self.pairs)), dtype=bool)
            linked[self.links_of(first, last)] = True
            out += linked.sum(axis=0)
        return out

    def digests(self) -> list[str]:
        groups, used = self.aligner.groups, self.used.tolist()
        of_used = [groups[i] for i in used]
        flat, out, at = self.flat.tolist(), [], 0
        for n in self.lengths.tolist():
            joined = ";".join([of_used[i] for i in flat[at : at + n]])
            out.append(hashlib.sha256(joined.encode()).hexdigest() if n else "")
            at += n
        return out


def _aligner(byte_level: str, pieces: str, with_groups: bool) -> Aligner:
    # the second pass's takes the place of the first pass's
    return latest_state(
        "aligner", (byte_level, pieces, with_groups),
        lambda: Aligner(byte_level, pieces, with_groups),
    )


def _record(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def pair_partials(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """(shard, pair, n): how many documents of a task link a pair, by shard and pair; a task that
    meets very many pairs gives several such runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, shards = _aligner(byte_level, pieces, False), Shards(SHARDS)
        pairs, counts, held = [], [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            found, at = np.unique(np.concatenate(pairs), return_inverse=True)
            return found, np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)

        def out():
            found, n = summed()
            shard = shards.shard_of(found)
            order = np.argsort(shard, kind="stable")
            for first in range(0, len(order), 100_000):
                at = order[first : first + 100_000]
                yield _record(shard=pa.array(shard[at].astype(np.int32)), pair=pa.array(found[at]),
                              n=pa.array(n[at]))

        for batch in batches:
            aligned = Batch(aligner, batch.column(1))
            pairs.append(aligned.pairs)
            counts.append(aligned.documents_of_pairs())
            held += len(aligned.pairs)
            if held > HELD_PAIRS:
                found, n = summed()
                pairs, counts, held = [found], [n], len(found)
                if held > HELD_PAIRS // 2:
                    yield from out()
                    pairs, counts, held = [], [], 0
        if held:
            yield from out()

    return docs.mapInArrow(run, "shard int, pair bigint, n bigint")


def shard_hashes(partials: DataFrame) -> DataFrame:
    """(shard, hash, keys): the perfect hash of the different pairs of each shard, and the pairs
    in the order of their indexes. A shard is one task's share: 1 / SHARDS of the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.asarray(batch.column(1)) for batch in batches]
        keys = np.concatenate([*found, np.zeros(0, dtype=np.int64)])
        if not len(keys):
            return
        table = PerfectHash.of(keys)
        ordered = np.empty_like(keys)
        ordered[table.index(keys)] = keys
        yield _record(
            shard=pa.array([TaskContext.get().partitionId()], pa.int32()),
            hash=pa.array([table.to_bytes()], pa.binary()),
            keys=pa.array([ordered.astype("<i8").tobytes()], pa.binary()),
        )

    return (
        partials.select("shard", "pair").distinct()
        .repartitionById(SHARDS, F.col("shard"))
        .mapInArrow(run, "shard int, hash binary, keys binary")
    )


def count_vectors(partials: DataFrame, hashes: DataFrame) -> DataFrame:
    """(shard, counts): the dense vector of the counts of each shard's pairs, by their indexes.

    Each task sums its own pairs, then up to SUMMED_AT_ONCE vectors are summed at a time. The
    hashes are broadcast in slices of TABLE_BYTES, some four bits a pair.
    """
    spark = partials.sparkSession
    sizes = hashes.select("shard", F.length("hash").alias("size")).orderBy("shard").collect()
    slices, size = [[]], 0
    for row in sizes:
        if size + row["size"] > TABLE_BYTES and slices[-1]:
            slices.append([])
            size = 0
        slices[-1].append(row["shard"])
        size += row["size"]
    out = None
    for part in slices:
        rows = hashes.where(F.col("shard").isin(part)).select("shard", "hash").collect()
        sent = spark.sparkContext.broadcast({r["shard"]: bytes(r["hash"]) for r in rows})
        one = _vectors(partials.where(F.col("shard").isin(part)), sent)
        out = one if out is None else out.unionByName(one)
    width = max(1, partials.rdd.getNumPartitions() // SUMMED_AT_ONCE)
    return _sum_vectors(_sum_vectors(out, F.col("task") % width), F.lit(0)).drop("task")


VECTOR = "shard int, task int, counts binary"


def _vectors(partials: DataFrame, sent) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, current, vector, table = TaskContext.get().partitionId(), None, None, None
        for batch in batches:
            shards = np.asarray(batch.column(0))
            cuts = np.flatnonzero(np.diff(shards, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(shards)]):
                if shards[a] != current:
                    if vector is not None:
                        yield _vector(current, task, vector)
                    current = shards[a]
                    table = PerfectHash.from_bytes(sent.value[int(current)])
                    vector = np.zeros(table.n, dtype=np.int64)
                at = table.index(np.asarray(batch.column(1))[a:b])
                np.add.at(vector, at, np.asarray(batch.column(2))[a:b])
        if vector is not None:
            yield _vector(current, task, vector)

    return partials.mapInArrow(run, VECTOR)


def _vector(shard, task, vector: np.ndarray) -> pa.RecordBatch:
    return _record(
        shard=pa.array([int(shard)], pa.int32()), task=pa.array([int(task)], pa.int32()),
        counts=pa.array([vector.astype("<i8").tobytes()], pa.binary()),
    )


def _sum_vectors(vectors: DataFrame, group) -> DataFrame:
    """One vector a shard and group. A task holds one sum at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            for shard, task, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                           batch.column(2)):
                vector = np.frombuffer(counts.as_py(), dtype="<i8")
                if (shard, task) != key:
                    if key is not None:
                        yield _vector(*key, total)
                    key, total = (shard, task), np.zeros(len(vector), dtype=np.int64)
                total += vector
        if key is not None:
            yield _vector(*key, total)

    return (
        vectors.withColumn("task", group.cast("int"))
        .repartition("shard", "task").sortWithinPartitions("shard", "task")
        .mapInArrow(run, VECTOR)
    )


def pair_counts(
    docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES, path: str | None = None
) -> DataFrame:
    """The table of counts of `docs` (doc_id, text), written and read again: (shard, hash, keys,
    counts)."""
    spark = docs.sparkSession
    path = path or scratch_dir(spark, "pair-counts")
    pair_partials(docs, byte_level, pieces).write.parquet(f"{path}/partials")
    partials = spark.read.parquet(f"{path}/partials")
    shard_hashes(partials).write.parquet(f"{path}/hashes")
    hashes = spark.read.parquet(f"{path}/hashes")
    if hashes.isEmpty():
        empty = spark.createDataFrame([], "shard int, counts binary")
        return hashes.join(empty, "shard")
    count_vectors(partials, hashes).write.parquet(f"{path}/counts")
    return hashes.join(spark.read.parquet(f"{path}/counts"), "shard")


def best_counts(table: DataFrame) -> dict[int, int]:
    """The highest count of each id of the first vocabulary: at most as many rows as it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1)):
                ids = np.frombuffer(keys.as_py(), dtype="<i8") >> 32
                n = np.frombuffer(counts.as_py(), dtype="<i8")
                order = np.lexsort((n, ids))
                last = np.flatnonzero(np.diff(ids[order], append=-1))
                yield _record(a=pa.array(ids[order][last]), n=pa.array(n[order][last]))

    tops = table.select("keys", "counts").mapInArrow(run, "a bigint, n bigint")
    return {r["a"]: r["n"] for r in tops.groupBy("a").agg(F.max("n").alias("n")).collect()}


def align_tokens(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    byte_level: str = BYTE_LEVEL,
    pieces: str = PIECES,
    table_bytes: int = TABLE_BYTES,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text;
    n_best counts the links whose pair has the highest count of its first id, count_sum adds the
    counts of all links."""
    spark, docs = docs.sparkSession, with_id(docs, text_col, id_col)
    table = pair_counts(docs, byte_level, pieces)
    best = best_counts(table)
    size = table.agg(F.sum(F.length("hash") + F.length("keys") + F.length("counts"))).first()[0]
    if (size or 0) <= table_bytes:
        return _by_broadcast(spark, docs, table, best, byte_level, pieces)
    return _by_join(spark, docs, table, best, byte_level, pieces)


def _by_broadcast(spark: SparkSession, docs, table, best, byte_level, pieces) -> DataFrame:
    rows = [
        (r["shard"], bytes(r["hash"]), bytes(r["keys"]), bytes(r["counts"]))
        for r in table.select("shard", "hash", "keys", "counts").collect()
    ]
    sent = spark.sparkContext.broadcast((rows, best))

    def opened() -> tuple[CountTable, np.ndarray]:
        counts = CountTable(SHARDS)
        rows, best = sent.value
        for row in rows:
            counts.add(*row)
        tops = np.zeros(max(best, default=0) + 1, dtype=np.int64)
        tops[list(best)] = list(best.values())
        return counts, tops

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_level, pieces, True)
        counts, tops = opened()
        for batch in batches:
            if not batch.num_rows:
                continue
            aligned = Batch(aligner, batch.column(1))
            n = counts.look_up(aligned.pairs)
            is_best = n == tops[aligned.pairs >> 32] if len(n) else n
            sums, hits = (
                aligned.by_text(np.bincount(
                    np.repeat(np.arange(len(aligned.sizes)), aligned.sizes),
                    values[aligned.place], len(aligned.sizes)).astype(np.int64))
                for values in (n, is_best.astype(np.int64))
            )
            yield _record(
                doc_id=batch.column(0), n_a=pa.array(aligned.sizes_of(aligner.n_a)),
                n_b=pa.array(aligned.sizes_of(aligner.n_b)),
                n_groups=pa.array(aligned.sizes_of(aligner.n_groups)),
                n_links=pa.array(aligned.by_text(aligned.sizes)), n_best=pa.array(hits),
                count_sum=pa.array(sums), groups_sha256=pa.array(aligned.digests(), pa.string()),
            )

    return docs.mapInArrow(run, REPORT)


def _by_join(spark: SparkSession, docs, table, best, byte_level, pieces) -> DataFrame:
    """The same where the table is too large to send: the different pairs of each document and how
    often it links them are written and joined with the counts, frequent pairs in salts."""
    salts = 16
    kind = f"doc_id bigint, {ROW}, groups_sha256 string, links array<struct<pair:bigint,times:bigint>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_level, pieces, True)
        for batch in batches:
            if not batch.num_rows:
                continue
            aligned = Batch(aligner, batch.column(1))
            pairs, times, cuts = [], [], [0]
            for text in range(batch.num_rows):
                _, links = aligned.links_of(text, text + 1)
                found, n = np.unique(links, return_counts=True)
                pairs.append(aligned.pairs[found])
                times.append(n)
                cuts.append(cuts[-1] + len(found))
            links = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(pairs).astype(np.int64)),
                 pa.array(np.concatenate(times).astype(np.int64))], names=["pair", "times"])
            yield _record(
                doc_id=batch.column(0), n_a=pa.array(aligned.sizes_of(aligner.n_a)),
                n_b=pa.array(aligned.sizes_of(aligner.n_b)),
                n_groups=pa.array(aligned.sizes_of(aligner.n_groups)),
                n_links=pa.array(aligned.by_text(aligned.sizes)),
                groups_sha256=pa.array(aligned.digests(), pa.string()),
                links=pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), links),
            )

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1)):
                found = np.frombuffer(keys.as_py(), dtype="<i8")
                n = np.frombuffer(counts.as_py(), dtype="<i8")
                for first in range(0, len(found), 100_000):
                    yield _record(pair=pa.array(found[first : first + 100_000]),
                                  n=pa.array(n[first : first + 100_000]))

    path = scratch_dir(spark, "aligned")
    docs.mapInArrow(run, kind).withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    aligned = spark.read.parquet(path)
    links = aligned.select("row", F.inline("links")).withColumn("salt", F.col("row") % salts)
    tops = spark.createDataFrame(list(best.items()) or [], "a bigint, top bigint")
    counts = (
        table.select("keys", "counts").mapInArrow(opened, "pair bigint, n bigint")
        .withColumn("a", F.shiftright("pair", 32)).join(tops, "a")
        .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    )
    sums = links.join(counts, ["pair", "salt"]).groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("top"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("times")).alias("count_sum"),
    )
    filled = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_best", "count_sum")]
    return aligned.drop("links").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", *filled, "groups_sha256"
    )
