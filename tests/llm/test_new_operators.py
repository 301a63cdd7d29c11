"""Packing, periodic runs and tokenizer alignment against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mailspark.llm import packing, periodic_runs, queries, token_alignment
from mailspark.llm.common import table
from mailspark.llm.perfect_hash import CountTable, PerfectHash
from mailspark.llm.token_counts import byte_alphabet
from mailspark.llm.word_ids import WordIds
from tests.llm.test_operators import LONG, ODD_ROWS, docs_of, same_rows

WORD = re.compile("[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    more = [
        (10, LONG, "en", "x"),
        (10, LONG, "en", "x"),
        (11, " two  blanks\n and \t tabs ", "en", "x"),
        (12, "<|endoftext|> </s> <s> ▁ plain \x1c text\x1f here", "en", "x"),
        (13, "ha " * 500, "en", "x"),
        (14, " é ½ 中文 字 \U0001f600\U0001f600", "zh", "x"),
        (20, "a b c d e f g h " * 40 + "the end", "en", "x"),
    ]
    return docs_of(spark, ODD_ROWS + more)


@pytest.fixture(scope="module")
def none(spark):
    return docs_of(spark, [])


# packing


def one_by_one(counts, capacity):
    """Best-two-fit, sequence after sequence and piece after piece."""
    left, out = Counter(counts), []
    while +left:
        bin_, gap = [], capacity
        while fitting := [n for n, c in left.items() if c and n <= gap]:
            n = max(fitting)
            left[n] -= 1
            bin_.append(n)
            gap -= n
        if len(bin_) > 1 and gap:
            small = min(bin_)
            free = sorted((n for n, c in left.items() if c), reverse=True)
            best, pair = small, None
            for a in free:
                for b in free:
                    if b <= a and (a != b or left[a] > 1) and best < a + b <= gap + small:
                        best, pair = a + b, (a, b)
            if pair:
                bin_.remove(small)
                left[small] += 1
                for n in pair:
                    left[n] -= 1
                    bin_.append(n)
        out.append(tuple(sorted(bin_)))
    return out


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=14))
def test_plan_equals_filling_one_sequence_after_the_other(counts):
    plan = packing.Plan(counts, 60)
    got = [
        tuple(sorted(n for n, k in uses.items() for _ in range(k)))
        for times, uses in plan.patterns for _ in range(times)
    ]
    assert got == one_by_one(counts, 60)
    slots = plan.slots()
    held = defaultdict(list)
    for n, c in counts.items():
        sequence, offset = packing.place(slots, np.full(c, n), np.arange(c))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            held[s].append((o, n))
    assert sorted(held) == list(range(plan.sequences))
    for pieces in held.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= 60


def test_a_plan_does_not_grow_with_the_pieces():
    sizes = np.random.default_rng(1).lognormal(6, 1.2, 200_000).clip(1, 4096).astype(int)
    counts = {n: c for n, c in Counter(sizes.tolist()).items()}
    few, many = packing.Plan(counts), packing.Plan({n: 1000 * c for n, c in counts.items()})
    assert len(many.patterns) < 3 * packing.CAPACITY
    assert len(many.patterns) < 1.5 * len(few.patterns)
    assert few.sequences <= 1.001 * sizes.sum() / packing.CAPACITY + 1


def brute_pieces(rows, library):
    out = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k : k + 4096], "<u4")
            out.append((doc_id, k // 4096, k, len(part), zlib.crc32(part.tobytes())))
    return out


def test_packing(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    library = Tokenizer.from_file(packing.VOCABULARY)
    got = packing.pack_documents(odd).collect()
    same_rows([tuple(r)[:5] for r in got], brute_pieces(rows, library))
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length, r.ids))
    whole = {}
    for s, pieces in held.items():
        at = 0
        for offset, length, ids in sorted(pieces):
            assert offset == at and len(ids) == 2 * length
            at += length
        assert at <= 4096
        whole[s] = b"".join(bytes(ids) for _, _, ids in sorted(pieces))
    assert len(held) == -(-sum(r.length for r in got) // 4096)
    for r in packing.sequences(packing.pack_documents(odd)).collect():
        assert len(r.ids) <= 8192 and r.starts[0] == 0 and len(r.starts) == len(r.doc_ids)
    assert packing.pack_documents(none).count() == 0


def test_ranks_are_dense_in_each_length(spark):
    docs = docs_of(spark, [(i % 7, f"word{i % 3} " * (i % 5), "en", "x") for i in range(300)])
    pieces = packing.cut_pieces(docs.select("doc_id", "text").repartition(11))
    path_rows, totals = packing.ranked(spark.createDataFrame(pieces.toArrow()))
    by_length = defaultdict(list)
    for r in path_rows.collect():
        by_length[r.length].append(r["rank"])
    assert sum(totals.values()) == 300
    for n, ranks in by_length.items():
        assert sorted(ranks) == list(range(totals[n]))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abÀéßİK½ '’.,!-_\x1c\x85 \n中́", max_size=30), max_size=6))
def test_word_ids_equal_those_of_whole_texts(texts):
    coder = CODER.get("coder") or CODER.setdefault("coder", WordIds())
    ids, sizes = coder.encode(pa.array(texts, pa.string()))
    want = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


CODER = {}


# periodic runs


def brute_runs(words):
    codes = {}
    c = np.array([codes.setdefault(w, len(codes)) for w in words], dtype=np.int64)
    seen = {}
    for q in range(1, len(c) // 3 + 1):
        same = np.diff(np.concatenate([[0], (c[:-q] == c[q:]).astype(int), [0]]))
        for a, b in zip(np.flatnonzero(same == 1).tolist(), np.flatnonzero(same == -1).tolist()):
            if b - a + q >= max(24, 3 * q):
                seen.setdefault((a, b - a + q), q)
    return sorted(((a, n, q) for (a, n), q in seen.items()), key=lambda r: (r[0], r[2]))


def brute_report(doc_id, text, edit=True):
    words = WORD.findall(text or "")
    n = len(words)
    if edit and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for a, n, q in runs for i in range(a + q, a + n)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def stitched(found):
    by_period = defaultdict(list)
    for _, q, a, b in zip(*(x.tolist() for x in found)):
        by_period[q].append((a, b))
    out = []
    for q, spans in by_period.items():
        spans.sort()
        while spans:
            a, b = spans.pop(0)
            while spans and spans[0][0] <= b:
                b = max(b, spans.pop(0)[1])
            if b - a + q >= max(24, 3 * q):
                out.append((a, b - a + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_fragments_of_random_words_give_all_runs():
    draw = random.Random(11)
    for _ in range(150):
        words = []
        while len(words) < draw.randint(20, 600):
            unit = [draw.choice("aab") for _ in range(draw.choice([1, 2, 3, 7, 8, 9, 16, 31, 40]))]
            words += unit * draw.choice([1, 1, 3, 4, 9]) + unit[: draw.randint(0, len(unit))]
        codes = {}
        c = np.array([codes.setdefault(w, len(codes)) for w in words])
        assert stitched(periodic_runs.fragments(c, np.array([len(c)]))) == brute_runs(words)


def test_texts_of_a_batch_do_not_meet():
    words = np.zeros(90, dtype=np.int64)
    found = periodic_runs.fragments(words, np.array([30, 0, 23, 37]))
    assert set(found[0].tolist()) == {0, 3}
    assert stitched([x[found[0] == 3] for x in found]) == [(0, 37, 1)]


def test_periodic_runs(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    same_rows(periodic_runs.run_report(odd).collect(), [brute_report(*r, False) for r in rows])
    edited = periodic_runs.run_report(periodic_runs.with_repeats(odd))
    same_rows(edited.collect(), [brute_report(*r) for r in rows])
    assert periodic_runs.run_report(none).count() == 0
    assert periodic_runs.run_report(periodic_runs.with_repeats(none)).count() == 0


def test_runs_and_collapsed_documents(odd, none):
    want = [
        (r.doc_id, *run) for r in odd.collect() for run in brute_runs(WORD.findall(r.text or ""))
    ]
    same_rows(periodic_runs.find_runs(odd).collect(), want)
    got = periodic_runs.collapse_runs(odd)
    assert got.columns == odd.columns and got.count() == odd.count()
    texts = {r.doc_id: r for r in got.where("doc_id > 10").collect()}
    assert texts[13].text == "ha" and texts[13]["a.b"] == 2
    assert texts[20].text == "a b c d e f g h the end"
    assert texts[11].text == " two  blanks\n and \t tabs "  # no run, untouched
    assert periodic_runs.collapse_runs(none).count() == 0


def test_periodic_runs_of_the_table(spark, tiny):
    rows = [(r.doc_id, r.text) for r in table(spark, tiny, "documents").collect()]
    got = queries.QUERIES["op12_periodic_runs"](spark, tiny)
    same_rows(got.collect(), [brute_report(*r) for r in rows])
    assert got.where("n_runs > 0").count() > 10


def test_z_function():
    draw = random.Random(2)
    for _ in range(200):
        word = [draw.choice("ab") for _ in range(draw.randint(0, 40))]
        want = []
        for i in range(len(word)):
            k = 0
            while i + k < len(word) and word[k] == word[i + k]:
                k += 1
            want.append(k)
        assert periodic_runs.z_function(word) == want


def test_a_constant_text_has_few_fragments():
    """Longer periods of a run belong to its shortest one."""
    n = 20_000
    found = periodic_runs.fragments(np.zeros(n, dtype=np.int64), np.array([n]))
    assert set(found[1].tolist()) == {1} and len(found[0]) <= n // 8 + 1


# tokenizer alignment


def brute_alignment(rows):
    a_side = Tokenizer.from_file(token_alignment.BYTE_LEVEL)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=token_alignment.PIECES)
    byte_of = {c: i for i, c in enumerate(byte_alphabet())}

    def bytes_a(i):
        return bytes(byte_of[c] for c in a_side.id_to_token(i))

    def bytes_b(i):
        name = b_side.id_to_piece(i)
        if re.fullmatch("<0x[0-9A-F]{2}>", name):
            return bytes([int(name[3:5], 16)])
        return name.replace("▁", " ").encode()

    found, documents = [], Counter()
    for doc_id, text in rows:
        aligned = None
        if text:
            a = a_side.encode(" " + text, add_special_tokens=False).ids
            b = b_side.encode(text)
            parts = [[bytes_a(i) for i in a], [bytes_b(i) for i in b]]
            if all(b"".join(p) == (" " + text).encode() for p in parts):
                ends_a, ends_b = (np.cumsum(list(map(len, p))).tolist() for p in parts)
                links, groups, i, j, part_a, part_b = [], [], 0, 0, [], []
                while i < len(a) and j < len(b):
                    links.append((a[i], b[j]))
                    x, y = ends_a[i], ends_b[j]
                    if x <= y:
                        part_a.append(str(a[i]))
                        i += 1
                    if y <= x:
                        part_b.append(str(b[j]))
                        j += 1
                    if x == y:
                        groups.append(f"{','.join(part_a)}|{','.join(part_b)}")
                        part_a, part_b = [], []
                aligned = (a, b, groups, links)
                documents.update(set(links))
        found.append((doc_id, aligned))
    top = defaultdict(int)
    for (a, _), n in documents.items():
        top[a] = max(top[a], n)
    return [
        (doc_id, 0, 0, 0, 0, 0, 0, "") if one is None else (
            doc_id, len(one[0]), len(one[1]), len(one[2]), len(one[3]),
            sum(documents[x] == top[x[0]] for x in one[3]), sum(documents[x] for x in one[3]),
            hashlib.sha256(";".join(one[2]).encode()).hexdigest(),
        )
        for doc_id, one in found
    ]


@pytest.mark.parametrize("table_bytes", [token_alignment.TABLE_BYTES, 10])
def test_alignment(spark, odd, none, table_bytes):
    """By a broadcast table, and by a join where the table is too large."""
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = brute_alignment(rows)
    assert sum(w[-1] == "" for w in want) >= 4  # null, empty, and a text that holds ▁
    got = token_alignment.align_tokens(odd, table_bytes=table_bytes)
    same_rows(got.collect(), want)
    assert token_alignment.align_tokens(none, table_bytes=table_bytes).count() == 0


def test_alignment_of_the_table(spark, tiny):
    rows = [(r.doc_id, r.text) for r in table(spark, tiny, "documents").collect()]
    same_rows(queries.QUERIES["op13_token_alignment"](spark, tiny).collect(), brute_alignment(rows))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab ▁é\n\t\x1c  '0½中<s>|", max_size=25), max_size=5))
def test_units_are_those_of_whole_texts(texts):
    aligner = CODER.get("aligner") or CODER.setdefault(
        "aligner",
        token_alignment.Aligner(token_alignment.BYTE_LEVEL, token_alignment.PIECES, True))
    batch = token_alignment.Batch(aligner, pa.array(texts, pa.string()))
    want = brute_alignment(list(enumerate(texts)))
    got = zip(batch.sizes_of(aligner.n_a).tolist(), batch.sizes_of(aligner.n_b).tolist(),
              batch.sizes_of(aligner.n_groups).tolist(), batch.by_text(batch.sizes).tolist(),
              batch.digests())
    assert list(got) == [(*w[1:5], w[7]) for w in want]


def test_pairs_are_flushed_and_summed_in_parts(spark, odd, monkeypatch):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    monkeypatch.setattr(token_alignment, "HELD_PAIRS", 8)
    monkeypatch.setattr(token_alignment, "SUMMED_AT_ONCE", 2)
    monkeypatch.setattr(token_alignment, "TABLE_BYTES", 200)  # hashes in many slices
    same_rows(token_alignment.align_tokens(odd).collect(), brute_alignment(rows))


def test_perfect_hash_is_minimal_and_verified():
    draw = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 5000):
        keys = np.unique(draw.integers(0, 1 << 48, n))
        table_ = PerfectHash.from_bytes(PerfectHash.of(keys).to_bytes())
        assert sorted(table_.index(keys).tolist()) == list(range(len(keys)))
    assert len(table_.to_bytes()) < len(keys)  # bits, not bytes, a key
    with pytest.raises(ValueError, match="must differ"):
        PerfectHash.of(np.array([5, 5]))
    counts = CountTable(1)
    counts.add(0, table_.to_bytes(), keys[np.argsort(table_.index(keys))].tobytes(),
               np.arange(len(keys)).tobytes())
    assert counts.look_up(keys).tolist() == table_.index(keys).tolist()
    with pytest.raises(KeyError):
        counts.look_up(np.array([keys[0], (1 << 50) + 3]))


def test_new_queries_give_a_row_for_each_document_or_piece(spark, tiny):
    docs = table(spark, tiny, "documents")
    packed = queries.QUERIES["op11_packing"](spark, tiny)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id",
                              "offset"]
    assert packed.where("piece = 0").count() == docs.count()
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert used.agg(F.max("n")).first()[0] <= 4096
    assert used.count() <= 1 + packed.agg(F.sum("length")).first()[0] // 4095
