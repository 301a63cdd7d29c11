"""An adaptive range coder for token ids, many blocks at a time.

A block is up to BLOCK ids and starts with empty models. Orders 2 and 1 predict the id that last
followed the same two ids or the same id; order 0 predicts ids by how long ago they were last
used. For each id a class is coded: the order-2 prediction, else the order-1 prediction, else an
id used before, else a new one. The class's probabilities are mixed by adding the counts that
three small models keep, in the contexts of how often the order-2 context was met, how often the
order-1 context was met and whether both agree, and the class before. Of an id used before the
distance is coded, each power of two being as likely as the others; a new id takes 16 bits.

Blocks are independent, so the NumPy code takes step t of all blocks at once. The encoder knows
all ids, so it finds what each context was followed by beforehand, from contexts sorted by block;
only counts and ranges go step by step. The decoder keeps tables by context. Four 16-bit counts
are kept in one 64-bit word; multiplying it by ONES gives their running sums. All numbers are
integers, so encoder and decoder agree on every machine.
"""

from __future__ import annotations

import zlib

import numpy as np

BLOCK = 1024
TABLE_BITS = 10  # contexts are hashed to so many bits; what collides is predicted worse
SAME2, SAME1, SEEN, NEW = range(4)

U64, U32 = np.uint64, np.uint32
# Words of 32 bits are shifted out. A settled range is at least TOP, enough for a class (16 bits)
# and what follows it (16 more).
WORD, TOP, LOW_MASK = U64(32), U64(1 << 32), U64((1 << 32) - 1)
LAST_COUNT, COUNT_MASK = U64(48), U64(0xFFFF)
ONES = U64(0x0001_0001_0001_0001)
# Counts: one of each class, and 4 for each event. Three models of 1,024 events stay below 2 ** 16.
CLASS_STEP = np.array([4 << (16 * k) for k in range(4)], dtype=U64)
SHIFTS = np.array([0, 16, 32, 48], dtype=U64)
# What follows a class takes a share of the range: of an id used before by its distance, 1 to
# BLOCK - 1, each power of two having 2 ** POWER_BITS parts; of a new id by its 16 bits.
POWER_BITS = (BLOCK - 1).bit_length() - 1
POWERS = (POWER_BITS + 1) << POWER_BITS
PARTS = np.array([1, 1, POWERS, 1 << 16], dtype=U64)
POWER = np.array([max(0, d.bit_length() - 1) for d in range(BLOCK)], dtype=np.int64)
# start and size by distance; 0 stands for no id used before
SEEN_SIZE = 1 << (POWER_BITS - POWER)
SEEN_START = (POWER << POWER_BITS) + (np.arange(BLOCK) - (1 << POWER)) * SEEN_SIZE
SEEN_START[0], SEEN_SIZE[0] = 0, 1
DISTANCE = np.repeat(np.arange(1, BLOCK), SEEN_SIZE[1:])  # of each part
PART_START, PART_SIZE = SEEN_START.astype(U64)[DISTANCE], SEEN_SIZE.astype(U64)[DISTANCE]
SEEN_START, SEEN_SIZE = SEEN_START.astype(np.uint16), SEEN_SIZE.astype(np.uint16)
LANES_A_SORT = 64


def hash1(a: np.ndarray) -> np.ndarray:
    return (a * U32(0x9E3779B1)) >> U32(32 - TABLE_BITS)


def hash2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = (a * U32(0x9E3779B1)) ^ (b * U32(0x85EBCA6B))
    mixed ^= mixed >> U32(15)
    return (mixed * U32(0x2C1B3C6D)) >> U32(32 - TABLE_BITS)


def before(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the same key stood last in the row (0 if nowhere), and how often it did, 3 for more."""
    rows, n = keys.shape
    order = np.sort((keys << U32(16)) | np.arange(n, dtype=U32), axis=1)
    key, at = order >> U32(16), (order & U32(0xFFFF)).astype(np.intp)
    met = np.zeros((rows, n), dtype=np.uint8)
    for k in range(1, min(4, n)):
        met[:, k:] += key[:, k:] == key[:, :-k]
    found = met.astype(np.intp)
    found[:, 1:] |= (at[:, :-1] << 2) * (met[:, 1:] > 0)
    at += np.arange(rows)[:, None] * n
    out = np.empty((rows, n), dtype=np.intp)
    out.reshape(-1)[at] = found
    return out >> 2, (out & 3).astype(np.uint8)


def events(ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each id of some blocks (rows): its class, the cells of orders 2 and 1, and the start
    and size of the share that follows the class."""
    rows, n = ids.shape
    past = np.zeros((rows, n + 2), dtype=np.uint16)  # as two ids 0 stand before a block
    past[:, 2:] = ids
    row = np.arange(rows)[:, None] * (n + 2)
    wide = past.astype(U32)
    last, met = before(hash1(wide[:, 1:]))
    last1, met1, last0, met0 = last[:, :-1], met[:, :-1], last[:, 1:], met[:, 1:]
    last2, met2 = before(hash2(wide[:, :n], wide[:, 1 : n + 1]))
    guess1 = past.take(last1 + (row + 2)) * (met1 > 0)
    guess2 = past.take(last2 + (row + 2)) * (met2 > 0)
    # the context before the first id is none of the ids
    known = (past.take(last0 + (row + 1)) == ids) & (met0 > 0) & (last0 > 0)
    kind = np.where(known, np.uint8(SEEN), np.uint8(NEW))
    kind[(guess1 == ids) & (met1 > 0)] = SAME1
    kind[(guess2 == ids) & (met2 > 0)] = SAME2
    distance = (np.arange(1, n + 1) - last0) * (kind == SEEN)
    start = SEEN_START.take(distance) + ids * (kind == NEW)
    cell1 = met1 * np.uint8(2) + (guess1 == guess2)
    return kind, met2, cell1, start, SEEN_SIZE.take(distance)


class Lanes:
    """Counts and ranges of the coders of many blocks; lane i is block i, longest first."""

    def __init__(self, sizes: np.ndarray):
        n, self.steps = len(sizes), int(sizes[0])
        self.n, self.lane = n, np.arange(n)
        self.lane4, self.lane8 = self.lane * 4, self.lane * 8
        self.active = np.searchsorted(-sizes, -np.arange(self.steps), side="left")
        self.by_order2 = np.full(n * 4, ONES, dtype=U64)
        self.by_order1 = np.full(n * 8, ONES, dtype=U64)
        self.by_last = np.full(n * 4, ONES, dtype=U64)
        self.last = self.lane4 + NEW
        self.low = np.zeros(n, dtype=U64)
        self.range = np.full(n, np.iinfo(np.uint64).max, dtype=U64)

    def open(self, met2: np.ndarray, order1: np.ndarray) -> None:
        """Adds up the counts of the cells of the first lanes."""
        n = len(met2)
        cell2, cell1, cell0 = met2.astype(np.intp), order1.astype(np.intp), self.last[:n]
        cell2 += self.lane4[:n]
        cell1 += self.lane8[:n]
        self.cells = cell2, cell1, cell0
        self.had = self.by_order2[cell2], self.by_order1[cell1], self.by_last[cell0]
        self.counts = self.had[0] + self.had[1] + self.had[2]
        self.ends = self.counts * ONES

    def close(self, kind: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Narrows ranges to the class, counts it, and gives how far the lows were moved."""
        n = len(kind)
        shift = SHIFTS[kind]
        freq = (self.counts >> shift) & COUNT_MASK
        moved = r * (((self.ends >> shift) & COUNT_MASK) - freq)
        self.low[:n] += moved
        np.multiply(r, freq, out=self.range[:n])
        step = CLASS_STEP[kind]
        for table, cell, had in zip(
            (self.by_order2, self.by_order1, self.by_last), self.cells, self.had
        ):
            table[cell] = had + step
        np.add(self.lane4[:n], kind, out=self.last[:n])
        return moved

    def settle(self, n: int) -> None:
        """Shifts out top words that no longer change, until every range is at least TOP."""
        at = (self.range[:n] < TOP).nonzero()[0]
        while len(at):
            low, rng = self.low[at], self.range[at]
            # a small range across a border of the top word: give up the part beyond it
            cut = ((low ^ (low + rng)) >= TOP).nonzero()[0]
            rng[cut] = (U64(0) - low[cut]) & LOW_MASK
            self.shift(at, low)
            rng <<= WORD
            self.low[at], self.range[at] = low << WORD, rng
            at = at[rng < TOP]


class Encoder(Lanes):
    def shift(self, at: np.ndarray, low: np.ndarray) -> None:
        self.lanes.append(at.astype(np.uint16 if self.n <= 1 << 16 else np.int64))
        self.words.append((low >> WORD).astype(U32))

    def run(self, ids: np.ndarray) -> list[bytes]:
        """The code of each block; ids are lanes x steps."""
        self.lanes, self.words = [], []
        kinds = np.empty((self.steps, self.n), dtype=np.uint8)
        met2s, order1s = np.empty_like(kinds), np.empty_like(kinds)
        starts = np.empty((self.steps, self.n), dtype=np.uint16)
        sizes = np.empty_like(starts)
        for a in range(0, self.n, LANES_A_SORT):
            found = events(ids[a : a + LANES_A_SORT])
            for whole, part in zip((kinds, met2s, order1s, starts, sizes), found):
                whole[:, a : a + LANES_A_SORT] = part.T
        for t in range(self.steps):
            n = int(self.active[t])
            kind = kinds[t, :n].astype(np.intp)
            self.open(met2s[t, :n], order1s[t, :n])
            self.close(kind, self.range[:n] // (self.ends >> LAST_COUNT))
            low, rng = self.low[:n], self.range[:n]
            rng //= PARTS[kind]
            low += rng * starts[t, :n]
            rng *= sizes[t, :n]
            self.settle(n)
        for _ in range(2):
            self.shift(self.lane, self.low)
            self.low <<= WORD
        lanes, words = np.concatenate(self.lanes), np.concatenate(self.words)
        words = words[np.argsort(lanes, kind="stable")].astype("<u4").tobytes()
        ends = 4 * np.cumsum(np.bincount(lanes, minlength=self.n))
        return [words[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


class Decoder(Lanes):
    """`words` are the 32-bit words of the codes, words x lanes."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        super().__init__(sizes)
        n = self.n
        self.words, self.place = words.reshape(-1), self.lane + 2 * n
        # how far the code is above the low
        self.above = (words[0].astype(U64) << WORD) | words[1]
        self.ids = np.zeros((self.steps, n), dtype=np.uint16)
        # by context: the id that followed it last * 4 + times met, 3 for more
        self.after2 = np.zeros(n << TABLE_BITS, dtype=U32)
        self.after1 = np.zeros(n << TABLE_BITS, dtype=U32)
        self.at_table = self.lane << TABLE_BITS

    def shift(self, at: np.ndarray, low: np.ndarray) -> None:
        place = self.place[at]
        self.above[at] = (self.above[at] << WORD) | self.words[place]
        self.place[at] = place + self.n

    def run(self) -> None:
        before1 = np.zeros(self.n, dtype=U32)
        before2 = np.zeros(self.n, dtype=U32)
        flat = self.ids.reshape(-1)
        for t in range(self.steps):
            n = int(self.active[t])
            before1, before2 = before1[:n], before2[:n]
            at1 = hash1(before1).astype(np.intp)
            at1 += self.at_table[:n]
            at2 = hash2(before2, before1).astype(np.intp)
            at2 += self.at_table[:n]
            after1, after2 = self.after1[at1], self.after2[at2]
            met1, met2 = after1 & U32(3), after2 & U32(3)
            guess1, guess2 = after1 >> U32(2), after2 >> U32(2)
            self.open(met2, (met1 << U32(1)) | (guess1 == guess2))
            ends, above, rng = self.ends, self.above[:n], self.range[:n]
            r = rng // (ends >> LAST_COUNT)
            kind = (above >= r * (ends & COUNT_MASK)).astype(np.intp)
            kind += above >= r * ((ends >> U64(16)) & COUNT_MASK)
            kind += above >= r * ((ends >> U64(32)) & COUNT_MASK)
            above -= self.close(kind, r)
            got = np.where(kind == SAME2, guess2, guess1)
            at = (kind == SEEN).nonzero()[0]
            if len(at):
                high, r = above[at], rng[at] // U64(POWERS)
                # damaged codes may point beyond what there is
                part = np.minimum(high // r, U64(POWERS - 1)).astype(np.intp)
                back = t - DISTANCE[part]
                got[at] = flat[np.maximum(back, 0) * self.n + at]
                moved = r * PART_START[part]
                self.low[at] += moved
                above[at] = high - moved
                rng[at] = r * PART_SIZE[part]
            at = (kind == NEW).nonzero()[0]
            if len(at):
                high, r = above[at], rng[at] >> U64(16)
                new = np.minimum(high // r, COUNT_MASK)
                got[at] = new
                moved = r * new
                self.low[at] += moved
                above[at] = high - moved
                rng[at] = r
            self.settle(n)
            self.ids[t, :n] = got
            follows = got << U32(2)
            self.after1[at1] = follows | np.minimum(met1 + U32(1), U32(3))
            self.after2[at2] = follows | np.minimum(met2 + U32(1), U32(3))
            before1, before2 = got, before1


def _longest_first(sizes: list[int]) -> tuple[list[int], np.ndarray]:
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    return order, np.array([sizes[i] for i in order], dtype=np.int64)


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """The code of each block: at most BLOCK ids, all below 2 ** 16."""
    if any(len(b) > BLOCK for b in blocks):
        raise ValueError(f"a block holds at most {BLOCK} ids")
    coded: list = [b""] * len(blocks)
    order, sizes = _longest_first([len(b) for b in blocks])
    if not len(sizes) or not sizes[0]:
        return coded
    lanes = Encoder(sizes)
    ids = np.zeros((lanes.n, lanes.steps), dtype=np.uint16)
    for k, i in enumerate(order):
        ids[k, : sizes[k]] = blocks[i]
    for i, size, code in zip(order, sizes, lanes.run(ids)):
        if size:
            coded[i] = code
    return coded


def decode(codes: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block, given its code and the number of its ids."""
    order, ordered = _longest_first(sizes)
    if not len(ordered) or not ordered[0]:
        return [np.zeros(0, dtype=np.uint16) for _ in codes]
    words = np.zeros((len(codes), max(map(len, codes)) // 4 + 8), dtype=U32)
    for k, i in enumerate(order):
        words[k, : len(codes[i]) // 4] = np.frombuffer(codes[i], dtype="<u4")
    lanes = Decoder(ordered, np.ascontiguousarray(words.T))
    lanes.run()
    found = lanes.ids.T.copy()
    out: list = [None] * len(codes)
    for k, i in enumerate(order):
        out[i] = found[k, : sizes[i]]
    return out


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u2").tobytes())
