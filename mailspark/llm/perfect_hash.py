"""Minimal perfect hashing of 64-bit keys, and dense count vectors indexed by it.

Level by level the keys that are left are hashed to twice as many places; those alone at theirs
stay there, the others go on. A key's index is the number of taken places before its own, so n
different keys get the numbers 0 to n - 1. A key that was not built in gets some index too, so
every look-up is verified against the key kept at the index.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
PLACES_A_KEY = 2
MISSING = -1


def mix(keys: np.ndarray, level: int) -> np.ndarray:
    """A hash of each key, another one for each level."""
    x = keys.astype(U64) + U64((level * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class PerfectHash:
    """`sizes` places and bit words of each level."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.n = int(ones.sum())

    @classmethod
    def of(cls, keys: np.ndarray) -> "PerfectHash":
        """For different keys; repeated ones raise ValueError."""
        sizes, words, rest = [], [], keys
        while len(rest):
            if len(sizes) == 200:
                raise ValueError("keys of a perfect hash must differ")
            size = -(-max(64, PLACES_A_KEY * len(rest)) // 64) * 64
            place = mix(rest, len(sizes)) % U64(size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view(U64))
            rest = rest[~alone[place.astype(np.int64)]]
        return cls(sizes, np.concatenate([*words, np.zeros(0, dtype=U64)]))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """A number below n for each key, its own for those built in; MISSING for some others."""
        out = np.full(len(keys), MISSING, dtype=np.int64)
        left, first = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            place = mix(keys[left], level) % U64(size)
            word = (place >> U64(6)).astype(np.int64) + first
            bit = place & U64(63)
            taken = ((self.words[word] >> bit) & U64(1)).astype(bool)
            below = self.words[word] & ((U64(1) << bit) - U64(1))
            number = self.before[word] + np.bitwise_count(below)
            out[left[taken]] = number[taken]
            left, first = left[~taken], first + size // 64
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), *self.sizes], dtype="<u8")
        return head.tobytes() + self.words.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> "PerfectHash":
        numbers = np.frombuffer(data, dtype="<u8")
        levels = int(numbers[0])
        return cls(numbers[1 : 1 + levels].tolist(), numbers[1 + levels :].astype(U64))


class Shards:
    """Perfect hashes of many shards; keys are dealt to shards by a hash of their own."""

    def __init__(self, count: int):
        self.count = count
        self.hashes: dict[int, PerfectHash] = {}

    def shard_of(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys, 1000) % U64(self.count)).astype(np.int64)


class CountTable(Shards):
    """Counts of keys: for each shard its hash, the keys in the order of their indexes, and their
    counts."""

    def __init__(self, count: int):
        super().__init__(count)
        self.keys: dict[int, np.ndarray] = {}
        self.counts: dict[int, np.ndarray] = {}

    def add(self, shard: int, data: bytes, keys: bytes, counts: bytes) -> None:
        self.hashes[shard] = PerfectHash.from_bytes(data)
        self.keys[shard] = np.frombuffer(keys, dtype="<i8")
        self.counts[shard] = np.frombuffer(counts, dtype="<i8")

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key; a key that is not in the table raises KeyError."""
        out = np.empty(len(keys), dtype=np.int64)
        shard = self.shard_of(keys)
        order = np.argsort(shard, kind="stable")
        cuts = np.searchsorted(shard[order], np.arange(self.count + 1))
        for number in range(self.count):
            at = order[cuts[number] : cuts[number + 1]]
            if not len(at):
                continue
            if number not in self.hashes:
                raise KeyError(f"{len(at)} keys of shard {number}, which has no table")
            index = self.hashes[number].index(keys[at])
            if (index < 0).any() or (self.keys[number][index] != keys[at]).any():
                raise KeyError(f"keys that the table of shard {number} does not hold")
            out[at] = self.counts[number][index]
        return out
