"""DartMinHash: fast signatures of weighted sets.

An element of weight w owns w unit cells. Darts fall on each cell as a Poisson process in time,
one per unit of time on average, made from a hash of the element, the cell and the time region
([0,1), [1,2), [2,4), ...), so equal cells get equal darts in every set. Each dart belongs to one
of k coordinates; a coordinate keeps its earliest dart. Two sets agree in a coordinate with the
probability of their weighted Jaccard similarity. A set of total weight W needs darts until
(k ln k + 2k) / W only; sets that leave a coordinate empty wait twice as long.

Here elements are word shingles. Their weight is their count (the i-th occurrence of a shingle is
its i-th cell) or one: with counts, texts that share one much repeated line look alike.
"""

from __future__ import annotations

import numpy as np
import xxhash

from mailspark.llm.decontamination import words_of

SHINGLE = 5
BANDS, ROWS = 24, 4
K = BANDS * ROWS
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
TIME_BITS = 28  # a dart's time in steps of 2 ** -28, up to 2 ** 12
DART_BITS = np.uint64(24)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def poisson_limits(mean: float) -> np.ndarray:
    """A 64-bit number below entry i, but not below i - 1, stands for i darts."""
    top = int(mean + 12 * mean**0.5 + 12)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, top + 1)))])
    chance = np.exp(np.arange(top + 1) * np.log(mean) - mean - logs)
    below = np.minimum(np.cumsum(chance), 1.0)
    return (below[below < 1.0 - 1e-15] * 2.0**64).astype(np.uint64)


def shingle_hashes(words: list[list[bytes]], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted hashes of each text's shingles, repeats included. A text of fewer words than a
    shingle has one shingle, all its words; a text without words has none."""
    digest = xxhash.xxh64_intdigest
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.fromiter(
        (digest(x) for w in words for x in w), dtype=np.uint64, count=int(sizes.sum())
    )
    prime = np.uint64(0x100000001B3)
    rolled = np.zeros(max(0, len(flat) - size + 1), dtype=np.uint64)
    for j in range(size):
        rolled = rolled * prime + flat[j : j + len(rolled)]
    rolled = mix(rolled)
    out, start = [], 0
    for n in sizes.tolist():
        if n >= size:
            out.append(np.sort(rolled[start : start + n - size + 1]))
        elif n:
            short = digest(flat[start : start + n].tobytes())
            out.append(mix(np.array([short], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        start += n
    return out


def occurrence(hashes: np.ndarray) -> np.ndarray:
    """Which occurrence of its value each entry of a sorted array is, from 0."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    fresh = np.concatenate([[True], hashes[1:] != hashes[:-1]])
    starts = np.flatnonzero(fresh)
    return np.arange(len(hashes)) - np.repeat(starts, np.diff(np.append(starts, len(hashes))))


def cells_of(hashes: np.ndarray) -> np.ndarray:
    """One number for each cell: the shingle and which occurrence it is."""
    nth = occurrence(hashes)
    return np.where(nth == 0, hashes, mix(hashes + nth.astype(np.uint64) * GOLDEN))


def signatures(sets: list[np.ndarray], k: int = K) -> np.ndarray:
    """sets x k: the earliest dart of each coordinate, for sets of cells. Empty sets have EMPTY
    in every coordinate."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    best = np.full(len(sets) * k, EMPTY, dtype=np.uint64)
    if not sizes.sum():
        return best.reshape(len(sets), k)
    cells = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    done = np.zeros(len(sets))
    until = (k * np.log(k) + 2 * k) / np.maximum(sizes, 1)
    open_ = sizes > 0
    while open_.any():
        at = np.flatnonzero(open_[owner])
        throw(cells[at], owner[at], done, until, best, k)
        open_ &= (best.reshape(-1, k) == EMPTY).any(axis=1)
        done, until = until, until * 2
    return best.reshape(len(sets), k)


def throw(cells, owner, since, until, best, k: int) -> None:
    """The darts of the cells at times from `since` to `until` of their owners, into `best`."""
    first, last, region = 0.0, 1.0, 0
    while True:
        some = (until[owner] > first) & (since[owner] < last)
        cells_now, owner_now = cells[some], owner[some]
        if not (until[owner] > first).any():
            return
        if len(cells_now):
            salt = mix(np.array([region + 1], dtype=np.uint64))[0]
            seed = mix(cells_now ^ salt)
            n = np.searchsorted(poisson_limits(last - first), seed, side="right")
            starts = np.cumsum(n) - n
            which = np.repeat(np.arange(len(n)), n)
            number = (np.arange(len(which)) - starts[which]).astype(np.uint64)
            dart = mix(seed[which] + (number + np.uint64(1)) * GOLDEN)
            time = first + (last - first) * ((dart >> np.uint64(11)) * 2.0**-53)
            owner_of = owner_now[which]
            hit = (time < until[owner_of]) & (time >= since[owner_of])
            dart, time, owner_of = mix(dart[hit] + GOLDEN), time[hit], owner_of[hit]
            step = np.minimum(time * 2.0**TIME_BITS, 2.0**40 - 2).astype(np.uint64)
            value = (step << DART_BITS) | (dart >> np.uint64(40))
            place = owner_of * k + (dart & np.uint64(0xFFFFFFFF)).astype(np.int64) % k
            np.minimum.at(best, place, value)
        first, last, region = last, last * 2, region + 1


def band_hashes(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """sets x bands: one number for the coordinates of each band, and the band."""
    parts = signature.reshape(len(signature), bands, signature.shape[1] // bands)
    out = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for r in range(parts.shape[2]):
        out = mix(out * GOLDEN + parts[:, :, r])
    return out


def elements(hashes: np.ndarray, counted: bool = False) -> np.ndarray:
    """The cells of a text's shingles: all of them, or one for each distinct shingle."""
    return cells_of(hashes) if counted else hashes[occurrence(hashes) == 0]


def sketch(texts: list[str], counted: bool = False) -> list[tuple[int, list[int]]]:
    """Node (equal for texts of the same elements) and bands of each text. A text without words
    has no bands, and a node of its own text."""
    sets = [elements(h, counted) for h in shingle_hashes([words_of(t) for t in texts])]
    nodes = [
        xxhash.xxh3_128_digest(x.tobytes() if len(x) else b"text" + t.encode())[:8]
        for x, t in zip(sets, texts)
    ]
    bands = band_hashes(signatures(sets)).view(np.int64).tolist()
    return [
        (int.from_bytes(node, "little", signed=True), b if len(x) else [])
        for node, b, x in zip(nodes, bands, sets)
    ]


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - shared
    return shared / union if union else 1.0
