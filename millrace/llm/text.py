"""Words of many texts at once, as 64-bit hashes.

The work is on arrays of UTF-8 bytes, in blocks of about a million, so memory follows the block and the number of words,
never the square of anything. A word's hash depends on its bytes alone, whatever the block it lies in.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
SHINGLE = 5
#: The share of common shingles from which two texts are near duplicates.
SIMILAR = (75, 100)

_random = np.random.Generator(np.random.PCG64(20240229))
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = int(_random.integers(1 << 60, 1 << 62)) * 2 + 1
_SHINGLE_STEPS = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

WHITE = np.zeros(256, np.bool_)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Kinds of bytes: 0 parts words, runs of one kind make a word.
PLAIN = np.where(WHITE, 0, 1).astype(np.uint8)
_letters = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
WORD_OR_SIGN = np.where(WHITE, 0, 2).astype(np.uint8)
WORD_OR_SIGN[_letters] = 1
LETTERS = np.zeros(256, np.uint8)
LETTERS[[c for c in _letters if c > 0x39]] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
SAME = np.arange(256, dtype=np.uint8)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(BLOCK, 1 << (n - 1).bit_length()) + 1
    if size not in _powers:
        _powers.clear()
        both = []
        for step in (_STEP, pow(_STEP, -1, 1 << 64)):
            run = np.full(size, step, np.uint64)
            run[0] = 1
            both.append(np.multiply.accumulate(run))
        _powers[size] = (both[0], both[1])
    return _powers[size]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, and where each text begins and the last one ends. A null is an empty text."""
    texts = pc.fill_null(texts, "")
    _, offsets, data = texts.buffers()
    if offsets is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    every = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return every[bounds[0]:bounds[-1]], bounds - bounds[0]


@dataclass
class Words:
    """hash, start and end (bytes) of every word; ``first[t]`` is the number of words before text t."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def of(self, text: int) -> np.ndarray:
        return self.hash[self.first[text]:self.first[text + 1]]


def words(data: np.ndarray, bounds: np.ndarray, kinds: np.ndarray = PLAIN, fold: np.ndarray = LOWER) -> Words:
    """Maximal runs of bytes of one kind (not 0) within one text; ``fold`` maps bytes before hashing."""
    values, found = _VALUE[fold], []
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + BLOCK)
        while end < n and end not in bounds[np.searchsorted(bounds, end):][:1] and kinds[data[end]]:
            stop = np.flatnonzero(kinds[data[end:end + BLOCK]] == 0)
            limit = int(bounds[np.searchsorted(bounds, end)])
            end = min(end + (int(stop[0]) if len(stop) else BLOCK), limit, n)
        piece = data[at:end]
        kind = kinds[piece]
        change = np.empty(len(piece) + 1, np.bool_)
        change[0] = change[-1] = True
        np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
        low, high = np.searchsorted(bounds, [at, end])
        change[bounds[low:high] - at] = True
        edge = np.flatnonzero(change)
        inside = kind[edge[:-1]] != 0
        start, stop = edge[:-1][inside], edge[1:][inside]
        power, inverse = _power_tables(len(piece))
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(values[piece] * power[:len(piece)], out=total[1:])
        found.append(((total[stop] - total[start]) * inverse[start], start + at, stop + at))
        at = end
    if not found:
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), empty, empty, np.zeros(len(bounds), np.int64))
    hashes, starts, ends = (np.concatenate(x) for x in zip(*found))
    hashes = mix(hashes + (ends - starts).astype(np.uint64))
    return Words(hashes, starts, ends, np.searchsorted(starts, bounds))


def runs_of(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A hash for each run of ``size`` successive hashes (none if there are fewer)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += hashes[k:k + n] * _SHINGLE_STEPS[k]
    return mix(total)


def shingle_set(hashes: np.ndarray) -> np.ndarray:
    """The sorted distinct shingles of one text; a text of one to four words has its whole sequence as one."""
    if not len(hashes):
        return hashes
    if len(hashes) < SHINGLE:
        return mix((hashes * _SHINGLE_STEPS[:len(hashes)]).sum(dtype=np.uint64, keepdims=True)
                   + np.uint64(len(hashes)))
    return np.unique(runs_of(hashes))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def similar(a: int, b: int, both: int) -> bool:
    """Whether sets of sizes a and b that share ``both`` elements are near duplicates."""
    part, whole = SIMILAR
    return whole * both >= part * (a + b - both)


def strings(texts: pa.Array) -> list[str]:
    return pc.fill_null(texts, "").to_pylist()
