"""Vectorised hashing of words and word shingles, shared by the operators that work in Arrow batches.

A word is a run of bytes other than space and 0x09-0x0D; A-Z are lower-cased. Every word
gets a 64-bit hash from prefix sums of a polynomial over the bytes (so a block of text costs a
few numpy passes, not a Python step per word), then a bijective mix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15
BLOCK = 1 << 19
FOLD = U(0xD6E8FEB86659FD93)
LENGTH = U(0xA0761D6478BD642F)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(BLOCK + 1, base, dtype=U)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray, most: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts of at most `most` bytes together, or one longer text alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the number of words before it (and in all)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = SPACE[data]
    start = ~space
    end = start.copy()
    start[1:] &= space[:-1]
    end[:-1] &= space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    start[inner] = ~space[inner]
    end[inner - 1] = ~space[inner - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each span of lower-cased bytes. Memory stays bounded for texts of any length."""
    up, down = _powers()
    out = np.zeros(len(starts), dtype=U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        if hi - lo > BLOCK:  # one word longer than a block
            whole = hashlib.blake2b(LOWER[data[lo:hi]].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(whole, "big")
        else:
            x = (LOWER[data[lo:hi]].astype(U) + U(1)) * up[: hi - lo]
            total = np.cumsum(x, dtype=U)
            s, e = starts[i:j] - lo, ends[i:j] - lo
            out[i:j] = (total[e - 1] - total[s] + x[s]) * down[s] + (e - s).astype(U) * LENGTH
        i = j
    return mix(out)


def shingles(words: np.ndarray, before: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words within each text, in order, and the number before each text.

    A text with fewer words, but at least one, has one run: all of them.
    """
    counts = np.diff(before)
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    ahead = np.concatenate(([0], np.cumsum(runs)))
    n = len(words) - size + 1
    out = np.zeros(ahead[-1], dtype=U)
    if n > 0:
        all_runs = words[:n].copy()
        for k in range(1, size):
            all_runs *= FOLD
            all_runs += words[k : k + n]
        long = np.flatnonzero(counts >= size)
        if len(long):
            inside = np.zeros(len(words), bool)
            mark = np.zeros(len(words) + 1, np.int64)
            np.add.at(mark, before[long], 1)
            np.add.at(mark, before[long + 1] - size + 1, -1)
            inside = np.cumsum(mark)[:-1] > 0
            target = np.repeat(counts >= size, runs)
            out[target] = all_runs[inside[:n]]
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        x = U(0)
        with np.errstate(over="ignore"):
            for w in words[before[i] : before[i + 1]]:
                x = x * FOLD + w
            out[ahead[i]] = x + U(int(counts[i])) * LENGTH
    return mix(out), ahead


def text_shingles(data: np.ndarray, offsets: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of texts given as bytes and offsets."""
    starts, ends, before = word_spans(data, offsets)
    return shingles(hash_spans(data, starts, ends), before, size)
