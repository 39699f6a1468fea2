"""Words and shingles of whole texts as 64-bit hashes, in numpy over the bytes of an Arrow column."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 17  # bytes hashed at a time, so that the running sums take about a MB each; a longer word lengthens its segment
_STEP = 0x9E3779B97F4A7C15
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mixed((np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 20)) * np.uint64(_STEP))


_OF_BYTE = numbers(256, 1)
_ODD = int(numbers(1, 2)[0]) | 1
_FACTORS = numbers(64, 3) | np.uint64(1)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    def of(base: int) -> np.ndarray:
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)
    return of(_ODD), of(pow(_ODD, -1, 1 << 64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text begins (one more at the end). Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or data is None:
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[starts[0]:starts[-1]], starts - starts[0]


def word_hashes(data: np.ndarray, starts: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs without white space) of all texts in order, and where each text's words begin.

    With ``fold``, A-Z count as a-z. The hash is a sum over the bytes times powers of an odd number, so all words of a
    segment come from one running sum.
    """
    if not len(data):
        return np.empty(0, dtype=np.uint64), np.zeros(len(starts), dtype=np.int64)
    inside = ~_WHITE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[starts] = True
    first = inside & edge[:-1]
    first[1:] |= inside[1:] & ~inside[:-1]
    last = inside & edge[1:]
    last[:-1] |= inside[:-1] & ~inside[1:]
    last[-1] = inside[-1]
    begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.empty(len(begins), dtype=np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(begins):
            j = max(i + 1, int(np.searchsorted(ends, begins[i] + SEGMENT, side="right")))
            low, high = int(begins[i]), int(ends[j - 1])
            size = SEGMENT if high - low <= SEGMENT else 1 << (high - low).bit_length()
            up, down = _powers(size)
            part = data[low:high]
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(_OF_BYTE[_FOLD[part] if fold else part] * up[:len(part)], out=sums[1:])
            b, e = begins[i:j] - low, ends[i:j] - low
            hashes[i:j] = mixed((sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64))
            i = j
    return hashes, np.searchsorted(begins, starts)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words of one text; of the whole run when it has fewer; none without words."""
    if not len(words):
        return words
    width = min(size, len(words))
    with np.errstate(over="ignore"):
        total = np.full(len(words) - width + 1, width, dtype=np.uint64)
        for k in range(width):
            total += words[k:len(words) - width + 1 + k] * _FACTORS[k]
        return mixed(total)
