"""Texts as sequences of distinct units, so that a tokenizer sees each unit once.

A unit is a run of ASCII white space and the run of other bytes after it. A byte-level tokenizer that splits at white
space gives a text the tokens of its units in order, except where other white space (a no-break space, say) touches
ASCII white space; such texts are one unit each.
"""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable
from functools import lru_cache, wraps
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vigil.llm import words

#: White space outside ASCII beside white space: the units of such a text depend on each other.
_OTHER_WHITE = "[" + "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])) + "]"
_MIXED = re.compile(rf"{_OTHER_WHITE}[\t-\r ]|[\t-\r ]{_OTHER_WHITE}")
BATCH_BYTES = 4 << 20
IDS_A_UNIT = 8  # long units (texts without white space) fill a lookup by their ids
_PER_WORKER: list = []  # functions whose results stay for the life of a Python worker


def per_worker(build):
    """``build`` with its results kept for the life of the Python worker, or until a step that needs none of them begins.

    Before it builds, memory that earlier steps freed but the worker still holds goes back."""
    @lru_cache(maxsize=2)
    @wraps(build)
    def kept(*args):
        release()
        return build(*args)

    _PER_WORKER.append(kept)
    return kept


def forget() -> None:
    """Gives back what earlier steps keep in this Python worker, which Spark hands from step to step."""
    for kept in _PER_WORKER:
        kept.cache_clear()
    release()


def release() -> None:
    """Gives freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries hold freed memory back
    if trim:
        trim(0)


def batches(rows, column: str, limit: int = BATCH_BYTES):
    """The record batches cut so that each holds about ``limit`` bytes of text, or one longer text."""
    for batch in rows:
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.cumsum(np.asarray(pc.binary_length(texts.fill_null("")), dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(sizes[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def split(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begins, ends, firsts): the units of all texts in order; text i has units firsts[i]:firsts[i + 1]."""
    data, starts = words.text_bytes(column)
    if not len(data):
        return data, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(starts), np.int64)
    white = words._WHITE[data]
    begin = np.zeros(len(data), dtype=bool)
    begin[1:] = white[1:] & ~white[:-1]
    if (data >= 0x80).any():  # a text with mixed white space stays whole
        view = memoryview(data)
        for i in np.flatnonzero(np.diff(starts)):
            a, b = int(starts[i]), int(starts[i + 1])
            if (data[a:b] >= 0x80).any() and _MIXED.search(str(view[a:b], "utf-8")):
                begin[a:b] = False
    begin[starts[:-1][np.diff(starts) > 0]] = True
    begins = np.flatnonzero(begin)
    return data, begins, np.append(begins[1:], len(data)), np.searchsorted(begins, starts)


def ragged(values: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[begins[0]:begins[0] + lengths[0]], then the next stretch, ... in one array."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return values[np.arange(total, dtype=np.int64) + np.repeat(begins - (ends - lengths), lengths)]


def joined(values: pa.Array, at: np.ndarray, stops: np.ndarray, separator: bytes) -> list[memoryview]:
    """Bytes of each row: row i has ``values`` (large_binary) at at[stops[i]:stops[i + 1]], joined by ``separator``."""
    rows = pa.LargeListArray.from_arrays(pa.array(stops, pa.int64()), values.take(pa.array(at)))
    out = pc.binary_join(rows, pa.scalar(separator, pa.large_binary()))
    _, offsets, data = out.buffers()
    ends = np.frombuffer(offsets, dtype=np.int64)[out.offset:out.offset + len(out) + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    return [view[a:b] for a, b in zip(ends, ends[1:])]


class Known:
    """Token ids of units seen so far, by a 64-bit hash of their bytes; starts anew above ``most`` units, or 8 times as many ids.

    It lives as long as the Python worker. Two units of one hash would share ids: a chance of 10^-7 per million units.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], most: int = 1_500_000):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.keys = np.empty(0, dtype=np.uint64)
        self.begins = np.empty(0, dtype=np.int64)
        self.lengths = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.int32)

    def places(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The place of each unit among ``begins`` and ``lengths``; unknown ones are encoded first."""
        hashes = hashed(data, begins, ends)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > self.most or len(self.ids) > IDS_A_UNIT * self.most:
            self.clear()
        at = np.searchsorted(self.keys, distinct)
        at[at == len(self.keys)] = 0
        new = self.keys[at] != distinct if len(self.keys) else np.ones(len(distinct), dtype=bool)
        if new.any():
            ids, starts, lengths = self.encoded(data, begins[first[new]], ends[first[new]])
            into = np.searchsorted(self.keys, distinct[new])  # both are in order
            self.begins = np.insert(self.begins, into, len(self.ids) + starts)
            self.lengths = np.insert(self.lengths, into, lengths)
            self.ids, self.keys = np.concatenate([self.ids, ids]), np.insert(self.keys, into, distinct[new])
            at = np.searchsorted(self.keys, distinct)
        return at[which]

    def encoded(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, lengths): unit i has ids[starts[i]:starts[i] + lengths[i]]."""
        view = memoryview(data)
        found = self.encode([bytes(view[a:b]) for a, b in zip(begins.tolist(), ends.tolist())])
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        ids = np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(lengths.sum()))
        return ids, np.cumsum(lengths) - lengths, lengths


class Units(Known):
    """Ids of units, which ``encode`` gives as the bytes of 32-bit numbers: they take little memory and no garbage collection."""

    def encoded(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        view = memoryview(data)
        found = self.encode([bytes(view[a:b]) for a, b in zip(begins.tolist(), ends.tolist())])
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        return np.frombuffer(b"".join(found), dtype=np.int32), np.cumsum(lengths) - lengths, lengths


def hashed(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes that follow each other."""
    out = np.empty(len(begins), dtype=np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(begins):
            j = max(i + 1, int(np.searchsorted(ends, begins[i] + words.SEGMENT, side="right")))
            low, high = int(begins[i]), int(ends[j - 1])
            size = words.SEGMENT if high - low <= words.SEGMENT else 1 << (high - low).bit_length()
            up, down = words._powers(size)
            sums = np.zeros(high - low + 1, dtype=np.uint64)
            np.cumsum(words._OF_BYTE[data[low:high]] * up[:high - low], out=sums[1:])
            b, e = begins[i:j] - low, ends[i:j] - low
            out[i:j] = words.mixed((sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64))
            i = j
    return out
