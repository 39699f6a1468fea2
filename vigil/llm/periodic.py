"""Periodic run detection by an online sparse diagonal DP over the words of whole texts.

Words are numbered from 0. For each word j, every earlier occurrence i of the same word lies on the diagonal of lag
d = j - i; the diagonal's match length grows by one when word j - 1 also matched at lag d, else starts at one. When a
diagonal stops, its matches m at lag d span the stretch of words [first match - d, last match], which has period d and
length m + d; it is a run when m >= d and m + d >= 12 (RUN_WORDS) and no smaller lag ends with the same stretch (a
stretch of length at least twice d has all its periods among the divisors of its smallest one, and those diagonals end
at the same word and start at the same stretch). Words are swept in blocks whose pairs fit PAIRS_AT_ONCE; the match
lengths of diagonals that reach the end of a block are carried into the next, so the result does not depend on blocks.

Work is the number of pairs of equal words, which grows with the square of a word's count in one text; memory is
bounded by the block size and the number of words of the longest text.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vigil.llm import units

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUN_WORDS = 12  # fixed value of the contract: shortest run
PAIRS_AT_ONCE = 1 << 22


def planted(doc_id, words: list[str]) -> list[str]:
    """The contract's planted repetition: h = crc32 of the decimal doc_id; when h % 10 == 0 every word from a on repeats
    the p words from a. A null doc_id plants nothing."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of word ids, by start, then period."""
    n = len(ids)
    if n < RUN_WORDS:
        return []
    order = np.lexsort((np.arange(n), ids))
    sorted_ids = ids[order]
    group_start = np.r_[0, np.flatnonzero(sorted_ids[1:] != sorted_ids[:-1]) + 1]
    begin_of = np.repeat(group_start, np.diff(np.r_[group_start, n]))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n) - begin_of  # earlier occurrences of each word
    first_in_group = np.empty(n, dtype=np.int64)
    first_in_group[order] = begin_of
    carried_len = {}  # lag -> (last matched word, match length) of diagonals still open at a block's end
    found = {}  # (start, end) -> smallest lag
    cum = np.cumsum(rank)
    j0 = 0
    while j0 < n:
        limit = (cum[j0 - 1] if j0 else 0) + PAIRS_AT_ONCE
        j1 = max(j0 + 1, int(np.searchsorted(cum, limit, side="right")))
        j1 = min(j1, n)
        js = np.arange(j0, j1)
        counts = rank[j0:j1]
        total = int(counts.sum())
        if total:
            j = np.repeat(js, counts)
            offsets = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
            i = order[np.repeat(first_in_group[j0:j1], counts) + offsets]
            lag = j - i
            by = np.lexsort((j, lag))
            lag, j = lag[by], j[by]
            new = np.r_[True, (lag[1:] != lag[:-1]) | (j[1:] != j[:-1] + 1)]
            seg = np.flatnonzero(new)
            seg_end = np.r_[seg[1:], len(j)] - 1
            s_lag, s_first, s_last = lag[seg], j[seg], j[seg_end]
            s_len = s_last - s_first + 1
            # only diagonals long enough for a run, or touching the block's edges, need a closer look
            edge = (s_first == j0) | ((s_last == j1 - 1) & (j1 < n))
            for k in np.flatnonzero(edge | ((s_len >= s_lag) & (s_len + s_lag >= RUN_WORDS))).tolist():
                d, first, last, m = int(s_lag[k]), int(s_first[k]), int(s_last[k]), int(s_len[k])
                held = carried_len.pop(d, None)
                if held is not None and held[0] == first - 1:
                    m += held[1]
                    first = held[0] - held[1] + 1
                elif held is not None:
                    _emit(found, d, held[0] - held[1] + 1, held[0], held[1])
                if last == j1 - 1 and j1 < n:
                    carried_len[d] = (last, m)
                else:
                    _emit(found, d, first, last, m)
        # diagonals carried from before that did not go on in this block have ended
        for d in [d for d, (last, _) in carried_len.items() if last < j1 - 1]:
            last, m = carried_len.pop(d)
            _emit(found, d, last - m + 1, last, m)
        j0 = j1
    for d, (last, m) in carried_len.items():
        _emit(found, d, last - m + 1, last, m)
    return sorted((s, e - s, d) for (s, e), d in found.items())


def _emit(found: dict, lag: int, first: int, last: int, matches: int) -> None:
    if matches >= lag and matches + lag >= RUN_WORDS:
        key = (first - lag, last + 1)
        if lag < found.get(key, 1 << 62):
            found[key] = lag


def analyse(doc_id, text: str | None) -> dict:
    """Runs of one text (null: no words) after the planted repetition, and the text without repeated periods."""
    words = planted(doc_id, WORD.findall(text or ""))
    if words:
        _, ids = np.unique(np.array(words, dtype=object), return_inverse=True)
        found = runs(ids.astype(np.int64))
    else:
        found = []
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    for s, length, q in found:
        dropped[s + q] += 1
        dropped[s + length] -= 1
    keep = np.cumsum(dropped)[: len(words)] == 0
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return {
        "doc_id": doc_id,
        "n_runs": len(found),
        "start": best[0] if best else None,
        "length": best[1] if best else None,
        "period": best[2] if best else None,
        "exponent_milli": 1000 * best[1] // best[2] if best else None,
        "runs_sha256": hashlib.sha256(listing.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(" ".join(w for w, k in zip(words, keep) if k).encode()).hexdigest(),
    }


SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def detect(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_runs, the longest run (start, length, period, exponent_milli; ties:
    smallest start, then period; none: nulls), runs_sha256 (every run as ``start,length,period`` and a line feed, by
    start then period) and collapsed_sha256 (the kept words joined by one space).

    Whole texts; no shuffle. Null text: no words, no runs, both digests of the empty string. Null doc_id: no planted
    repetition. Repeated rows give repeated results; other columns are not read. Empty table: empty result.
    """
    def run(rows):
        arrow = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                           ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
        for batch in units.batches(rows, "text"):
            out = [analyse(d, t) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
