"""Periodic runs against the definition checked word by word."""

import hashlib
import random

import numpy as np

from conftest import TINY
from llm.cases import AWKWARD, awkward, nothing
from vigil.llm import periodic
from vigil.llm.queries import CATALOGUE


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        k = q
        while k < n:
            if words[k] != words[k - q]:
                k += 1
                continue
            a = k
            while k < n and words[k] == words[k - q]:
                k += 1
            start, end = a - q, k
            if k - a >= q and end - start >= 12:
                smaller = any(all(words[i] == words[i + p] for i in range(start, end - p)) for p in range(1, q))
                if not smaller:
                    out.append((start, end - start, q))
    return sorted(out)


def plain(doc_id, text):
    words = periodic.planted(doc_id, periodic.WORD.findall(text or ""))
    found = plain_runs(words)
    drop = set()
    for s, length, q in found:
        drop.update(range(s + q, s + length))
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    return (len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest())


def test_runs_of_random_sequences_equal_the_definition():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(0, 70)
        alphabet = rng.randint(1, 4)
        words = [str(rng.randrange(alphabet)) for _ in range(n)]
        if rng.random() < 0.5 and n > 10:  # a planted period
            a, p = rng.randrange(n), rng.randint(1, 6)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        ids = np.unique(np.array(words, dtype=object), return_inverse=True)[1].astype(np.int64) if words else np.zeros(0, np.int64)
        assert periodic.runs(ids) == plain_runs(words)


def test_blocks_do_not_change_runs(monkeypatch):
    rng = random.Random(9)
    words = [rng.choice("ab") for _ in range(400)] + ["x", "y", "z"] * 50
    ids = np.unique(np.array(words, dtype=object), return_inverse=True)[1].astype(np.int64)
    whole = periodic.runs(ids)
    monkeypatch.setattr(periodic, "PAIRS_AT_ONCE", 97)
    assert periodic.runs(ids) == whole == plain_runs(words)


def test_whole_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    rows = CATALOGUE["op13_periodic"](spark, TINY).collect()
    assert len(rows) == len(docs)
    planted = 0
    for r in rows:
        assert tuple(r)[1:] == plain(r.doc_id, docs[r.doc_id]) if len(docs[r.doc_id] or "") < 3_000 else True
        planted += r.n_runs > 0
    assert planted > 0


def test_awkward_documents(spark):
    rows = periodic.detect(awkward(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, *tuple(r)[1:]) for r in rows) == sorted(
        (d[0] is None, d[0] or 0, *plain(d[0], d[1])) for d in AWKWARD)
    assert periodic.detect(nothing(spark)).count() == 0
    same = periodic.analyse(1, " ".join(["w"] * 3000))
    assert (same["n_runs"], same["start"], same["length"], same["period"]) == (1, 0, 3000, 1)
