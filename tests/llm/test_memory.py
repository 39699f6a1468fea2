"""Temporary arrays of the text helpers are small beside the text they work on."""

import tracemalloc

import numpy as np
import pyarrow as pa

from vigil.llm import bpe, pieces, tokenids, units, words
from vigil.llm.queries import tokenizer_path


def test_word_hashes_take_little_beside_the_text():
    data = np.frombuffer((b"a" * 999 + b" ") * 4000, dtype=np.uint8)
    starts = np.array([0, len(data)])
    words._powers.cache_clear()
    tracemalloc.start()
    try:
        words.word_hashes(data, starts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        words._powers.cache_clear()
    assert peak < 12 * len(data)


def test_hashes_do_not_depend_on_segments(monkeypatch):
    data = np.frombuffer(b"one two three " * 3000 + b"x" * 5000 + b" end", dtype=np.uint8)
    starts = np.array([0, 7, 20000, len(data)])
    whole = words.word_hashes(data, starts)
    monkeypatch.setattr(words, "SEGMENT", 512)
    cut = words.word_hashes(data, starts)
    assert np.array_equal(whole[0], cut[0]) and np.array_equal(whole[1], cut[1])


def test_a_worker_gives_back_what_earlier_steps_keep():
    made = []

    def build(key):
        made.append(key)
        return [key]

    keep = units.per_worker(build)
    try:
        assert keep(1) is keep(1) and made == [1]
        units.forget()
        assert keep(1) == [1] and made == [1, 1]
    finally:
        units._PER_WORKER.remove(keep)
    assert {bpe.encoder, tokenids.library_units, pieces.model} <= set(units._PER_WORKER)


def digested(texts):
    """What a worker keeps, and holds at most, while it digests ``texts``; the encoder is there before."""
    class Rows:
        dtypes = [("doc_id", "bigint"), ("text", "string")]
        select = lambda self, *names: self
        mapInArrow = lambda self, run, schema: run

    run = bpe.digest(Rows(), tokenizer_path())
    batch = lambda x: pa.record_batch([pa.array(range(len(x))), pa.array(x)], ["doc_id", "text"])
    units.forget()
    list(run(iter([batch(["first"])])))
    rows = batch(texts)
    tracemalloc.start()
    try:
        list(run(iter([rows])))
        return tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
        units.forget()


def test_a_worker_that_digests_tokens_takes_little():
    texts = [" ".join(f"{chr(97 + k % 26)}q{k * 1000 + i}" for i in range(1000)) for k in range(250)]
    kept, peak = digested(texts)
    assert kept < 30e6 and peak < 130e6


def test_memory_goes_back_before_a_worker_builds(monkeypatch):
    calls = []
    monkeypatch.setattr(units, "release", lambda: calls.append("release"))
    keep = units.per_worker(lambda key: calls.append("build"))
    try:
        keep(1)
        keep(1)
    finally:
        units._PER_WORKER.remove(keep)
    assert calls == ["release", "build"]


def test_long_units_fill_a_lookup_by_their_ids():
    known = units.Known(lambda texts: [list(t) for t in texts], most=100)
    for k in range(50):
        data, begins, ends, firsts = units.split(pa.array([chr(97 + k % 26) * 500 + str(k)]))
        at = known.places(data, begins, ends)
        assert known.ids[known.begins[at[0]]:][:known.lengths[at[0]]].tolist() == data.tolist()
        assert len(known.ids) <= units.IDS_A_UNIT * 100 + 502
