"""Language ID, Jaccard join, fingerprints, BPE and token files against plain versions."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import TINY
from llm.cases import AWKWARD, awkward, jaccard_components, nothing
from vigil.llm import bpe, jaccard, langid, simhash, tokenids
from vigil.llm.queries import CATALOGUE, tokenizer_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text", "lang").toPandas().set_index("doc_id")


def test_language_of_held_out_documents(spark, documents):
    rows = CATALOGUE["op1_langid"](spark, TINY).collect()
    assert len(rows) == len(documents)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == documents.lang[r.doc_id] for r in held) >= 0.9 * len(held)


def test_language_of_awkward_documents(spark):
    found = {(r.doc_id, r.lang_pred) for r in langid.identify(awkward(spark)).collect()}
    assert {i for i, lang in found if lang == "und"} == {1, 2, 3, 7, 13}
    assert langid.identify(nothing(spark)).count() == 0
    unlabelled = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


@pytest.mark.parametrize("doc_id", ["NULL", "8"])
def test_tied_ids_keep_every_language(spark, doc_id):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").selectExpr(f"CAST({doc_id} AS BIGINT) AS doc_id", "text", "lang")
    langs = {r.lang for r in docs.filter("lang IS NOT NULL AND text RLIKE '\\\\p{L}'").select("lang").distinct().collect()}
    assert set(langid.fit(docs).classes) == langs


def test_training_repeats_itself():
    rng = np.random.default_rng(1)
    windows, labels = rng.integers(97, 123, (64, langid.WINDOW)).astype(np.uint8), np.arange(64) % 2
    windows[labels == 1, ::2] = 50
    nets = [langid.Network(["a", "b"]) for _ in range(2)]
    for net in nets:
        net.train(windows, labels, np.ones(64, dtype=np.float32))
    assert (nets[0].probabilities(windows) == nets[1].probabilities(windows)).all()
    assert (nets[0].probabilities(windows).argmax(1) == labels).all()


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_jaccard_components(spark, documents, size, percent):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs, size, percent).collect()}
    assert got == jaccard_components(documents.text.to_dict(), size, percent)


def test_jaccard_near_the_threshold(spark):
    """Families of texts that differ by a few words, so that many pairs lie just above or below."""
    rng = np.random.default_rng(3)
    texts = {}
    for family in range(4):
        base = [f"w{family}x{i}" for i in range(60 + 40 * family)]
        for k in range(40):
            words = list(base)
            for place in rng.integers(0, len(words), rng.integers(0, 5)):
                words[place] = f"n{k}x{place}"
            texts[100 * family + k] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs, 4, 85).collect()}
    assert got == jaccard_components(texts, 4, 85)


def test_jaccard_of_awkward_documents(spark):
    rows = jaccard.join(awkward(spark), 5, 80).collect()
    assert len(rows) == len(AWKWARD)
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert of[1] == [(0, 1)] and of[2] == [(0, 2)] and of[3] == [(0, 3)]
    assert [c for _, c in of[4] + of[5] + of[None]] == [4] * 4  # upper case is folded; the row without id joins them
    assert of[9] == [(1, 9)] and of[10] == [(1, 9)]
    assert jaccard.join(nothing(spark), 5, 80).count() == 0


def test_jaccard_links_rows_without_id(spark):
    """Near copies, not exact ones, among rows without doc_id, and of one such row with an identified document."""
    base = {c: [f"{c}{i}" for i in range(60)] for c in "abc"}
    near = {c: " ".join([*w, "more"]) for c, w in base.items()}
    whole = {c: " ".join(w) for c, w in base.items()}
    rows = [(None, whole["a"]), (None, near["a"]), (None, near["a"]), (7, whole["b"]), (None, near["b"]), (None, whole["c"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = jaccard.join(docs, 5, 80, groups=True).collect()
    assert sorted((r.n_shingles, r.component_id or 0) for r in found) == [(56, 0), (56, 0), (56, 7), (57, 0), (57, 0), (57, 7)]
    assert sorted(Counter(r.group for r in found).values()) == [1, 2, 3]


def test_blocks_of_linked_sets_meet():
    """Every pair of sets at the threshold shares a block key, whatever tokens are changed."""
    rng = np.random.default_rng(0)
    for n in [6, 7, 11, 40, 63, 64, 65, 200, 511, 700]:
        for _ in range(20):
            s = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            t = s.copy()
            k = jaccard.difference(n, 85)
            drop = int(rng.integers(0, k + 1))
            t = np.delete(t, rng.choice(len(t), drop, replace=False))
            fresh = rng.integers(0, 1 << 63, k - drop, dtype=np.uint64)
            t = np.unique(np.append(t, fresh))
            inter = len(np.intersect1d(s, t))
            if 100 * inter >= 85 * (len(s) + len(t) - inter) and inter < len(s):
                assert np.intersect1d(jaccard.block_keys(s, 85), jaccard.block_keys(t, 85)).size, n
                assert np.bitwise_count((jaccard.parity(s) ^ jaccard.parity(t)).view(np.uint64)).sum() <= len(s) + len(t) - 2 * inter


def test_fingerprints_of_edited_texts(spark, documents):
    rows = {r.doc_id: r for r in CATALOGUE["op6_simhash"](spark, TINY).collect()}
    ids = sorted(documents.index)
    own = simhash.fingerprints([documents.text[i] for i in ids])
    for k, i in enumerate(ids):
        text, after = documents.text[i], (k + 1) % len(ids)
        changed = simhash.edited(text, documents.text[ids[after]])
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert r.fingerprint == own[k].tobytes().hex() and r.near_next == pytest.approx(simhash.likeness(own[k], own[after]))
    assert np.mean([r.near_edited > r.near_next for r in rows.values()]) > 0.97


def test_fingerprints_of_awkward_documents(spark):
    rows = simhash.digest(awkward(spark)).collect()
    assert len(rows) == len(AWKWARD)
    same = {r.fingerprint for r in rows if r.doc_id in (4, None)}
    assert len(same) == 1 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    alone = simhash.compare(awkward(spark).filter("doc_id = 9")).collect()
    assert alone[0].near_next == 1.0 and alone[0].n_chars == 3
    assert simhash.digest(nothing(spark)).count() == 0


@pytest.mark.parametrize("radius,agreeing", [(3, 1), (5, 2)])
def test_all_fingerprints_within_the_radius(spark, radius, agreeing):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 256, (40, 16), dtype=np.uint8)
    prints = [b.tobytes() for b in base]
    for k in range(400):
        bits = np.unpackbits(base[k % 4 if k < 200 else k % 40])
        bits[rng.choice(128, rng.integers(0, 7), replace=False)] ^= 1
        prints.append(np.packbits(bits).tobytes())
    table = spark.createDataFrame([(p.hex(), i) for i, p in enumerate(prints)], "fingerprint string, doc_id long").repartition(4)
    raw = np.frombuffer(b"".join(prints), dtype=np.uint8).reshape(len(prints), 16)
    apart = np.bitwise_count(raw[:, None] ^ raw[None]).sum(-1)
    for r in simhash.near(table, radius, agreeing).collect():
        near = np.flatnonzero(apart[prints.index(bytes.fromhex(r.fingerprint))] <= radius)
        assert r.first_near == near.min()
        assert r.n_near == len({prints[i].hex() for i in near} - {r.fingerprint})


def test_tokens_and_files_equal_the_library(spark, documents, library):
    texts = {i: t or "" for i, t in documents.text.items()}
    encoded = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    for r in CATALOGUE["op7_bpe"](spark, TINY).collect():
        ids = encoded[r.doc_id]
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    start = 0
    for r in CATALOGUE["op8_tokenids"](spark, TINY).orderBy("doc_id").collect():
        ids = np.array([*encoded[r.doc_id], 0], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_tokens_of_awkward_documents(spark, library, tmp_path):
    docs = awkward(spark)
    encoded = bpe.encode_texts(docs, tokenizer_path())
    for r in encoded.join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        assert r.token_ids == library.encode(r.text or "", add_special_tokens=False).ids
    back = {r.doc_id: r.text for r in bpe.decode_ids(encoded, tokenizer_path()).collect()}
    assert all(back[r[0]] == (r[1] or "") for r in AWKWARD)
    files = spark.read.parquet(tokenids.write(docs, tokenizer_path(), str(tmp_path / "ids")))
    rows = tokenids.read(files).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((r[0] for r in AWKWARD), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in rows] == np.cumsum([0, *(len(r.token_ids) for r in rows)])[:-1].tolist()
    for empty in (bpe.digest(nothing(spark), tokenizer_path()), tokenids.digest(nothing(spark), tokenizer_path())):
        assert empty.count() == 0


def test_texts_with_odd_white_space_equal_the_library(library):
    import pyarrow as pa

    from vigil.llm import units

    rng = np.random.default_rng(5)
    parts = list("aab  \n\t'slvetre.,!?0123　\u0085\x1c\x1d\x0b\x0céßñ中🙂 ") + ["<|endoftext|>", " <|endoftext|>", "'ll", " the"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(3000)] + ["", "a" * 50, " " * 50]
    known = bpe.Encoder(tokenizer_path()).known
    data, begins, ends, firsts = units.split(pa.array(texts))
    at = known.places(data, begins, ends)
    ids = units.ragged(known.ids, known.begins[at], known.lengths[at])
    stops = np.append(0, np.cumsum(known.lengths[at]))[firsts]
    for i, x in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[stops[i]:stops[i + 1]].tolist() == x.ids, texts[i]


@pytest.mark.parametrize("high", [2, 1000, 50257, 1 << 31, 1 << 60, (1 << 64) - 1])
def test_word_aligned_codes_round_trip(high):
    rng = np.random.default_rng(high % 97)
    for n in (0, 1, 59, 60, 61, tokenids.BLOCK - 1, tokenids.BLOCK, tokenids.BLOCK + 1, 20_000):
        values = rng.integers(0, high, n, dtype=np.uint64)
        if high > 1 << 40:
            values[rng.random(n) < 0.7] %= np.uint64(5000)
        packed, before = tokenids.pack(values)
        assert (tokenids.unpack(packed, before.astype(np.int64), n) == values).all()
