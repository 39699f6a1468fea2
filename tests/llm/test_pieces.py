"""SentencePiece encoding by the prefix table against the library and the model's plain merge rule."""

import hashlib
import tracemalloc

import pyarrow as pa
import pytest

from conftest import TINY
from llm.cases import AWKWARD, LONG, awkward, nothing
from vigil.llm import pieces
from vigil.llm.queries import CATALOGUE, piece_model_path

EDGES = ["", " ", "  x", "a\tb", "😀 x  ", "▁▁a", "   ", "x" * 50, " " * 40 + "word", "ab́c", "\x00", "ab c", " \t ",
         "Hello  world\t x\n\nyé 😀 ", "<s> </s> <unk>", "中文 ßtraße", LONG]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


def expected(library, text):
    ids = library.encode(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_prefix_table_equals_the_library(library):
    model = pieces.model(piece_model_path())
    for text in EDGES:
        assert model.encode(text) == library.encode(text)
        assert model.decode(model.encode(text)) == library.decode(library.encode(text))


def test_prefix_table_equals_the_plain_merge_rule():
    model = pieces.model(piece_model_path())
    for word in ["▁the", "▁unbelievably", "▁▁▁▁▁▁▁x", "▁Straße", "▁aaaaaaaaaaaa", "▁internationalisation"]:
        assert model.segment(word) == model.merged(word)


def test_whole_documents(spark, library):
    rows = CATALOGUE["op11_pieces"](spark, TINY).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(library, texts[r.doc_id])


def test_awkward_documents(spark, library):
    rows = pieces.digest(awkward(spark), piece_model_path()).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == sorted(
        (d[0] is None, d[0] or 0, *expected(library, d[1])) for d in AWKWARD)
    assert pieces.digest(nothing(spark), piece_model_path()).count() == 0


def test_round_trip_of_ids(spark, library):
    encoded = pieces.encode_texts(awkward(spark), piece_model_path())
    back = {(r.doc_id, r.text) for r in pieces.decode_ids(encoded, piece_model_path()).collect()}
    assert back == {(d[0], library.decode(library.encode(d[1] or ""))) for d in AWKWARD}


def test_units_of_a_batch_equal_the_library(library):
    texts = [*EDGES, None, "a ▁ b", "▁ a ▁", "x  ▁▁ y", "tail ", "one\ntwo\x00 three", "\n", " \n ", "é😀\n ", "\ue000 a\ue000b", "same words same words"]
    model = pieces.Model(piece_model_path())
    for column in (pa.array(texts), pa.array(["cut off", *texts]).slice(1)):
        ids, stops = model.ids_of(column)
        assert [ids[a:b].tolist() for a, b in zip(stops, stops[1:])] == [library.encode(t or "") for t in texts]


def test_remembered_words_take_little_memory():
    model = pieces.Model(piece_model_path())
    model.ids_of(pa.array(["word"]))
    words = 40_000
    tracemalloc.start()
    try:
        model.ids_of(pa.array([" ".join(f"w{i}" for i in range(words))]))
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert kept < 150 * words
