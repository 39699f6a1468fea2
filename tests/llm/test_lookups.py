"""Tables that make encoding and decoding cheaper give what the plain way gives."""

import random

import numpy as np
import public_tokenizers
import sentencepiece

from vigil.llm import pieces, tokenids, units

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_ids_say_what_the_library_decodes():
    own, sp, draw = pieces.model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH), random.Random(5)
    assert len(own.spoken) == own.size and {i for i, t in enumerate(own.spoken) if t is None} == set(own.bytes_of)
    plain = sorted(own.id_of.values())
    for _ in range(300):
        ids = [draw.choice(plain) for _ in range(draw.randrange(9))]
        assert own.decode(ids) == sp.decode(ids)
    for text in ("", " a", "naïve 東京 \t€", "\u0000x", "  two  spaces "):
        ids = own.encode(text)
        assert ids == sp.encode(text) and own.decode(ids) == sp.decode(ids)


def test_units_stay_in_order_as_new_ones_come():
    known = units.Known(lambda texts: [list(t) for t in texts], most=50)
    draw = random.Random(2)
    for _ in range(12):
        words = [bytes(draw.choices(b"abc", k=draw.randrange(1, 5))) for _ in range(30)]
        ends = np.cumsum([len(w) for w in words])
        begins = ends - [len(w) for w in words]
        at = known.places(np.frombuffer(b"".join(words), dtype=np.uint8), begins, ends)
        assert (np.diff(known.keys.astype(object)) > 0).all()
        assert [known.ids[known.begins[i]:known.begins[i] + known.lengths[i]].tolist() for i in at] == [list(w) for w in words]


def test_units_come_joined_before_the_tokenizer_with_the_same_ids():
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, draw = Tokenizer.from_file(path), random.Random(3)
    marks = [" ", "  ", "\n", "\t ", "\u00a0", "\u2028", "é", "東", "x", "don't", "12", "<|endoftext|>", "?!", "\u0000", "\x1c", "naïve", "a b"]
    texts = ["", " ", "one two", *("".join(draw.choices(marks, k=draw.randrange(1, 30))) for _ in range(3000))]
    known, asked = tokenids.Joined(tokenids.library_units(path).encode, tokenids.library_units(path).size), []
    encode = known.encode
    known.encode = lambda parts: asked.append(len(parts)) or encode(parts)
    data, begins, ends, firsts = units.split(pa.array(texts))
    at = known.places(data, begins, ends)
    ids = units.ragged(known.ids, known.begins[at], known.lengths[at])
    stops = np.append(0, np.cumsum(known.lengths[at]))[firsts]
    want = plain.encode_batch(texts, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(stops, stops[1:])] == [x.ids for x in want]
    letters = [f" {a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefghi"]
    asked.clear()
    data, begins, ends, _ = units.split(pa.array(["".join(letters)]))
    known.places(data, begins, ends)
    assert sum(asked) < 5 < len(begins)
    # ids that do not cover their bytes are not cut: such units come one by one
    odd = tokenids.Joined(encode, known.size * 0 + 1)
    at = odd.places(data, begins, ends)
    one = [x.ids for x in plain.encode_batch(letters, add_special_tokens=False)]
    assert [odd.ids[odd.begins[i]:odd.begins[i] + odd.lengths[i]].tolist() for i in at] == one
