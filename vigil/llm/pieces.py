"""SentencePiece BPE encoding and decoding with a merge-type prefix table.

A text is normalised as the model says (a leading ``▁`` and every space as ``▁``) and cut into segments: a run of ``▁``
and the other characters after it, up to the next ``▁`` or a character that no piece holds. No piece of the model reaches
over such a cut (only pieces made of ``▁`` alone hold a ``▁`` after their start), so segments are encoded on their own.

For each prefix of a segment the table stores the last token of its encoding. Candidates are the pieces that end there,
found by an Aho-Corasick automaton of all pieces; the last token is the candidate ``t`` whose start either begins the
segment (and ``t`` encodes to itself) or whose predecessor, the last token stored for the prefix before ``t``, is
compatible with ``t``: the pair's text encodes to exactly those two tokens. Pair tests are answered by the model's own
merge rule (highest score first, leftmost on ties) on the short text of two pieces and remembered. The ids are read
backwards from the end of the segment. Characters no piece holds become their UTF-8 bytes (byte fallback). A worker
remembers ids by units: a run of spaces and what follows it, which is one segment or a few.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from vigil.llm import units, words

SPACE = "▁"
MOST_SEGMENTS, MOST_PAIRS = 1_000_000, 1_000_000  # units and pair tests a worker remembers before it starts anew


class Model:
    """Pieces, scores and kinds of a SentencePiece BPE model file, read through the library's processor."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.piece = [sp.id_to_piece(i) for i in range(self.size)]
        self.byte_id = {}
        self.id_of, self.score = {}, {}
        self.unknown = next(i for i in range(self.size) if sp.is_unknown(i))
        for i, p in enumerate(self.piece):
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.id_of[p] = i
                self.score[p] = sp.get_score(i)
        self.bytes_of = {i: bytes([b]) for b, i in self.byte_id.items()}
        self.chars = {c for p in self.id_of for c in p if c in self.id_of}
        #: What each id says: None for a byte, nothing for a control id.
        self.spoken = [
            None if i in self.bytes_of else " ⁇ " if i == self.unknown else p.replace(SPACE, " ") if p in self.id_of else ""
            for i, p in enumerate(self.piece)
        ]
        known = "".join(regex.escape(c) for c in sorted(self.chars - {SPACE}))
        self.cut = regex.compile(f"({SPACE}*[{known}]+|{SPACE}+)|(.)", regex.DOTALL)
        #: Bytes that are a character no piece holds.
        self.cut_byte = np.array([c < 128 and chr(c) not in self.chars and c != 0x20 for c in range(256)])
        self.whole = {i for p, i in self.id_of.items() if self.merged(p) == [i]}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.length = [len(p) for p in self.piece]
        self.known = units.Units(self.unit_ids, MOST_SEGMENTS)
        #: For each id: its digits, and the bytes it says.
        self.digits = pa.array([str(i).encode() for i in range(self.size)], pa.large_binary())
        self.said = pa.array([self.bytes_of[i] if x is None else x.encode() for i, x in enumerate(self.spoken)], pa.large_binary())

    def merged(self, text: str) -> list[int]:
        """The model's own rule on a short text of known characters: merge the adjacent pair whose joined piece scores
        highest, the leftmost of equal ones, until no joined pair is a piece. Used for pair tests and as brute force."""
        score, low = self.score, float("-inf")
        symbols = list(text)
        scores = [score.get(symbols[k] + symbols[k + 1], low) for k in range(len(symbols) - 1)]
        while scores:
            best = max(scores)
            if best == low:
                break
            at = scores.index(best)
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
            del scores[at]
            if at > 0:
                scores[at - 1] = score.get(symbols[at - 1] + symbols[at], low)
            if at < len(scores):
                scores[at] = score.get(symbols[at] + symbols[at + 1], low)
        return [self.id_of[s] for s in symbols]

    def compatible(self, a: int, b: int) -> bool:
        key = a << 16 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(self.piece[a] + self.piece[b]) == [a, b]
        return known

    def segment(self, text: str) -> list[int]:
        """Ids of one segment of known characters by the prefix table, read backwards.

        The automaton reports the pieces that end at each place in ascending order of places, the longest first; the
        first candidate that fits is the last token of that prefix and the others there are passed over."""
        whole = self.id_of.get(text)
        if whole in self.whole:
            return [whole]
        n, pairs, single, compatible = len(text), self.pairs, self.whole, self.compatible
        last = [-1] * (n + 1)
        done = -1
        for end, (length, i) in self.automaton.iter(text):
            if end == done:
                continue
            start = end + 1 - length
            if start:
                before = last[start]
                fits = pairs.get(before << 16 | i)
                if fits is None:
                    fits = compatible(before, i)
            else:
                fits = i in single
            if fits:
                last[end + 1] = i
                done = end
        ids, at = [], n
        while at > 0:
            i = last[at]
            ids.append(i)
            at -= self.length[i]
        return ids[::-1]

    def unit_ids(self, found: list[bytes]) -> list[bytes]:
        """The ids of each unit (its spaces are ``▁``), as the bytes of 32-bit numbers."""
        out = []
        for unit in found:
            text = str(unit, "utf-8").replace(" ", SPACE)
            out.append(np.array(self.segment(text) if self.chars.issuperset(text) else self.segments(text), np.int32).tobytes())
        return out

    def segments(self, text: str) -> list[int]:
        """Ids of a normalised text, segment by segment; a character no piece holds gives its bytes."""
        ids: list[int] = []
        for m in self.cut.finditer(text):
            if m.group(1):
                ids.extend(self.segment(m.group(1)))
            else:
                ids.extend(self.byte_id[b] for b in m.group(2).encode("utf-8"))
        return ids

    def split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, begins, ends, firsts): units of all texts in order, with the leading space; text i has units
        firsts[i]:firsts[i + 1]. A unit is a run of spaces and the bytes up to the next one, or a character of one byte
        that no piece holds. A text that holds ``▁`` itself is one unit."""
        plain = pc.fill_null(texts.cast(pa.large_string()), "")
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), plain, pa.scalar("", pa.large_string()))
        whole = pc.match_substring(plain, SPACE)
        data, starts = words.text_bytes(pc.if_else(pc.equal(plain, ""), plain, spaced))
        if not len(data):
            return data, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(starts), np.int64)
        space, odd = data == 0x20, self.cut_byte[data]
        begin = odd.copy()
        begin[1:] |= (space[1:] & ~space[:-1]) | odd[:-1]
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)):
            begin[starts[i]:starts[i + 1]] = False
        begin[starts[:-1][np.diff(starts) > 0]] = True
        begins = np.flatnonzero(begin)
        return data, begins, np.append(begins[1:], len(data)), np.searchsorted(begins, starts)

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, stops): text i has ids[stops[i]:stops[i + 1]]; a null or empty one has none."""
        data, begins, ends, firsts = self.split(texts)
        at = self.known.places(data, begins, ends)
        lengths = self.known.lengths[at]
        return units.ragged(self.known.ids, self.known.begins[at], lengths), np.append(0, np.cumsum(lengths))[firsts]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text; None and the empty text have none."""
        if not text:
            return []
        return self.segments(SPACE + text.replace(" ", SPACE))

    def decode(self, ids, first: bool = True) -> str:
        """The text of ids: pieces with ``▁`` as space, runs of byte pieces as UTF-8 (each bad byte one U+FFFD), the
        leading space of the first piece dropped; control ids give nothing, the unknown id gives U+2047."""
        out = [self.spoken[i] for i in ids]
        if first and len(ids) and ids[0] != self.unknown and out[0] and out[0].startswith(" "):
            out[0] = out[0][1:]
        if None not in out:
            return "".join(out)
        said, run = [], bytearray()
        for i, text in zip(ids, out):
            if text is None:
                run += self.bytes_of[i]
                continue
            if run:
                said.append(_bytes_text(bytes(run)))
                run = bytearray()
            said.append(text)
        if run:
            said.append(_bytes_text(bytes(run)))
        return "".join(said)


def _bytes_text(data: bytes) -> str:
    """UTF-8 of byte pieces where every byte outside a whole character stands for one U+FFFD, as the library decodes."""
    out, k = [], 0
    while k < len(data):
        for width in (1, 2, 3, 4):
            try:
                out.append(data[k:k + width].decode("utf-8"))
                k += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k += 1
    return "".join(out)


@units.per_worker
def model(path: str) -> Model:
    return Model(path)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text: (``id_col``, token_ids array<int>); a null text has none. No shuffle."""
    def run(rows):
        own = model(path)
        for batch in units.batches(rows, text_col):
            ids, stops = own.ids_of(batch.column(1))
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids, pa.int32()))], [id_col, "token_ids"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, token_ids array<int>")


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """The inverse of ``encode_texts``: (``id_col``, text)."""
    def run(rows):
        own = model(path)
        for batch in rows:
            texts = [own.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    kind = dict(encoded.dtypes)[id_col]
    return encoded.select(id_col, "token_ids").mapInArrow(run, f"`{id_col}` {kind}, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256 of its ids and their decoding.

    Whole texts; no shuffle; a worker holds a batch of about 4 MB of text (or one longer text) and the ids of at most
    1,000,000 units. Null text counts as empty: no ids, and both digests are those of the empty string. Null or
    repeated doc_id: one result row per input row, in the same way. Other columns are not read, so clashing names do not
    matter. Empty table: empty result.
    """
    def run(rows):
        own = model(path)
        for batch in units.batches(rows, "text"):
            ids, stops = own.ids_of(batch.column(1))
            id_digests = [hashlib.sha256(x).hexdigest() for x in units.joined(own.digits, ids, stops, b",")]
            text_digests = []
            for a, b, said in zip(stops.tolist(), stops[1:].tolist(), units.joined(own.said, ids, stops, b"")):
                try:
                    text = str(said, "utf-8")
                    text = text[1:] if a < b and ids[a] != own.unknown and text.startswith(" ") else text
                except UnicodeDecodeError:  # bytes that are no character
                    text = own.decode(ids[a:b].tolist())
                text_digests.append(hashlib.sha256(text.encode()).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(np.diff(stops), pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
