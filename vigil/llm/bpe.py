"""Byte-level BPE encoding and decoding with an index of pair occurrences.

The distinct pieces of a batch form one array of symbols. The index maps each pair that has a rank to all its positions.
The ranks that occur are applied in ascending order: all positions of a rank are merged at once, and the positions of
the pairs that a merge makes are added to the lists of their ranks.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from vigil.llm import units

#: Fixed value: the published split pattern of the byte-level vocabulary. White space is the Unicode property.
PATTERN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
MOST_PIECES, MOST_UNITS = 100_000, 750_000  # pieces and units a worker remembers before it starts anew
DIGEST_BYTES = 1 << 20  # of text that a worker digests at a time


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, as letter to byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ranks, ids and bytes of a byte-level BPE vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items()}
        self.bytes_of |= {i: token.encode() for token, i in self.special.items()}
        self.of_byte = np.zeros(256, dtype=np.int64)
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        codes = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.rank_of_code = codes[order], order.astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 for pairs without one."""
        code = left << 32 | right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.rank_of_code[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as the bytes of 32-bit numbers."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        symbol = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        n = len(symbol)
        if not n:
            return [b"" for _ in pieces]
        ends = np.cumsum(lengths)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends[lengths > 0] - 1] = -1
        before[(ends - lengths)[lengths > 0]] = -1
        alive = np.ones(n, dtype=bool)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(positions: np.ndarray) -> None:
            rank = self.ranks(symbol[positions], symbol[after[positions]])
            positions, rank = positions[rank >= 0], rank[rank >= 0]
            order = np.argsort(rank, kind="stable")
            positions, rank = positions[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, group in zip(rank[np.append(0, cuts)].tolist() if len(rank) else [], np.split(positions, cuts)):
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(group)

        add(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            lists = index.pop(rank)
            p = np.unique(np.concatenate(lists)) if len(lists) > 1 else np.sort(lists[0])
            p = p[alive[p] & (symbol[p] == self.left[rank]) & (after[p] >= 0)]
            p = p[symbol[after[p]] == self.right[rank]]
            if self.left[rank] == self.right[rank] and len(p) > 1:
                # a run of equal symbols pairs off from its left end
                p = p[_alternate(p, after)]
            if not len(p):
                continue
            gone = after[p]
            symbol[p], alive[gone] = self.made[rank], False
            after[p] = after[gone]
            following = p[after[p] >= 0]
            before[after[following]] = following
            leading = before[p][before[p] >= 0]
            add(np.unique(np.concatenate([leading, following])))
        kept = np.add.reduceat(alive, (ends - lengths)[lengths > 0], dtype=np.int64)
        counts = np.zeros(len(pieces), dtype=np.int64)
        counts[lengths > 0] = kept
        ids = symbol[alive].astype(np.int32).tobytes()
        stops = (4 * np.cumsum(counts)).tolist()
        return [ids[a:b] for a, b in zip([0, *stops], stops)]


def _alternate(p: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of positions in order, every second one of each chain in which a position is followed by the next."""
    chained = np.append(False, after[p[:-1]] == p[1:])
    start = np.flatnonzero(~chained)
    return (np.arange(len(p)) - np.repeat(start, np.diff(np.append(start, len(p))))) % 2 == 0


class Encoder:
    """Encodes units: special tokens, then pieces by the split pattern, then merges of the pieces not met before."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.special = {token: np.int32(i).tobytes() for token, i in self.vocabulary.special.items()}
        self.pieces: dict[str, bytes] = dict(self.special)
        self.known = units.Units(self.encode, MOST_UNITS)
        most = max(self.vocabulary.bytes_of) + 1
        self.written = pa.array([str(i).encode() for i in range(most)], pa.large_binary())
        self.spoken = pa.array([self.vocabulary.bytes_of.get(i, b"") for i in range(most)], pa.large_binary())

    def encode(self, texts: list[bytes]) -> list[bytes]:
        special = self.special
        split = []
        for text in texts:
            text = text.decode("utf-8")
            if special:
                found = []
                for part in self.vocabulary.special_pattern.split(text):
                    found += [part] if part in special else PATTERN.findall(part)
            else:
                found = PATTERN.findall(text)
            split.append(tuple(found))
        if len(self.pieces) > MOST_PIECES:
            self.pieces = dict(self.special)
        new = list({p for found in split for p in found} - self.pieces.keys())
        self.pieces.update(zip(new, self.vocabulary.merge([p.encode("utf-8") for p in new])))
        ids = self.pieces
        return [b"".join([ids[p] for p in found]) for found in split]


@units.per_worker
def encoder(path: str) -> Encoder:
    return Encoder(path)


def decode(ids, bytes_of: dict[int, bytes]) -> str:
    """The text of token ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join([bytes_of[i] for i in ids]).decode("utf-8", "replace")


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every text: (``id_col``, token_ids array<int>). Null text: no ids. ``path`` is there on every node."""
    def run(rows):
        known = encoder(path).known
        for batch in units.batches(rows, text_col):
            data, begins, ends, firsts = units.split(batch.column(1))
            at = known.places(data, begins, ends)
            lengths = known.lengths[at]
            ids = units.ragged(known.ids, known.begins[at], lengths)
            stops = np.append(0, np.cumsum(lengths))[firsts]
            yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids, pa.int32()))], [id_col, "token_ids"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, token_ids array<int>")


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """The inverse of ``encode_texts``: (``id_col``, text)."""
    def run(rows):
        bytes_of = encoder(path).vocabulary.bytes_of
        for batch in rows:
            texts = [decode(ids or [], bytes_of) for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], [id_col, "text"])

    kind = dict(encoded.dtypes)[id_col]
    return encoded.select(id_col, "token_ids").mapInArrow(run, f"`{id_col}` {kind}, text string")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256, from its ids and their decoding.

    No shuffle; memory is bounded by a few MB of text or the longest text. A null text counts as empty: no ids, and the
    digests are those of the empty string. Repeated rows give repeated results; other columns are not read.
    """
    def run(rows):
        own = encoder(path)
        known = own.known
        for batch in units.batches(rows, "text", DIGEST_BYTES):
            data, begins, ends, firsts = units.split(batch.column(1))
            at = known.places(data, begins, ends)
            lengths = known.lengths[at]
            ids = units.ragged(known.ids, known.begins[at], lengths)
            stops = np.append(0, np.cumsum(lengths))[firsts]
            id_digests = [hashlib.sha256(x).hexdigest() for x in units.joined(own.written, ids, stops, b",")]
            texts = units.joined(own.spoken, ids, stops, b"")
            text_digests = [hashlib.sha256(str(x, "utf-8", "replace").encode()).hexdigest() for x in texts]
            yield pa.record_batch(
                [batch.column(0), pa.array(np.diff(stops), pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
