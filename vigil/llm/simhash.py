"""Document fingerprints: SimHash over weighted terms, and permuted block tables to find near fingerprints.

Terms are runs of two words (a single word is its own term), weighted by 1 + log2 of how often they occur. Every term's
hash votes on each of the 128 bits with its weight; a bit is set when the votes for it are more than half.

To find all fingerprints within a Hamming radius r, the bits are cut into r + s blocks. Two fingerprints within the radius
agree in s blocks at least. There is a table for every choice of s blocks, in which the chosen blocks stand in front;
equal fronts are compared exactly. Equal fingerprints are one entry; fronts that many share are compared in cells.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm import units, words
from vigil.llm.cells import each_cell, in_cells, sides
from vigil.session import written

BITS = 128
BATCH_BYTES = 1 << 19  # text that a task holds in Python at a time, with its edited form and hashes
RADIUS, AGREEING = 3, 1  # four tables of 32-bit fronts
_SALTS = words.numbers(2, 5)


def fingerprints(texts: list[str]) -> np.ndarray:
    """The fingerprint of each text: rows of 16 bytes. A text without words has no bit set."""
    data, starts = words.text_bytes(pa.array(texts, pa.string()))
    found, first = words.word_hashes(data, starts)
    out = np.zeros((len(texts), BITS // 8), dtype=np.uint8)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
        if a < b:
            term, count = np.unique(words.shingle_hashes(found[a:b], 2), return_counts=True)
            weight = 1 + np.log2(count).astype(np.float32)
            votes = np.zeros(BITS, dtype=np.float32)
            for k in range(0, len(term), 8192):  # whole texts, in pieces
                hashes = np.stack([words.mixed(term[k:k + 8192] ^ s) for s in _SALTS], axis=1)
                bits = np.unpackbits(hashes.view(np.uint8).reshape(len(hashes), -1), axis=1)
                votes += weight[k:k + 8192] @ bits
            out[i] = np.packbits(votes * 2 > weight.sum())
    return out


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which rows of 16 bytes differ."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of the term weights that the fingerprints tell: 1 for equal ones, 0 from half the bits on."""
    return np.clip(np.cos(np.pi * distance(a, b) / BITS), 0, 1)


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by the first as many, or all, of the following one."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def _rows(ids: pa.Array, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> list[pa.Array]:
    changed = [edited(t, f) for t, f in zip(texts, following)]
    of_changed = fingerprints(changed)
    return [
        ids, pa.array(list(map(len, texts)), pa.int64()),
        pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
        pa.array([r.tobytes().hex() for r in own], pa.string()), pa.array([r.tobytes().hex() for r in of_changed], pa.string()),
        pa.array(likeness(own, of_changed)), pa.array(likeness(own, after)),
    ]


FIELDS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _ordered(rows):
    """Results of all rows of a sorted range part but its last; the first and last rows with their texts."""
    part, carried, head = TaskContext.get().partitionId(), None, True

    def edge(kind, ids, text):
        blank = [pa.nulls(1, t) for t in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
        return pa.record_batch([pa.array([part], pa.int32()), pa.array([kind], pa.int32()), pa.array([text], pa.string()), ids, *blank], ["part", "kind", "text", *NAMES])

    for batch in units.batches(rows, "text", BATCH_BYTES):
        ids, texts = batch.column(0), batch.column(1).fill_null("").to_pylist()
        own = fingerprints(texts)
        if head:
            yield edge(1, ids.slice(0, 1), texts[0])
            head = False
        if carried is not None:
            ids = pa.concat_arrays([carried[0], ids])
            texts, own = [carried[1], *texts], np.concatenate([carried[2], own])
        n = len(texts) - 1
        carried = (ids.slice(n), texts[n], own[n:])
        if n:
            done = _rows(ids.slice(0, n), texts[:-1], texts[1:], own[:-1], own[1:])
            yield pa.record_batch([pa.array([part] * n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), *done], ["part", "kind", "text", *NAMES])
    if carried is not None:
        yield edge(2, carried[0], carried[1])


def _joined(rows):
    for batch in rows:
        texts, following = (batch.column(i).fill_null("").to_pylist() for i in (1, 2))
        yield pa.record_batch(_rows(batch.column(0), texts, following, fingerprints(texts), fingerprints(following)), NAMES)


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every row of ``docs`` (doc_id, text), of its edited text, and their likeness; see ``NAMES``.

    The next document is the next row by ascending doc_id (null first, equal ids by text), the first after the last. One
    shuffle, by range of doc_id: a part's rows meet their next rows as they stream by, and only the first and last row of
    each part go through a join. A null text counts as empty. An empty table gives an empty result.
    """
    kind = dict(docs.dtypes)["doc_id"]
    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text"
    )
    found = written(ordered.mapInArrow(_ordered, f"part int, kind int, text string, doc_id {kind}, {FIELDS}"), "simhash")
    heads = found.filter("kind = 1").select("part", F.col("text").alias("following"))
    parts = heads.select("part", F.coalesce(
        F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    ).alias("next_part"))
    tails = found.filter("kind = 2").select("part", "doc_id", "text").join(parts, "part")
    edges = tails.join(heads.select(F.col("part").alias("next_part"), "following"), "next_part").select("doc_id", "text", "following")
    inner = found.filter("kind IS NULL").select(*NAMES)
    return inner.unionByName(edges.mapInArrow(_joined, f"doc_id {kind}, {FIELDS}"))


def near(prints: DataFrame, radius: int = RADIUS, agreeing: int = AGREEING) -> DataFrame:
    """For every distinct fingerprint of ``prints`` (fingerprint, doc_id): first_near and n_near.

    n_near counts the other distinct fingerprints within ``radius`` bits, first_near is the smallest doc_id of all within
    it, the fingerprint's own included. No pair within the radius is missed, and none is written out.
    """
    blocks = radius + agreeing
    edges = np.linspace(0, BITS, blocks + 1).astype(int)
    own = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")).withColumn("node", F.xxhash64("fingerprint")), "simhash")

    def fronts(rows):
        for batch in rows:
            raw = np.frombuffer(bytes.fromhex("".join(batch.column(0).to_pylist())), dtype=np.uint8).reshape(batch.num_rows, -1)
            bits = np.unpackbits(raw, axis=1)
            for t, chosen in enumerate(combinations(range(blocks), agreeing)):
                front = np.concatenate([bits[:, edges[c]:edges[c + 1]] for c in chosen], axis=1)
                padded = np.packbits(np.pad(front, ((0, 0), (0, -front.shape[1] % 64))), axis=1).view(np.uint64)
                key = np.full(len(raw), t, dtype=np.uint64)
                for k in range(padded.shape[1]):
                    key = words.mixed(key ^ padded[:, k])
                table = pa.array(np.full(len(raw), t), pa.int32())
                yield pa.record_batch([pa.array(key.astype(np.int64)), table, *batch.columns], ["key", "table", "fingerprint", "first", "node"])

    def matches(rows):
        for cell in each_cell(rows):
            a, b, same = sides(cell)
            at = {c: cell.column(cell.schema.get_field_index(c)) for c in ("fingerprint", "table", "first", "node")}
            raw = np.frombuffer(bytes.fromhex("".join(at["fingerprint"].to_pylist())), dtype=np.uint8).reshape(cell.num_rows, -1)
            table = at["table"][0].as_py()
            node, first = (at[c].to_numpy(zero_copy_only=False) for c in ("node", "first"))
            for x, y in [(a, b)] if same else [(a, b), (b, a)]:
                count, least = np.zeros(len(x), dtype=np.int64), first[x].copy()
                for i in range(0, len(x), 256):
                    differ = np.bitwise_count(raw[x[i:i + 256], None] ^ raw[None, y])
                    hit = (differ.sum(-1) <= radius) & (node[x[i:i + 256], None] != node[None, y])
                    least[i:i + 256] = np.minimum(least[i:i + 256], np.where(hit, first[None, y], np.iinfo(np.int64).max).min(1))
                    if hit.any():  # a pair counts in the first of the tables in which it meets
                        p, q = np.nonzero(hit)
                        bits = np.unpackbits(raw[x[i + p]] ^ raw[y[q]], axis=1)
                        equal = np.stack([~bits[:, edges[c]:edges[c + 1]].any(1) for c in range(blocks)], axis=1)
                        earlier = np.zeros(len(p), dtype=bool)
                        for chosen in list(combinations(range(blocks), agreeing))[:table]:
                            earlier |= equal[:, list(chosen)].all(1)
                        np.add.at(count, i + p[~earlier], 1)
                yield pa.record_batch([pa.array(node[x]), pa.array(least), pa.array(count)], ["node", "least", "count"])

    keyed = own.select("fingerprint", F.col("first").cast("bigint").alias("first"), "node").filter("first IS NOT NULL")
    keyed = keyed.mapInArrow(fronts, "key long, table int, fingerprint string, first long, node long")
    hits = in_cells(written(keyed, "simhash"), "simhash").mapInArrow(matches, "node long, least long, count long")
    best = hits.groupBy("node").agg(F.min("least").alias("least"), F.sum("count").alias("n_near"))
    return own.join(best, "node", "left").select(
        "fingerprint", F.coalesce(F.least("first", "least"), "first").alias("first_near"), F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near")
    )


def digest(docs: DataFrame) -> DataFrame:
    """``compare`` with n_near and first_near of each document's fingerprint."""
    compared = written(compare(docs), "simhash")
    told = written(near(compared.select("fingerprint", "doc_id")), "simhash")
    return compared.join(told, "fingerprint").select(*NAMES, "n_near", "first_near")
