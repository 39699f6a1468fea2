"""Token ids in files: Simple-8b word-aligned coding with per-block offsets.

A 64-bit word holds a 4-bit selector and 60 bits of payload. The selector says how many ids of how many bits the word
packs. Selector 0 is the escape: the next word is one raw id of up to 64 bits. Ids are coded in blocks of ``BLOCK``; the
word at which each block begins is stored, so blocks are coded and decoded side by side in numpy.

A file is a Parquet folder whose rows are chunks of consecutive documents: the range part, the ids before the chunk in
its part, doc ids, ids per document, words and block offsets. Parquet is only the container; the ids are in ``words``.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm import units, words
from vigil.session import shared_dir, written

#: Ids per word for selectors 1 to 15, as many as fit into 60 bits at each width.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1], dtype=np.int64)
WIDTHS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60], dtype=np.int64)
SELECTORS = [s for s in range(1, 15)]
BLOCK = 4096
CHUNK_IDS = 1 << 19
JOINED = 2048  # units that come before the library in one text
CHUNKS = (
    "part int, ids_before long, doc_ids array<{kind}>, lengths array<long>, ids long, words binary, block_words binary"
)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, at least 1."""
    out = np.ones(len(values), dtype=np.uint8)
    for bit in (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60):
        wide = values >= np.uint64(1 << bit)
        if not wide.any():
            break
        out[wide] = bit + 1
    return out


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, the number of words before each block) of 64-bit unsigned values."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.uint32)
    # longest[k][i]: bits needed by the values i .. i + 2^k - 1; beyond the end nothing is needed
    longest = [_widths(values)]
    for k in range(6):
        prior, half = longest[-1], 1 << k
        ahead = np.ones(n, dtype=np.uint8)
        if n > half:
            ahead[:n - half] = prior[half:]
        longest.append(np.maximum(prior, ahead))
    block_of_end = np.minimum((np.arange(n) // BLOCK + 1) * BLOCK, n)
    chosen = np.zeros(n, dtype=np.uint8)
    for s in SELECTORS:
        count, k = int(COUNTS[s]), int(COUNTS[s]).bit_length() - 1
        need = longest[k].copy()
        rest = count - (1 << k)
        if rest and n > rest:
            need[:n - rest] = np.maximum(need[:n - rest], longest[k][rest:])
        fits = (need <= WIDTHS[s]) & (chosen == 0)
        chosen[fits] = s
    starts, block = [], np.arange(0, n, BLOCK)
    at, order = block.copy(), np.arange(len(block))
    owner = []
    while len(at):  # one word of every block in each round
        starts.append(at)
        owner.append(order)
        at = at + COUNTS[chosen[at]]
        more = at < block_of_end[block[order]]
        at, order = at[more], order[more]
    at, order = np.concatenate(starts), np.concatenate(owner)
    sort = np.argsort(at, kind="stable")
    at, order = at[sort], order[sort]
    selector = chosen[at]
    per_block = np.bincount(order, weights=np.where(selector == 0, 2, 1), minlength=len(block)).astype(np.int64)
    before = np.cumsum(per_block) - per_block
    place = np.cumsum(np.where(selector == 0, 2, 1)) - np.where(selector == 0, 2, 1)
    words = np.zeros(int(per_block.sum()), dtype=np.uint64)
    for s in range(16):
        mine = np.flatnonzero(selector == s)
        if not len(mine):
            continue
        if s == 0:
            words[place[mine] + 1] = values[at[mine]]
            continue
        steps = np.arange(COUNTS[s])
        index = at[mine][:, None] + steps
        taken = index < block_of_end[at[mine]][:, None]
        part = np.where(taken, values[np.minimum(index, n - 1)], np.uint64(0)) << (steps * WIDTHS[s]).astype(np.uint64)
        words[place[mine]] = np.bitwise_or.reduce(part, axis=1) | np.uint64(s << 60)
    return words, before.astype(np.uint32)


def unpack(words: np.ndarray, before: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of ``pack``."""
    out = np.zeros(n, dtype=np.uint64)
    if not n:
        return out
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), dtype=bool)
    if (selector == 0).any():  # a raw word after an escape can look like anything; walk the escapes of each block
        i = 0
        while True:
            later = np.flatnonzero(selector[i:] == 0)
            if not len(later):
                break
            i += int(later[0])
            raw[i + 1] = True
            i += 2
    counts = np.where(raw, 1, np.where(selector == 0, 0, COUNTS[selector]))
    block = np.searchsorted(before, np.arange(len(words)), side="right") - 1
    first = np.cumsum(counts) - counts
    at = first - first[before][block] + block * BLOCK
    end = np.minimum((block + 1) * BLOCK, n)
    out[at[raw]] = words[raw]
    for s in SELECTORS:
        mine = np.flatnonzero((selector == s) & ~raw)
        if not len(mine):
            continue
        steps = np.arange(COUNTS[s])
        index = at[mine][:, None] + steps
        taken = index < end[mine][:, None]
        part = (words[mine][:, None] >> (steps * WIDTHS[s]).astype(np.uint64)) & np.uint64((1 << int(WIDTHS[s])) - 1)
        out[index[taken]] = part[taken]
    return out


class Joined(units.Known):
    """Units that begin with white space and end without come joined before the tokenizer: fewer and longer texts cost
    less. Their ids are cut where the units end; units that cannot be cut so come one by one.

    ``size`` has the number of bytes that each id stands for.
    """

    def __init__(self, encode, size: np.ndarray):
        super().__init__(encode)
        self.size = size

    def encoded(self, data, begins, ends):
        last = data[ends - 1]
        fit = np.flatnonzero((ends > begins) & words._WHITE[data[begins]] & ~words._WHITE[last] & (last < 0x80))
        starts, lengths = np.zeros(len(begins), dtype=np.int64), np.full(len(begins), -1, dtype=np.int64)
        width = (ends - begins)[fit]
        upto, text = np.cumsum(width), units.ragged(data, begins[fit], width).tobytes()
        firsts = np.arange(0, len(fit), JOINED)
        cuts = [0, *upto[np.append(firsts[1:], len(fit)) - 1].tolist()] if len(fit) else [0]
        found, total = [], 0
        for k, ids in zip(firsts.tolist(), self.encode([text[a:b] for a, b in zip(cuts, cuts[1:])])):
            ids = np.array(ids, dtype=np.int32)
            part = slice(k, k + JOINED)
            reached, wanted = np.cumsum(self.size[ids]), np.cumsum(width[part])
            place = np.searchsorted(reached, wanted)
            if reached[-1] == wanted[-1] and (reached[place] == wanted).all():
                stops = np.append(0, place + 1)
                starts[fit[part]], lengths[fit[part]] = total + stops[:-1], np.diff(stops)
                found.append(ids)
                total += len(ids)
        rest = np.flatnonzero(lengths < 0)
        ids, starts[rest], lengths[rest] = super().encoded(data, begins[rest], ends[rest])
        starts[rest] += total
        return np.concatenate([*found, ids]), starts, lengths


@units.per_worker
def library_units(path: str) -> units.Known:
    """The ids that the tokenizers library gives to units, remembered for the life of the worker."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    vocabulary, added = tokenizer.get_vocab(with_added_tokens=True), tokenizer.get_added_tokens_decoder()
    size = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
    for token, i in vocabulary.items():  # a letter of the vocabulary stands for one byte
        size[i] = len(added[i].content.encode()) if i in added else len(token)

    def encode(texts: list[bytes]) -> list[list[int]]:
        found = tokenizer.encode_batch_fast([t.decode("utf-8") for t in texts], add_special_tokens=False)
        return [x.ids for x in found]

    return Joined(encode, size)


def write(docs: DataFrame, path: str, out: str, end_id: int = 0) -> str:
    """Files of the ids of every text of ``docs`` (doc_id, text) in ascending doc_id order; ``end_id`` ends each document.

    One shuffle, by range of doc_id. Null ids come first, rows of one doc_id in order of their texts; null texts are
    empty. ``path`` is a tokenizers file at the same place on every node.
    """
    def run(rows):
        known, part, total = library_units(path), TaskContext.get().partitionId(), 0
        ids_held, docs_held, lengths_held, held = [], [], [], 0

        def chunk():
            words, before = pack(np.concatenate(ids_held))
            return pa.record_batch(
                [
                    pa.array([part], pa.int32()), pa.array([total], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, sum(map(len, docs_held))], pa.int32()), pa.concat_arrays(docs_held)),
                    pa.array([np.concatenate(lengths_held)], pa.list_(pa.int64())), pa.array([held], pa.int64()),
                    pa.array([words.tobytes()], pa.binary()), pa.array([before.tobytes()], pa.binary()),
                ],
                ["part", "ids_before", "doc_ids", "lengths", "ids", "words", "block_words"],
            )

        for batch in units.batches(rows, "text", 1 << 20):
            data, begins, ends, firsts = units.split(batch.column(1))
            at = known.places(data, begins, ends)
            lengths = known.lengths[at]
            ids = units.ragged(known.ids, known.begins[at], lengths)
            stops = np.append(0, np.cumsum(lengths))[firsts]
            with_end = np.insert(ids, stops[1:], end_id)
            ids_held.append(with_end)
            docs_held.append(batch.column(0))
            lengths_held.append(np.diff(stops) + 1)
            held += len(with_end)
            if held >= CHUNK_IDS:
                yield chunk()
                total += held
                ids_held, docs_held, lengths_held, held = [], [], [], 0
        if held:
            yield chunk()

    kind = dict(docs.dtypes)["doc_id"]
    ordered = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, CHUNKS.format(kind=kind)).write.parquet(out)
    return out


def chunks(batch: pa.RecordBatch):
    """(row, doc ids, ids per document, all ids) of each chunk of a record batch of files."""
    for i in range(batch.num_rows):
        row = {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}
        words = np.frombuffer(row["words"].as_py(), dtype=np.uint64)
        before = np.frombuffer(row["block_words"].as_py(), dtype=np.uint32).astype(np.int64)
        yield row, row["doc_ids"].values, row["lengths"].values.to_numpy(), unpack(words, before, row["ids"].as_py())


def _starts(files: DataFrame) -> DataFrame:
    """The ids before each part: one row per range part."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("ids").alias("ids"))
    return written(parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start")), "tokenids")


def read(files: DataFrame) -> DataFrame:
    """The documents of the files: doc_id, start (ids before it), token_ids array<long>."""
    def run(rows):
        for batch in rows:
            for row, doc_ids, lengths, ids in chunks(batch):
                stops = np.append(0, np.cumsum(lengths))
                yield pa.record_batch(
                    [pa.array([row["part"].as_py()] * len(lengths), pa.int32()), doc_ids, pa.array(stops[:-1] + row["ids_before"].as_py(), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(ids.astype(np.int64)))],
                    ["part", "doc_id", "at", "token_ids"],
                )

    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    found = files.mapInArrow(run, f"part int, doc_id {kind}, at long, token_ids array<long>")
    return found.join(_starts(files), "part").select("doc_id", (F.col("part_start") + F.col("at")).alias("start"), "token_ids")


def digest(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from files that are written and read back.

    ``start`` counts the ids of all documents before it, ``n_tokens`` its own with the end id. Null text: the end id
    alone. Repeated rows are documents of their own. An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    files = spark.read.schema(CHUNKS.format(kind=kind)).parquet(write(docs, path, shared_dir(spark, "tokenids")))

    def run(rows):
        for batch in rows:
            for row, doc_ids, lengths, ids in chunks(batch):
                stops = np.append(0, np.cumsum(lengths))
                little = memoryview(ids.astype("<u4")).cast("B")
                sums = [zlib.crc32(little[4 * a:4 * b]) for a, b in zip(stops.tolist(), stops[1:].tolist())]
                yield pa.record_batch(
                    [pa.array([row["part"].as_py()] * len(lengths), pa.int32()), doc_ids, pa.array(stops[:-1] + row["ids_before"].as_py(), pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                    ["part", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    found = files.mapInArrow(run, f"part int, doc_id {kind}, at long, n_tokens long, ids_crc32 long")
    return found.join(_starts(files), "part").select(
        "doc_id", (F.col("part_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
