"""N-gram Jaccard join with parity sketches.

Every shingle toggles one bit of a very wide sketch, so the Hamming distance of two sketches is at most the size of the
symmetric difference of the sets. Per size band the sketch is cut into blocks, more of them than a linked pair can differ
in; a block is held as the exclusive-or of its set bits' hashes. Documents that agree in a block are candidates:

* A document of n shingles differs from a partner in at most k = n (1 - t) / t shingles. Of the blocks, ordered by the
  number of bits in them, most first, both partners' first k + 1 must have one in common; only these are joined.
* Equal sets are one node. Equal blocks within a task are linked there, so a block's rows are at most one per task.
* Each node is first checked against a few nodes: those whose sketches differ least among four nodes of each of its
  blocks; then, if its blocks have nodes of other components, once more against a few of those. What is then still in different components but shares a block is checked pair by pair. A bound by size and by
  a dense parity sketch comes before every check.

No partner is capped: every pair at or above the threshold shares a block and is checked or already connected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import units, words
from vigil.llm.components import components, sized
from vigil.session import settings, written

SKETCH_LONGS = 16  # the dense sketch: 1,024 bits
HEADS = 4  # nodes of a block that its other nodes meet first, and pairs that each node is checked in first
FLUSH = 200_000  # keys that a task holds before it links equal ones and passes them on
OUT_ROWS = 64_000  # rows of each batch handed back to Spark
TEXT_BYTES = 1 << 20  # text whose sets are made at a time
IN_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}  # texts that Spark hands over at a time
_BLOCK_SALT, _BIT_SALT, _SET_SALT = (int(x) for x in words.numbers(3, 4))


def sets(column: pa.Array, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, starts = words.text_bytes(column)
    found, first = words.word_hashes(data, starts)
    return [np.unique(words.shingle_hashes(found[a:b], shingle)) for a, b in zip(first[:-1], first[1:])]


def difference(n: int, percent: int) -> int:
    """The most shingles in which a set of ``n`` differs from a linked one."""
    return n * (100 - percent) // percent


def set_id(s: np.ndarray) -> int:
    return int((words.mixed(s ^ np.uint64(_SET_SALT)).sum(dtype=np.uint64) + np.uint64(len(s))).astype(np.int64))


def parity(s: np.ndarray) -> np.ndarray:
    """The dense sketch: bit h mod 1,024 is set when an odd number of shingles falls on it."""
    bits = np.bincount((s & np.uint64(64 * SKETCH_LONGS - 1)).astype(np.int64), minlength=64 * SKETCH_LONGS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def block_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the blocks by which a set is joined, in the size bands where it can have partners."""
    n = len(s)
    most = difference(n, percent)
    if not most:  # only an equal set can be linked
        return np.empty(0, dtype=np.uint64)
    band, out = n.bit_length() - 1, []
    for c in (band, band + 1) if n * 100 // percent >= 2 << band else (band,):
        blocks = 3 * difference(2 << c, percent) // 2 + 2
        block = ((s >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)  # ascending, as s is
        start = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        fold = np.bitwise_xor.reduceat(words.mixed(s ^ np.uint64(_BIT_SALT)), start)
        count, number = np.diff(np.append(start, n)), block[start]
        if len(number) <= most:  # blocks without bits come last, but come
            rest = np.setdiff1d(np.arange(blocks, dtype=np.uint64), number)
            number = np.append(number, rest)
            fold, count = np.append(fold, np.zeros(len(rest), np.uint64)), np.append(count, np.zeros(len(rest), count.dtype))
        tag = (np.uint64(c) << np.uint64(56)) ^ (number << np.uint64(24)) ^ count.astype(np.uint64)
        key = words.mixed(words.mixed(tag ^ np.uint64(_BLOCK_SALT)) ^ fold)
        out.append(key[np.lexsort((key, -count))[:most + 1]])
    return np.concatenate(out)


def _local(keys: list[np.ndarray], ids: list[int]):
    """Batches of rows (key, sid, rep): one per distinct key with the smallest set of this task, one for each other set."""
    key = np.concatenate(keys)
    sid = np.repeat(np.array(ids, dtype=np.int64), [len(k) for k in keys])
    order = np.lexsort((sid, key))
    key, sid = key[order], sid[order]
    fresh = np.append(True, (key[1:] != key[:-1]) | (sid[1:] != sid[:-1]))
    key, sid = key[fresh], sid[fresh]
    first = np.append(True, key[1:] != key[:-1])
    rep = sid[first][np.cumsum(first) - 1]
    for a in range(0, len(key), OUT_ROWS):
        b = a + OUT_ROWS
        yield pa.record_batch(
            [pa.array(key[a:b].astype(np.int64)), pa.array(sid[a:b]), pa.array(rep[a:b], mask=first[a:b])], ["key", "sid", "rep"]
        )


def with_set(docs: DataFrame, name: str, shingle: int = 5) -> DataFrame:
    """``docs`` with the id of each text's shingle set in column ``name``; null for a text without shingles."""
    def run(rows):
        units.forget()
        for batch in units.batches(rows, "text", TEXT_BYTES):
            found = sets(batch.column(batch.schema.get_field_index("text")), shingle)
            sid = np.array([set_id(s) for s in found], dtype=np.int64)
            none = np.array([not len(s) for s in found], dtype=bool)
            yield pa.record_batch([*batch.columns, pa.array(sid, mask=none)], [*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def join(docs: DataFrame, shingle: int = 5, percent: int = 80, groups: bool = False) -> DataFrame:
    """Components of documents linked by shingle sets: doc_id, n_shingles, component_id for every row of ``docs``.

    Words are runs without white space, A-Z lower-cased; a text of fewer than ``shingle`` words is one shingle. Two
    documents link when 100 * intersection >= percent * union, so equal sets always do. component_id is the smallest
    doc_id reachable. A text that is null or has no word has no shingles and stands alone. Repeated rows are in one
    component; a null doc_id counts only if its component has no other. An empty table gives an empty result; columns
    besides doc_id and text are not read. Shingles are compared by 64-bit hashes. With ``groups`` there are two more
    columns, which tell rows apart that share a doc_id or have none: set_id (see ``with_set``) and group, the smallest
    set_id of the component; both are null for a text without shingles.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def sign(rows):
        units.forget()
        for batch in units.batches(rows, "text", TEXT_BYTES):
            found = sets(batch.column(1), shingle)
            n = np.array([len(s) for s in found], dtype=np.int64)
            sid = np.array([set_id(s) for s in found], dtype=np.int64)
            dense = pa.array([parity(s) for s in found], pa.list_(pa.int64()))
            yield pa.record_batch(
                [batch.column(0), pa.array(n), pa.array(sid, mask=n == 0), dense], ["doc_id", "n", "sid", "dense"]
            )

    def keyed(rows):
        units.forget()
        keys, ids, held = [], [], 0
        for batch in units.batches(rows, "text", TEXT_BYTES):
            for s in sets(batch.column(0), shingle):
                k = block_keys(s, percent)
                if len(k):
                    keys.append(k)
                    ids.append(set_id(s))
                    held += len(k)
            if held >= FLUSH:
                yield from _local(keys, ids)
                keys, ids, held = [], [], 0
        if held:
            yield from _local(keys, ids)

    with settings(docs.sparkSession, IN_ROWS):
        signed = written(texts.mapInArrow(sign, "doc_id long, n long, sid long, dense array<long>"), "jaccard")
    blocks = texts.select("text").mapInArrow(keyed, "key long, sid long, rep long")
    # Firsts of the tasks are given the first of all; the other rows have a partner and are dealt out by themselves.
    alone = F.when(F.col("rep").isNotNull(), F.xxhash64("sid", "rep")).otherwise(0)
    whole = Window.partitionBy("key", alone).orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    shared = blocks.withColumn("rep", F.coalesce("rep", F.first("sid").over(whole))).filter("rep <> sid")
    with settings(docs.sparkSession, IN_ROWS):
        shared = written(shared, "jaccard")
    nodes = written(signed.filter("sid IS NOT NULL").groupBy("sid").agg(
        F.min("doc_id").alias("doc_id"), F.min("n").alias("n"), F.first("dense").alias("dense")
    ), "jaccard")

    members = written(shared.select("key", "sid").unionByName(shared.select("key", F.col("rep").alias("sid"))).distinct(), "jaccard")
    alone = members.withColumn("label", F.col("sid"))
    checked = written(_best(_heads(alone, 0, HEADS), nodes, percent), "jaccard")
    linked = written(_verify(checked, texts, nodes, shingle, percent), "jaccard")
    labels = components(linked)
    # Once more with other nodes of the blocks, and only between components: most true links are found by then.
    others = _heads(_open(members, labels), HEADS, 2 * HEADS).join(checked, ["a", "b"], "left_anti")
    more = written(_best(others, nodes, percent), "jaccard")
    linked = linked.unionByName(written(_verify(more, texts, nodes, shingle, percent), "jaccard"))
    checked, labels = checked.unionByName(more), components(linked)
    rest = written(_rest(_open(members, labels), nodes, percent).join(checked, ["a", "b"], "left_anti"), "jaccard")
    if not rest.isEmpty():
        more = written(_verify(rest, texts, nodes, shingle, percent), "jaccard")
        labels = components(linked.unionByName(more))

    named = nodes.select("sid", "doc_id").join(labels, F.col("sid") == F.col("node"), "left").withColumn("label", F.coalesce("label", "sid"))
    smallest = written(named.groupBy("label").agg(F.min("doc_id").alias("component_id")), "jaccard")
    of_set = written(named.select("sid", "label"), "jaccard").join(smallest, "label").select("sid", "label", "component_id")
    of_set = written(of_set, "jaccard")
    more = [F.col("sid").alias("set_id"), F.col("label").alias("group")] if groups else []
    return signed.join(of_set, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), *more
    )


def _verify(pairs: DataFrame, texts: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough, by exact intersection of the sets."""
    wanted = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    wanted = written(wanted.join(nodes.select("sid", "doc_id"), "sid"), "jaccard")
    named, unnamed = wanted.filter("doc_id IS NOT NULL"), wanted.filter("doc_id IS NULL").select("sid")

    def tokens(rows):
        units.forget()
        for batch in units.batches(rows, "text", TEXT_BYTES):
            meant, found = batch.column(0).to_pylist(), sets(batch.column(1), shingle)
            kept = [(i, s.view(np.int64)) for i, s in zip(meant, found) if set_id(s) == i]
            yield pa.record_batch(
                [pa.array([i for i, _ in kept], pa.int64()), pa.array([s for _, s in kept], pa.list_(pa.int64()))], ["sid", "tokens"]
            )

    chosen = texts.join(sized(named), "doc_id").select("sid", "text")
    # Rows of one doc_id can differ in text; only those whose set is meant are kept.
    found = chosen.mapInArrow(tokens, "sid long, tokens array<long>")
    if not unnamed.isEmpty():  # sets of which no row has a doc_id are found by the set itself
        marked = with_set(texts.filter("doc_id IS NULL").select("text"), "sid", shingle).join(sized(unnamed), "sid", "left_semi")
        found = found.unionByName(marked.select("sid", "text").dropDuplicates(["sid"]).mapInArrow(tokens, "sid long, tokens array<long>"))
    with settings(pairs.sparkSession, IN_ROWS):
        found = written(found, "jaccard")
    left = found.select(F.col("sid").alias("a"), F.col("tokens").alias("of_a"))
    right = found.select(F.col("sid").alias("b"), F.col("tokens").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    both = pairs.join(right, "b").join(left, "a").withColumn("common", common)
    return both.filter(100 * F.col("common") >= percent * (F.size("of_a") + F.size("of_b") - F.col("common"))).select("a", "b").distinct()


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, sid, label) of all nodes of those blocks whose nodes are still in different components."""
    of_sid = sized(labels).select(F.col("node").alias("sid"), "label")
    marked = members.join(of_sid, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    apart = marked.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("key")
    return marked.join(sized(written(apart, "jaccard")), "key")


def _heads(members: DataFrame, first: int, count: int) -> DataFrame:
    """Pairs (a, b, sid) of each node with some nodes of each of its blocks, in other components: drawn by hash number
    ``first`` and on, of which number 0 is the order of the nodes themselves."""
    one = F.struct("sid", "label")
    drawn = members.groupBy("key").agg(
        F.array(*(F.min_by(one, F.xxhash64("sid", F.lit(k)) if k else F.col("sid")) for k in range(first, first + count))).alias("heads")
    )
    met = members.join(written(drawn, "jaccard"), "key").select("sid", "label", F.explode(F.array_distinct("heads")).alias("head"))
    met = met.filter("label <> head.label").select("sid", F.col("head.sid").alias("head"))
    return met.select(F.least("sid", "head").alias("a"), F.greatest("sid", "head").alias("b"), "sid")


def _near(pairs: DataFrame, percent: int):
    """What size and dense sketch say: False only for pairs (n_a, n_b, dense_a, dense_b) that cannot be linked."""
    bits = F.aggregate(F.zip_with("dense_a", "dense_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    told = pairs.filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").withColumn("apart", bits / (F.col("n_a") + F.col("n_b")))
    return told.filter((100 + percent) * F.col("apart") <= 100 - percent + 1e-6)


def _best(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """For each node the few pairs that may be linked and whose sketches differ least."""
    of_a = nodes.select(F.col("sid").alias("a"), F.col("n").alias("n_a"), F.col("dense").alias("dense_a"))
    of_b = nodes.select(F.col("sid").alias("b"), F.col("n").alias("n_b"), F.col("dense").alias("dense_b"))
    near = _near(pairs.distinct().join(of_a, "a").join(of_b, "b"), percent)
    # A node meets a few nodes in each of its blocks, so its list is bounded by its own text.
    best = near.groupBy("sid").agg(F.slice(F.array_sort(F.collect_list(F.struct("apart", "a", "b"))), 1, HEADS).alias("few"))
    return best.select(F.explode("few").alias("pair")).select("pair.a", "pair.b").distinct()


def _rest(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """All pairs that share a block but are not connected, and that size and dense sketch do not rule out."""
    members = written(members.join(nodes.select("sid", "n", "dense"), "sid"), "jaccard")
    a = members.select("key", *(F.col(c).alias(f"{c}_a") for c in ("sid", "label", "n", "dense")))
    b = members.select("key", *(F.col(c).alias(f"{c}_b") for c in ("sid", "label", "n", "dense")))
    joined = _near(a.join(b, "key").filter("label_a < label_b"), percent)
    return joined.select(F.least("sid_a", "sid_b").alias("a"), F.greatest("sid_a", "sid_b").alias("b")).distinct()
