"""Embedding near-dedup by sorted projection passes.

In every pass the vectors are ordered by a key of concatenated random hashes (signs of projections), and each is compared
with its neighbours in that order, exactly and in double precision. A pass finds a pair whose first bits agree as far as
the window reaches; the passes are independent, and verified pairs are united across them. Where vectors crowd together,
more signs must agree. How many passes that takes is seen from probes: made-up partners of some vectors, just at the
threshold, go through the passes too, and passes are added until all but a hundredth of the probes have met their
vectors. The hashes of added passes are centred on vectors of the table, so crowds are split as often as they are
large. Inside a component found this
way all pairs are compared, so the links of a vector are counted without any cap.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.cells import each_cell, in_cells, sides
from vigil.llm.components import components, forest
from vigil.session import written

WINDOW = 512  # a vector is compared with 512 to 1,023 neighbours before it, and as many after it, in its partition
RECALL = 0.99
SAMPLE, PROBES = 2048, 512  # vectors on which hashes are centred; probes of each kind
LEAST_PASSES = 12
BITS = 63


def passes_for(rows: int, cosine: float, recall: float = RECALL) -> int:
    """Passes that find a pair just at ``cosine`` with probability ``recall`` among ``rows`` vectors in random directions.

    Two such vectors get the same sign with probability 1 - angle / pi; log2(rows / WINDOW) signs must agree to meet.
    """
    same = 1 - math.acos(cosine) / math.pi
    met = same ** max(0.0, math.log2(max(rows, 1) / WINDOW))
    return LEAST_PASSES if met >= 1 else max(LEAST_PASSES, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def _units(column: pa.Array) -> np.ndarray:
    """Unit vectors, in double precision, of lists of one length."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _probes(sample: list[tuple[int, list[float]]], cosine: float) -> list[tuple[int, int, int, list[float]]]:
    """(number, crowded, node, vector) of made-up partners at ``cosine`` of the sample's vectors.

    A partner lies in a random direction from its vector or, if the sample has one nearby, towards that one (crowded).
    """
    rng, out, of_dim = np.random.default_rng(5), [], {}
    for node, v in sample:
        of_dim.setdefault(len(v), []).append((node, v))
    for dim, some in of_dim.items():
        x = _units(pa.array([v for _, v in some], pa.list_(pa.float64())))
        alike = x @ x.T
        alike[alike >= cosine] = -1
        nearest = alike.argmax(1)
        for i, (node, _) in enumerate(some):
            near = alike[i, nearest[i]] > 2 * cosine * cosine - 1
            ways = [(0, rng.standard_normal(dim))] + ([(1, x[nearest[i]])] if near else [])
            for crowded, way in ways:
                way = way - (way @ x[i]) * x[i]
                if dim > 1 and way @ way > 1e-12:
                    made = cosine * x[i] + math.sqrt(1 - cosine * cosine) * way / math.sqrt(way @ way)
                    out.append((crowded, node, made.tolist()))
    kept = [p for kind in (0, 1) for p in [p for p in out if p[0] == kind][:PROBES]]
    return [(k, *p) for k, p in enumerate(kept)]


def _keys(passes: range, centres: dict[int, np.ndarray]):
    """Rows (pass, dim, key, node, probe, vector) of every vector in every pass; hashes are centred on some of ``centres``."""
    def run(rows):
        for batch in rows:
            dims = np.diff(batch.column(2).offsets.to_numpy())
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = _units(part.column(2))
                for k in passes:
                    rng = np.random.default_rng([k, int(dim)])
                    directions, level = rng.standard_normal((int(dim), BITS)), 0
                    if int(dim) in centres:
                        at = centres[int(dim)]
                        level = (at[rng.integers(0, len(at), BITS)] * directions.T).sum(1)
                    key = ((x @ directions > level) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))).astype(np.int64)
                    n = len(part)
                    yield pa.record_batch(
                        [pa.array(np.full(n, k), pa.int32()), pa.array(np.full(n, dim), pa.int32()), pa.array(key), *part.columns],
                        ["pass", "dim", "key", "node", "probe", "vector"],
                    )
    return run


def _windows(cosine: float):
    """Links of each block of the order with itself and the rows before it, as a forest: at most one row per vector.

    Probes link with nothing; a row (null, null, number) says that one was compared with its vector.
    """
    def run(rows):
        before = None
        for batch in rows:
            for start in range(0, batch.num_rows, WINDOW):
                block = batch.slice(start, WINDOW)
                order = np.stack([block.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)])
                for lot in np.unique(order, axis=1).T:  # one pass and one dimension at a time
                    mine = np.flatnonzero((order == lot[:, None]).all(0))
                    x = _units(block.column(5).take(pa.array(mine)))
                    node, probe = (block.column(i).to_numpy(zero_copy_only=False)[mine] for i in (3, 4))
                    if before is not None and tuple(before[0]) == tuple(lot):
                        y, other, made = (np.concatenate(p) for p in zip(before[1:], (x, node, probe)))
                    else:
                        y, other, made = x, node, probe
                    i, j = np.nonzero(x @ y.T >= cosine)
                    apart = (node[i] != other[j]) & (probe[i] < 0) & (made[j] < 0)
                    u, v = forest(node[i[apart]], other[j[apart]]) if apart.any() else (node[:0], node[:0])
                    met = np.append(
                        probe[(probe >= 0) & np.isin(node, other[made < 0])], made[(made >= 0) & np.isin(other, node[probe < 0])]
                    )
                    if len(u) or len(met):
                        yield pa.record_batch([
                            pa.array([*u.tolist(), *[None] * len(met)], pa.int64()), pa.array([*v.tolist(), *[None] * len(met)], pa.int64()),
                            pa.array([*[None] * len(u), *met.tolist()], pa.int32()),
                        ], ["u", "v", "probe"])
                    before = (lot, y[-WINDOW:], other[-WINDOW:], made[-WINDOW:])
    return run


def _count(cosine: float):
    """Links of each node within each cell, counted with the copies of the other vector."""
    def run(rows):
        for cell in each_cell(rows):
            a, b, same = sides(cell)
            at = {c: cell.schema.get_field_index(c) for c in ("node", "copies", "vector")}
            node, copies = (cell.column(at[c]).to_numpy(zero_copy_only=False) for c in ("node", "copies"))
            x = _units(cell.column(at["vector"]))
            of_a, of_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
            for i in range(0, len(a), 1024):
                hit = x[a[i:i + 1024]] @ x[b].T >= cosine
                if same:
                    hit[np.arange(len(hit)), np.arange(i, i + len(hit))] = False
                of_a[i:i + 1024] = hit @ copies[b]
                of_b += copies[a[i:i + 1024]] @ hit
            found = [(node[a], of_a)] if same else [(node[a], of_a), (node[b], of_b)]
            for n, c in found:
                yield pa.record_batch([pa.array(n, pa.int64()), pa.array(c, pa.int64())], ["node", "links"])
    return run


def dedup(vectors: DataFrame, cosine: float = 0.95, passes: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding; labels are not read).

    Pairs of cosine ``cosine`` and more link. n_links counts the other rows linked directly, component_id is the smallest
    vec_id reachable, kept says whether that is the row itself. A vector without vec_id, or one that is null, empty,
    zero, or holds a null or a number that is not finite links with nothing; vectors of different lengths do not link.
    Equal vectors are one node, so copies cost nothing. An empty table gives an empty result. Rows that share a vec_id but not a vector count
    as one, with the links of all.

    No link below the threshold is reported. A pair may be missed only if no pass brings it, or a chain of links between
    its ends, into one window. Passes are added until that holds for under one in a hundred of the probes in random
    directions and of those in crowds, so their number follows from the table; ``passes`` sets it instead. Every pass
    shuffles the vectors once.
    """
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    ) & F.exists("embedding", lambda x: x != 0)
    same = [F.xxhash64("embedding").alias("h"), F.hash("embedding").alias("g")]
    base = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    good = base.filter(usable).select("vec_id", "embedding", *same)
    nodes = written(good.groupBy("h", "g").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.min_by("embedding", "vec_id").alias("vector")
    ), "nearvec")
    kind = dict(nodes.dtypes)["vector"]
    few = nodes.select("node", "vector").orderBy(F.xxhash64("node")).limit(SAMPLE).collect()
    sample = [(r["node"], [float(x) for x in r["vector"]]) for r in few]
    probes = _probes(sample, cosine)
    centres = {d: _units(pa.array([v for _, v in sample if len(v) == d], pa.list_(pa.float64()))) for d in {len(v) for _, v in sample}}
    made = nodes.sparkSession.createDataFrame([(n, k, v) for k, _, n, v in probes], "node long, probe int, vector array<double>")
    passing = nodes.select("node", F.lit(-1).alias("probe"), "vector").unionByName(made.withColumn("vector", F.col("vector").cast(kind)))

    def links_of(numbers: range, centres: dict[int, np.ndarray]) -> DataFrame:
        keyed = passing.mapInArrow(_keys(numbers, centres), f"pass int, dim int, key long, node long, probe int, vector {kind}")
        order = ("pass", "dim", "key", "node")
        sorted_ = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
        return written(sorted_.mapInArrow(_windows(cosine), "u long, v long, probe int"), "nearvec")

    rounds = passes or passes_for(nodes.count(), cosine)
    links = links_of(range(rounds), {})
    met = {r["probe"] for r in links.filter("probe IS NOT NULL").select("probe").distinct().collect()}
    while not passes and any(
        sum(k in met for k in numbers) < RECALL * len(numbers)
        for numbers in ([k for k, crowded, *_ in probes if crowded == c] for c in (0, 1))
    ):
        more = links_of(range(rounds, rounds + max(LEAST_PASSES, rounds // 2)), centres)
        rounds += max(LEAST_PASSES, rounds // 2)
        links = links.unionByName(more)
        met |= {r["probe"] for r in more.filter("probe IS NOT NULL").select("probe").distinct().collect()}
    labels = components(links.filter("probe IS NULL").select("u", "v"))

    members = labels.withColumnRenamed("label", "key").join(nodes.select("node", "copies", "vector"), "node")
    counted = in_cells(written(members, "nearvec"), "nearvec").mapInArrow(_count(cosine), "node long, links long")
    counted = counted.groupBy("node").agg(F.sum("links").alias("links"))
    told = nodes.select("h", "g", "node", "copies").join(counted, "node", "left").join(labels, "node", "left")
    told = written(told.select(
        "h", "g", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("label", "node").alias("component_id")
    ), "nearvec")
    marked = base.select("vec_id", F.when(usable, same[0]).alias("h"), F.when(usable, same[1]).alias("g"))
    return marked.join(told, ["h", "g"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
