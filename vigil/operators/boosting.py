"""Boosted trees with patience: histograms of gradients over binned columns, summed block by block.

Rows are binned once (a byte a value) and kept in blocks. Tables of up to ``ONE_TASK`` bytes are trained inside one task;
larger ones stay spread, and every level of a tree is one sum over all blocks. Both grow trees by the same rules. The
outcome is MLlib's ``GBTClassificationModel``, so scoring, saving and importances are MLlib's.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.session import shared_dir, written

ONE_TASK = 32 << 20  # bytes of binned values that one task trains on its own
BLOCK_ROWS = 16_384
POINTS = 4_096  # values a summary of a column keeps; below that many distinct values it is exact
CHECKPOINT_ROUNDS = 25  # margins of a spread table are checkpointed so often, or their lineage would grow with the rounds
MERGED = 64
BLOCK_SCHEMA = "part int, number int, held boolean, x binary, y binary, w binary"
LEAST_HESSIAN = 1e-3


@dataclass(frozen=True)
class Rules:
    rounds: int = 2000
    depth: int = 5
    rate: float = 0.05
    min_leaf: int = 500
    fraction: float = 0.8  # of rows and of columns, drawn anew for each tree
    seed: int = 42
    patience: int = 100
    l1: float = 0.5
    l2: float = 0.5
    bins: int = 255


# ---- binning -------------------------------------------------------------------------------------

def merged(a, b):
    """Two summaries (ordered values, their counts) as one of at most ``POINTS`` values."""
    values, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([a[1], b[1]]), len(values))
    if len(values) <= POINTS:
        return values, counts
    upto = np.cumsum(counts)
    kept = np.unique(np.searchsorted(upto, np.linspace(0, upto[-1], POINTS + 1)[1:] - 0.5))
    return values[kept], np.diff(upto[kept], prepend=0)


def summaries(batches):
    part, found = TaskContext.get().partitionId(), None
    for batch in batches:
        rows = _matrix(batch.column("_values"))
        found = found or [(np.empty(0), np.empty(0))] * rows.shape[1]
        parts = (np.unique(column, return_counts=True) for column in rows.T)
        found = [merged(was, (v, n.astype(float))) for was, (v, n) in zip(found, parts)]
    for k, (values, counts) in enumerate(found or ()):
        at = {"k": pa.array([k], pa.int32()), "part": pa.array([part], pa.int32())}
        yield pa.RecordBatch.from_pydict({**at, "v": [values.tobytes()], "n": [counts.tobytes()]})


def merged_in_order(found):
    """Summaries by (column, number) merged per column in the order of the numbers, ``MERGED`` at a time."""
    def together(parts):
        return reduce(merged, [summary for _, summary in sorted(parts, key=lambda p: p[0])])

    some = found.map(lambda s: ((s[0], s[1] // MERGED), (s[1], s[2]))).groupByKey().mapValues(together)
    return some.map(lambda s: (s[0][0], (s[0][1], s[1]))).groupByKey().mapValues(together)


def cut_points(summary, bins: int, missing: float):
    """Where a column can be cut: a value belongs to the left of a cut that it does not pass. Missing values get a bin."""
    values, counts = summary
    own = values > missing
    low, (values, counts) = values[~own], (values[own], counts[own])
    if len(values) > bins - 1:
        upto = np.cumsum(counts)
        values = values[np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, bins) / (bins - 1) - 0.5))]
    cuts = np.concatenate([low[-1:], values])
    return cuts[:-1]


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def binned(cuts):
    def blocks(batches):
        part, number, waiting = TaskContext.get().partitionId(), 0, {False: [], True: []}

        def flushed(held):
            nonlocal number
            rows = [np.concatenate(x) for x in zip(*waiting[held])]
            waiting[held] = []
            for start in range(0, len(rows[1]), BLOCK_ROWS):
                x, y, w = (r[start:start + BLOCK_ROWS] for r in rows)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()), "held": [held],
                    "x": [np.ascontiguousarray(x.T).tobytes()], "y": [y.tobytes()], "w": [w.tobytes()],
                })
                number += 1

        for batch in batches:
            values = _matrix(batch.column("_values"))
            codes = np.stack([np.searchsorted(c, values[:, k]).astype(np.uint8) for k, c in enumerate(cuts)], axis=1)
            y, w, held = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_label", "_weight", "_held"))
            if np.isnan(y.astype(float)).any():
                raise ValueError("a row to train on has no label")
            for side in (False, True):
                at = held.astype(bool) == side
                if at.any():
                    waiting[side].append((codes[at], y[at].astype(float), w[at].astype(float)))
                if sum(len(x[1]) for x in waiting[side]) >= BLOCK_ROWS:
                    yield from flushed(side)
        for side in (False, True):
            if waiting[side]:
                yield from flushed(side)

    return blocks


def unpacked(row):
    y = np.frombuffer(row.y)
    return (row.part, row.number), row.held, np.frombuffer(row.x, np.uint8).reshape(-1, len(y)), y, np.frombuffer(row.w)


# ---- trees ---------------------------------------------------------------------------------------

class Tree:
    """Nodes in lists; a leaf has feature -1."""

    def __init__(self, value=0.0):
        self.feature, self.bin, self.left, self.right, self.value, self.count, self.gain = [-1], [0], [-1], [-1], [value], [0], [0.0]

    def split(self, node, feature, at, gain):
        self.feature[node], self.bin[node], self.gain[node] = feature, at, gain
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for field, new in (("feature", -1), ("bin", 0), ("left", -1), ("right", -1), ("value", 0.0), ("count", 0), ("gain", 0.0)):
            getattr(self, field).extend([new, new])
        return self.left[node], self.right[node]

    def step(self, x, node):
        """The nodes one level further down."""
        feature, at, left, right = (np.array(v) for v in (self.feature, self.bin, self.left, self.right))
        inner = np.flatnonzero(feature[node] >= 0)
        of = node[inner]
        out = node.copy()
        out[inner] = np.where(x[feature[of], inner] <= at[of], left[of], right[of])
        return out

    def walk(self, x):
        node = np.zeros(x.shape[1], np.int64)
        while (below := self.step(x, node)) is not None and not np.array_equal(below, node):
            node = below
        return node

    def values(self, x):
        return np.array(self.value)[self.walk(x)]


def gradients(margin, y, w):
    p = 1 / (1 + np.exp(-margin))
    return w * (p - y), w * p * (1 - p)


def drawn(rules: Rules, turn: int, key, n: int):
    return np.flatnonzero(np.random.default_rng([rules.seed, turn, 1, *key]).random(n) < rules.fraction)


def histogram(x, rows, slot, g, h, features, slots, bins):
    """Sums of gradients, Hessians and rows per slot, column and bin."""
    out, base = np.empty((3, slots, len(features), bins)), slot * bins
    for k, f in enumerate(features):
        at = base + x[f][rows]
        for i, part in enumerate((g, h, None)):
            out[i, :, k] = np.bincount(at, part, slots * bins).reshape(slots, bins)
    return out


def best_split(sums, rules: Rules):
    """Best cut of a node, from its sums by column and bin: (gain, column, bin, left totals, totals); no gain where no cut
    is allowed."""
    def worth(g, h):
        if rules.l1:
            g = np.maximum(np.abs(g) - rules.l1, 0)
        return g * g / (h + (rules.l2 + 1e-12))

    whole = sums[:, 0].sum(axis=1)
    least = max(rules.min_leaf, 1)
    if whole[2] < 2 * least:
        return 0.0, 0, 0, whole.tolist(), whole.tolist()
    left = np.cumsum(sums, axis=2)
    g, h, n = left
    gain = worth(g, h)
    gain += worth(whole[0] - g, whole[1] - h)
    gain[(n < least) | (n > whole[2] - least) | (h < LEAST_HESSIAN) | (h > whole[1] - LEAST_HESSIAN)] = 0
    k, b = divmod(int(gain.argmax()), gain.shape[1])
    return float(gain[k, b] - worth(*whole[:2])), k, b, left[:, k, b].tolist(), whole.tolist()


def leaf_value(totals, rules: Rules):
    g, h = totals[0], totals[1]
    return -rules.rate * np.sign(g) * max(abs(g) - rules.l1, 0) / (h + rules.l2 + 1e-12)


def auroc_of(y, margin):
    """Exact, ties counting half; NaN when a class has no rows."""
    return _share(_ranked([_steps(y, margin)]))


def _steps(y, margin):
    values, at = np.unique(margin, return_inverse=True)
    return values, np.bincount(at, y == 1, len(values)), np.bincount(at, y != 1, len(values))


def _ranked(parts):
    """(positives, negatives, pairs ranked right) of rows given as values with their positives and negatives."""
    values, pos, neg = (np.concatenate(x) for x in zip(*parts))
    values, at = np.unique(values, return_inverse=True)
    pos, neg = np.bincount(at, pos, len(values)), np.bincount(at, neg, len(values))
    return pos.sum(), neg.sum(), (pos * (np.cumsum(neg) - neg / 2)).sum()


def _share(*cells):
    """AUROC of cells in ascending order of their values."""
    below = right = positives = 0.0
    for pos, neg, pairs in cells:
        right, below, positives = right + pairs + pos * below, below + neg, positives + pos
    return float(right / (positives * below)) if positives and below else float("nan")


# ---- where the rows are --------------------------------------------------------------------------

class Held:
    """All blocks in the memory of this task."""

    def __init__(self, blocks, rules: Rules, bins: int):
        self.rules, self.bins = rules, bins
        blocks = sorted(blocks, key=lambda b: b[0])
        sides = [[b for b in blocks if b[1] == held] for held in (False, True)]
        width = blocks[0][2].shape[0] if blocks else 0
        self.keys = [(b[0], len(b[3])) for b in sides[0]]
        (self.x, self.y, self.w), (self.hx, self.hy, _) = (
            (np.concatenate([b[2] for b in side], axis=1) if side else np.empty((width, 0), np.uint8),
             *(np.concatenate([b[i] for b in side]) if side else np.empty(0) for i in (3, 4)))
            for side in sides
        )
        self.columns = width

    def totals(self):
        return float((self.w * self.y).sum()), float(self.w.sum())

    def start(self, margin):
        self.margin, self.held_margin = np.full(len(self.y), margin), np.full(len(self.hy), margin)

    def open(self, turn):
        starts = np.cumsum([0, *[n for _, n in self.keys]])
        self.rows = np.concatenate([at + drawn(self.rules, turn, key, n) for at, (key, n) in zip(starts, self.keys)])
        g, h = gradients(self.margin, self.y, self.w)
        self.g, self.h = g[self.rows], h[self.rows]
        self.node, self.sums = np.zeros(len(self.y), np.int64), {}

    def splits(self, tree, level, parents, features):
        if parents:  # the smaller child is counted, the other is what its parent has besides
            self.node = tree.step(self.x, self.node)
            counted = [min(pair, key=lambda n: tree.count[n]) for pair in parents.values()]
        else:
            counted = level
        slot_of = np.full(len(tree.feature), -1)
        slot_of[counted] = np.arange(len(counted))
        slot = slot_of[self.node[self.rows]]
        kept = np.flatnonzero(slot >= 0)
        sums = histogram(self.x, self.rows[kept], slot[kept], self.g[kept], self.h[kept], features, len(counted), self.bins)
        was, self.sums = self.sums, {n: sums[:, s] for s, n in enumerate(counted)}
        for parent, pair in parents.items():
            other = pair[0] if pair[1] in self.sums else pair[1]
            self.sums[other] = was[parent] - self.sums[pair[0] + pair[1] - other]
        if not level:
            return []
        return [best_split(self.sums[n], self.rules) for n in level]

    def add(self, tree):
        self.margin = self.margin + tree.values(self.x)
        self.held_margin = self.held_margin + tree.values(self.hx)

    def auroc(self):
        return auroc_of(self.hy, self.held_margin) if len(self.hy) else float("nan")


class Spread:
    """Blocks stay where they are; margins are kept beside them."""

    def __init__(self, blocks, rules: Rules, bins: int, columns: int):
        self.rules, self.bins, self.columns = rules, bins, columns
        self.blocks = blocks._reserialize(BatchedSerializer(CPickleSerializer(), 1)).persist()
        self.parts, self.turn, self.kept = self.blocks.getNumPartitions(), 0, []

    def _both(self):
        return self.blocks.zip(self.margins)

    def _keep(self, margins):
        margins = margins._reserialize(BatchedSerializer(CPickleSerializer(), 1)).persist()
        if len(self.kept) % CHECKPOINT_ROUNDS == CHECKPOINT_ROUNDS - 1:
            margins.checkpoint()
        margins.count()
        if self.kept:
            self.kept[-1].unpersist()
        self.kept.append(margins)
        self.margins = margins

    def totals(self):
        sums = self.blocks.filter(lambda b: not b[1]).map(lambda b: ((b[3] * b[4]).sum(), b[4].sum()))
        a, b = sums.fold((0.0, 0.0), lambda p, q: (p[0] + q[0], p[1] + q[1]))
        return float(a), float(b)

    def start(self, margin):
        self._keep(self.blocks.map(lambda b: np.full(len(b[3]), margin)))

    def open(self, turn):
        self.turn = turn

    def splits(self, tree, level, parents, features):
        rules, bins, turn = self.rules, self.bins, self.turn
        if not level:
            return []

        def counted(rows):
            sums, slot_of = None, np.full(len(tree.feature), -1)
            slot_of[level] = np.arange(len(level))
            for (key, held, x, y, w), margin in rows:
                if held:
                    continue
                slot = slot_of[tree.walk(x)]
                at = drawn(rules, turn, key, len(y))
                at = at[slot[at] >= 0]
                g, h = gradients(margin, y, w)
                part = histogram(x, at, slot[at], g[at], h[at], features, len(level), bins)
                sums = part if sums is None else sums + part
            if sums is not None:
                yield from ((s, sums[:, s]) for s in range(len(level)))

        summed = self._both().mapPartitions(counted).reduceByKey(np.add, min(len(level), self.parts))
        found = summed.mapValues(lambda v: best_split(v, rules)).collectAsMap()
        return [found[s] for s in range(len(level))]

    def add(self, tree):
        self._keep(self._both().map(lambda b: b[1] + tree.values(b[0][2])))

    def auroc(self):
        held = self._both().filter(lambda b: b[0][1]).map(lambda b: _steps(b[0][3], b[1]))
        marks = held.map(lambda s: np.quantile(s[0], np.linspace(0, 1, 65))).collect()
        if not marks:
            return float("nan")
        cuts = np.unique(np.quantile(np.concatenate(marks), np.linspace(0, 1, 4 * self.parts + 1)[1:-1]))

        def celled(steps):
            cell = np.searchsorted(cuts, steps[0])
            edges = np.flatnonzero(np.diff(cell)) + 1
            return [(int(c[0]), part) for c, *part in zip(np.split(cell, edges), *[np.split(s, edges) for s in steps])]

        cells = held.flatMap(celled).groupByKey(self.parts).mapValues(lambda parts: _ranked(list(parts))).collectAsMap()
        return _share(*[cells[c] for c in sorted(cells)])


def grown(data, rules: Rules, turn: int):
    """One tree, level by level."""
    rng = np.random.default_rng([rules.seed, turn, 0])
    features = np.sort(rng.choice(data.columns, max(1, round(rules.fraction * data.columns)), replace=False))
    data.open(turn)
    tree, level, parents = Tree(), [0], {}
    for depth in range(rules.depth):
        cut = {}
        for node, (gain, k, at, left, whole) in zip(level, data.splits(tree, level, parents, features)):
            if not node:
                tree.value[0], tree.count[0] = leaf_value(whole, rules), int(round(whole[2]))
            if gain > 1e-10:
                pair = tree.split(node, int(features[k]), at, gain)
                for child, part in zip(pair, (left, [a - b for a, b in zip(whole, left)])):
                    tree.value[child], tree.count[child] = leaf_value(part, rules), int(round(part[2]))
                cut[node] = pair
        parents = cut
        level = [n for pair in cut.values() for n in pair]
        if not level:
            break
    return tree


def boosted(data, rules: Rules):
    """All trees up to the round with the best AUROC of the held rows: rounds end when it has not risen for ``patience``
    rounds. Without held rows of both classes there is no such measure, and all rounds are kept. (trees, AUROC by round)"""
    positive, weight = data.totals()
    if not weight:
        raise ValueError("no rows to train on")
    share = min(max(positive / weight, 1e-6), 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    data.start(start)
    trees, course, best = [Tree(start)], [], (-1.0, 0)
    for turn in range(rules.rounds):
        tree = grown(data, rules, turn)
        if tree.feature[0] < 0:  # no column can be cut; the next tree draws others
            tree = Tree()
        else:
            data.add(tree)
        trees.append(tree)
        course.append(data.auroc() if tree.feature[0] >= 0 or not course else course[-1])
        if course[-1] > best[0]:
            best = course[-1], turn + 1
        if best[1] and turn + 1 - best[1] >= rules.patience:
            break
    kept = trees[: best[1] + 1] if best[1] else trees
    return [kept[0], *[t for t in kept[1:] if t.feature[0] >= 0]], course


# ---- MLlib ---------------------------------------------------------------------------------------

NODES = """treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint,
    gain: double, leftChild: int, rightChild: int,
    split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"""


def nodes_of(turn: int, tree: Tree, cuts):
    """The nodes as MLlib saves them, numbered with the left branch first; gains are a share of the node's rows there."""
    out, waiting = [], [0]
    order = {}
    while waiting:
        node = waiting.pop()
        order[node] = len(order)
        if tree.feature[node] >= 0:
            waiting += [tree.right[node], tree.left[node]]
    for node, number in order.items():
        f, count = tree.feature[node], max(tree.count[node], 1)
        stats = [float(count), 0.0, 0.0]
        if f < 0:
            out.append((turn, (number, float(tree.value[node]), 0.0, stats, count, -1.0, -1, -1, (-1, [], -1))))
        else:
            cut = (f, [float(cuts[f][tree.bin[node]])], -1)
            below = order[tree.left[node]], order[tree.right[node]]
            out.append((turn, (number, float(tree.value[node]), 0.0, stats, count, tree.gain[node] / count, *below, cut)))
    return out


def as_model(spark, trees, cuts, params: dict) -> GBTClassificationModel:
    """The trees as a model of MLlib, whose probability is the logistic of twice the margin: every tree weighs a half."""
    path, made = shared_dir(spark, "trees"), int(time.time() * 1000)

    def about(kind, uid, known, **more):
        return json.dumps({
            "class": f"org.apache.spark.ml.{kind}", "timestamp": made, "sparkVersion": spark.version, "uid": uid, "paramMap": known,
            "defaultParamMap": {}, **more,
        })

    columns = {k: params[k] for k in ("featuresCol", "labelCol")}
    shared = {"predictionCol": "prediction", "leafCol": "", "impurity": "variance"}
    whole = about("classification.GBTClassificationModel", f"GBTClassifier_{made:x}", {
        **params, **shared, "rawPredictionCol": "rawPrediction", "probabilityCol": "probability",
    }, numFeatures=len(cuts), numTrees=len(trees))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    inner = [
        (k, about("regression.DecisionTreeRegressionModel", f"dtr_{made:x}_{k}", {**columns, **shared}), 0.5)
        for k in range(len(trees))
    ]
    spark.createDataFrame(inner, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    rows = [row for k, tree in enumerate(trees) for row in nodes_of(k, tree, cuts)]
    spark.createDataFrame(rows, NODES).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


class BoostedTrees(Estimator):
    """Learns from the columns ``_features`` (a vector), ``label``, ``_weight`` and ``_held`` (rows that measure only)."""

    def __init__(self, label: str, rules: Rules, missing: float):
        super().__init__()
        self.label, self.rules, self.missing = label, rules, missing

    def _fit(self, df: DataFrame) -> GBTClassificationModel:
        spark, rules, missing = df.sparkSession, self.rules, self.missing
        wide = df.select(vector_to_array("_features").alias("_values"), F.col(self.label).alias("_label"), "_weight", "_held")
        parts = wide.filter("NOT _held").select("_values").mapInArrow(summaries, "k int, part int, v binary, n binary").rdd
        found = merged_in_order(parts.map(lambda r: (r.k, r.part, (np.frombuffer(r.v), np.frombuffer(r.n)))))
        found = found.mapValues(lambda s: cut_points(s, rules.bins, missing)).collectAsMap()
        if not found:
            raise ValueError("no rows to train on")
        cuts = [found[k] for k in range(len(found))]
        bins = max(map(len, cuts)) + 1
        # A row holds a block: the writer looks at the size of its pages and row groups after each of them.
        checks = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(16 << 20)}
        blocks = written(wide.mapInArrow(binned(cuts), BLOCK_SCHEMA), "binned", **checks)
        size = blocks.agg(F.sum(F.octet_length("x"))).first()[0]
        if size <= ONE_TASK:
            trained = blocks.coalesce(1).rdd.mapPartitions(lambda rows: [boosted(Held(list(map(unpacked, rows)), rules, bins), rules)])
            trees, self.course = trained.first()
        else:
            data = Spread(blocks.rdd.map(unpacked), rules, bins, len(cuts))
            trees, self.course = boosted(data, rules)
            data.blocks.unpersist()
            data.margins.unpersist()
        params = {
            "featuresCol": "_features", "labelCol": self.label, "weightCol": "_weight", "maxIter": rules.rounds, "maxDepth": rules.depth,
            "stepSize": rules.rate, "minInstancesPerNode": rules.min_leaf, "subsamplingRate": rules.fraction, "seed": rules.seed,
        }
        return as_model(spark, trees, cuts, params)
