"""All pairs inside groups of any size, in cells of bounded size, without emitting the pairs.

A group is cut into slices by hash of its nodes; a cell holds two slices (or one, against itself). Every pair of a group
meets in exactly one cell. Small groups are one cell; the wider a group, the wider its slices, up to ``WIDEST``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.components import sized
from vigil.session import written

NARROW, WIDEST = 32, 16_384


def in_cells(members: DataFrame, name: str) -> DataFrame:
    """``members`` (key long, node long, ...) of groups of two and more, dealt to cells and sorted by them.

    Adds lo, hi and slice: the cell is (key, lo, hi), and a row stands in it for its slice.
    """
    sizes = written(members.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), name)
    width = f"least({WIDEST}, greatest({NARROW}, {NARROW} * pow(size / 1024, 0.75)))"
    sliced = (
        members.join(sized(sizes), "key").withColumn("slices", F.expr(f"CAST(ceil(size / {width}) AS INT)"))
        .withColumn("slice", F.pmod(F.xxhash64("node"), F.col("slices")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .withColumn("lo", F.least("slice", "other")).withColumn("hi", F.greatest("slice", "other"))
        .drop("size", "slices", "other")
    )
    return sliced.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def each_cell(rows):
    """The record batches of a sorted partition, one for each cell; only one cell is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in rows:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "lo", "hi")])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        bounds = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(bounds, bounds[1:]):
            if held and tuple(keys[:, a]) != last:
                yield _whole(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(keys[:, a])
    if held:
        yield _whole(held)


def _whole(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def sides(cell: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, bool]:
    """The rows of a cell's two slices, and whether it is one slice against itself."""
    lo = cell.column(cell.schema.get_field_index("lo"))[0].as_py()
    hi = cell.column(cell.schema.get_field_index("hi"))[0].as_py()
    slices = cell.column(cell.schema.get_field_index("slice")).to_numpy(zero_copy_only=False)
    return np.flatnonzero(slices == lo), np.flatnonzero(slices == hi), lo == hi
