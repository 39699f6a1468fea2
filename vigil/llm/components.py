"""Connected components of a table of links, by alternating large-star and small-star steps.

Every step reads and writes tables in the shared folder, so executors may be lost at any time. Minima are aggregated on
the map side and joined from a written table, so a node with very many links is split by skew join handling.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.session import written

BROADCAST_ROWS = 500_000  # tables of up to so many short rows may be broadcast; larger ones are joined by shuffle


def sized(df: DataFrame) -> DataFrame:
    """The written table, marked for broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for the nodes of some links that are not the smallest themselves."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = places[:len(a)], places[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


def _contract(rows):
    for batch in rows:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        u, v = forest(a, b)
        yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _stars(edges: DataFrame) -> bool:
    """Whether every node that is not a root has one edge, to a smaller root without edges of its own."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    roles = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return roles.filter("out > 1 OR out = 1 AND into = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (two columns of whole numbers); label is its component's smallest node.

    Links of a node with itself, repeated ones and either direction are fine. A node without links gets no row.
    """
    a, b = links.columns
    loose = links.select(F.col(a).cast("bigint").alias("u"), F.col(b).cast("bigint").alias("v")).filter("u <> v")
    edges = written(loose.mapInArrow(_contract, "u long, v long").distinct(), "components")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components")
        large = written(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "components")
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "components")
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return written(edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots), "components")
