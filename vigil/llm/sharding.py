"""Sharding by vector bin packing: groups of equal texts go where the dot product with the residual capacity is highest.

Placing one group after the other cannot be done for billions of groups, so what is placed is a bounded list of items:
every group that is large against a shard, and ``BINS`` bins of all other groups by hash. An item is a vector of bytes,
tokens and rows. Only this list (at most ``BINS`` bins and ``3 * BINS`` large groups with their pieces) reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import written

WORD = r"[^\x20\x09-\x0D]+"
BINS = 4096  # bins of small groups; a group above a 4,096th of the bytes, tokens or rows is placed by itself
CELLS = 256  # parts of an item that are numbered side by side
LAWS = {"bytes": (1.0, 0.05, 0.05), "rows": (0.05, 0.05, 1.0)}


def pack(sizes: np.ndarray, shards: int, weights: tuple[float, float, float]) -> np.ndarray:
    """The shard of each item (rows of ``sizes``: bytes, tokens, rows), largest first.

    An item goes where the dot product of its vector with what is left of the shard's capacity is highest; ``weights``
    say how much each dimension counts. Ties go to the lowest shard.
    """
    share = sizes / np.maximum(sizes.sum(0), 1) * shards
    weighted = share * np.asarray(weights)
    left = np.ones((shards, share.shape[1]))
    placed = np.zeros(len(sizes), dtype=np.int32)
    for i in np.argsort(-weighted.sum(1), kind="stable"):
        placed[i] = np.argmax(left @ weighted[i])
        left[placed[i]] -= share[i]
    return placed


def shard(docs: DataFrame, shards: int = 16, law: str = "bytes") -> DataFrame:
    """A shard and a slot for every row of ``docs`` (doc_id, text; other columns are not read).

    Returns doc_id, size (UTF-8 bytes and 1), tokens (words), text_crc32, law, shard, slot (0, 1, ... in each shard),
    grown_shard (null: the laws here place by size, not by key).

    Equal texts share a shard, but for a group larger than a whole shard (in bytes, or in rows under law ``rows``): it is
    cut by hash of doc_id and a row number into pieces of a quarter of a shard, or sizes could not come out even; rows
    of one doc_id, or of none, spread over the pieces like any others. A null text has no bytes, no tokens and the checksum of the
    empty text, with which it is grouped. Repeated rows get slots of their own. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    base = written(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("tokens"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text, F.octet_length(text)).alias("group"),
            # by a row number written with the rows, so that rows of a tied or null doc_id spread like any others
            F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(1 << 32)).alias("spread"),
        ),
        "shard",
    )
    sums = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = base.agg(*sums).first()
    if not total["rows"]:
        total = {"bytes": 0, "tokens": 0, "rows": 0}
    large = " OR ".join(f"{k} > {max(1, total[k] or 0) / BINS}" for k in ("bytes", "tokens", "rows"))
    weighed = "rows" if law == "rows" else "bytes"  # a group is cut by the dimension that the law evens out
    whole = max(1, total[weighed]) / shards
    # At most BINS groups can exceed a 4,096th of a dimension: the list is bounded whatever the table holds.
    heavy = base.groupBy("group").agg(*sums).filter(large).select(
        "group", F.when(F.col(weighed) > whole, F.ceil(F.col(weighed) / whole * 4)).otherwise(1).cast("bigint").alias("pieces")
    )
    items = written(
        base.join(F.broadcast(heavy), "group", "left")
        .withColumn("key", F.when(F.col("pieces").isNull(), F.pmod("group", F.lit(BINS))).otherwise(F.col("group")))
        .withColumn("piece", F.when(F.col("pieces").isNull(), F.lit(-1)).otherwise((F.col("spread") * F.col("pieces")) / (1 << 32)).cast("int"))
        .withColumn("cell", F.pmod("spread", F.lit(CELLS)).cast("int"))
        .select("doc_id", "size", "tokens", "text_crc32", "key", "piece", "cell"),
        "shard",
    )
    found = items.groupBy("key", "piece").agg(*sums).orderBy("key", "piece").collect()
    sizes = np.array([[r["bytes"], r["tokens"], r["rows"]] for r in found], dtype=np.float64).reshape(-1, 3)
    placed = pack(sizes, shards, LAWS[law])
    filled, starts = np.zeros(shards, dtype=np.int64), []
    for r, s in zip(found, placed):
        starts.append((r["key"], r["piece"], int(s), int(filled[s])))
        filled[s] += r["rows"]
    schema = T.StructType([
        T.StructField("key", T.LongType()), T.StructField("piece", T.IntegerType()),
        T.StructField("shard", T.IntegerType()), T.StructField("item_start", T.LongType()),
    ])
    where = F.broadcast(spark.createDataFrame(starts, schema))
    part = ("key", "piece", "cell")
    cells = items.groupBy(*part).agg(F.count("*").alias("n")).join(where, ["key", "piece"])
    earlier = Window.partitionBy("key", "piece").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*part, "shard", (F.col("item_start") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("start"))
    inside = Window.partitionBy(*part).orderBy("doc_id", "text_crc32", "size")
    return items.join(cells, list(part)).select(
        "doc_id", "size", "tokens", "text_crc32", F.lit(law).alias("law"), "shard",
        (F.col("start") + F.row_number().over(inside) - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
