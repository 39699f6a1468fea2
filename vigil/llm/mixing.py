"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks; DataFrame operations only.

The documents of a source lie on a line in seeded order. The line is cut into blocks of ``block_words`` words. Targets
decide how many blocks each source may place (highest quotients ``target / (2k + 1)``). The blocks taken are a run of the
seeded line that starts at a seeded block; they are dealt to the shards in turn, so every shard's quota is a whole number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUCKET_DIGITS = 3  # hex digits: 4,096 stretches of each source's line


def _overlap(start: str, end: str) -> str:
    return f"greatest(0L, least(at + size, {end}) - greatest(at, {start}))"


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``target`` for each row of (no_source, source_key, source_size).

    Weights go round by code point of the source, null last; ``share`` of all sizes is split by them, and what would
    exceed ``cap`` times a source's size is shared again among the others. The level at which that ends is found
    from running sums, sources ordered by how soon they fill up, so there is one row per source and no loop.
    """
    named = Window.orderBy("no_source", "source_key")
    filled = Window.orderBy("fills", "nth")
    picks = ", ".join(map(str, weights))
    ranked = (
        sources.withColumn("nth", F.row_number().over(named) - 1)
        .withColumn("weight", F.expr(f"CAST(element_at(array({picks}), CAST(nth % {len(weights)} + 1 AS INT)) AS DOUBLE)"))
        .withColumn("most", F.expr(f"{cap}D * source_size"))
        .withColumn("fills", F.expr("most / weight"))
        .withColumn("wanted", F.expr(f"{share}D * sum(source_size) OVER ()"))
        .withColumn("most_before", F.sum("most").over(filled) - F.col("most"))
        .withColumn("weight_from", F.expr("sum(weight) OVER ()") - F.sum("weight").over(filled) + F.col("weight"))
        .withColumn("level", F.expr("(wanted - most_before) / weight_from"))
        .withColumn("level", F.expr("min_by(level, if(level <= fills, struct(fills, nth), NULL)) OVER ()"))
    )
    return ranked.withColumn("target", F.expr("if(level IS NULL, most, least(most, level * weight))"))


def quotas(sources: DataFrame, block_words: int, shards: int) -> DataFrame:
    """Blocks per source: ``blocks`` it has, ``quota`` it places, ``first_shard`` where its odd blocks begin.

    Highest quotients without listing every seat: all seats whose quotient is surely high enough are granted at once,
    the few left (two per source at most, besides the margin) are ranked.
    """
    seats = sources.withColumn("seats", F.expr(f"CAST(round(wanted / {block_words}) AS BIGINT)")).withColumn(
        "of", F.expr("count(*) OVER ()")
    )
    sure = seats.withColumn(
        "granted", F.expr("greatest(0L, CAST(coalesce(try_divide(target * (2 * seats - of), wanted), 0D) AS BIGINT) div 2 - 1)")
    ).withColumn("left", F.expr("seats - sum(granted) OVER ()"))
    near = (
        sure.filter("target > 0")
        .withColumn("k", F.expr("explode(sequence(granted, greatest(granted, CAST(target * (2 * seats + of) / wanted AS BIGINT) div 2 + 2)))"))
        .withColumn("rank", F.row_number().over(Window.orderBy(F.expr("target / (2 * k + 1)").desc(), "nth", "k")))
        .filter("rank <= left").groupBy("nth").agg(F.count("*").alias("more"))
    )
    turn = Window.orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sure.join(near, "nth", "left")
        .withColumn("blocks", F.expr(f"CAST(ceil(source_size / {block_words}) AS BIGINT)"))
        .withColumn("quota", F.expr("least(granted + coalesce(more, 0L), 2 * blocks)"))
        .withColumn("first_shard", F.coalesce(F.sum(F.expr(f"quota % {shards}")).over(turn), F.lit(0)) % shards)
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0,
    block_words: int = 16, shards: int = 16, seed: str = "mix",
) -> DataFrame:
    """What the mix takes of every row of ``docs`` (doc_id, text, source; other columns are not read).

    Returns doc_id, size (words), source_size, target, taken (words, repeats counted), copies (times the whole document
    is nearest to), shard (of its first block, null when nothing is taken).

    Null or blank text has size 0 and nothing is taken of it. A null source is a source of its own, last in order.
    Repeated rows are separate documents; equal ones may differ in ``taken``, but not from run to run as a multiset.
    An empty table gives an empty result. A source's taken words differ from its target by a few blocks at most.
    Needs one row per source in one task for the ranking; documents are never gathered by source.
    """
    base = written(
        docs.select(
            "doc_id", F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("source_key"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("place"),
        ).withColumn("stretch", F.expr(f"substr(place, 1, {BUCKET_DIGITS})")),
        "mix",
    )
    source = ("no_source", "source_key")
    stretches = base.groupBy(*source, "stretch").agg(F.sum("size").alias("stretch_size"))
    sized = stretches.groupBy(*source).agg(F.sum("stretch_size").alias("source_size"))
    plan = quotas(targets(sized, weights, share, cap), block_words, shards).select(
        *source, "source_size", "target", "blocks", "quota", "first_shard",
        F.expr("CAST(floor(coalesce(try_divide(quota, blocks), 0D)) AS BIGINT)").alias("rounds"), F.expr("coalesce(try_mod(quota, blocks), 0L)").alias("odd"),
        F.expr(f"coalesce(try_mod(CAST(conv(substr(md5(concat('{seed}', source_key)), 1, 8), 16, 10) AS BIGINT), blocks), 0L)").alias("first"),
    )
    along = Window.partitionBy(*source).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.withColumn("start", F.coalesce(F.sum("stretch_size").over(along), F.lit(0))).join(plan, list(source))
    before = Window.partitionBy(*source, "stretch").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    wrapped = f"greatest(0L, first + odd - blocks) * {block_words}"
    placed = (
        base.join(starts, [*source, "stretch"])
        .withColumn("at", F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0)))
        .withColumn("taken", F.expr(
            f"rounds * size + {_overlap(f'first * {block_words}', f'least((first + odd) * {block_words}, source_size)')}"
            f" + {_overlap('0L', wrapped)}"
        ))
        .withColumn("nth", F.expr(f"pmod(at div {block_words} - first, blocks)"))
    )
    return placed.select(
        "doc_id", "size", "source_size", "target", "taken",
        F.expr("if(size = 0, 0L, (2 * taken + size) div (2 * size))").alias("copies"),
        F.expr(f"if(taken > 0, CAST((first_shard + nth) % {shards} AS INT), NULL)").alias("shard"),
    )
