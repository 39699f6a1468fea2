"""Joining and uniting tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.slices import join_per_key
from vigil.schema import HOUR, KEY


def join_scores(first: DataFrame, second: DataFrame, name="second_proba") -> DataFrame:
    """Hours scored by both learners."""
    return first.join(second.select(KEY, HOUR, F.col("proba").alias(name)), [KEY, HOUR])


def join_audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows on each side, rows joined, and whether all three agree."""
    def per_hour(df, name):
        return df.groupBy(KEY, HOUR).agg(F.count(F.lit(1)).alias(name))

    pairs = per_hour(first, "a").join(per_hour(second, "b"), [KEY, HOUR], "full_outer").fillna(0, ["a", "b"])
    out = pairs.agg(
        F.sum("a").alias("n_first"), F.sum("b").alias("n_second"), F.sum(F.col("a") * F.col("b")).alias("n_joined")
    )
    agree = (F.col("n_first") == F.col("n_joined")) & (F.col("n_second") == F.col("n_joined"))
    return out.withColumn("complete", agree)


def keep_patients(df: DataFrame, ids: DataFrame, rows_per_slice=None) -> DataFrame:
    """Rows of the patients in ``ids``."""
    return join_per_key(df, ids.select(KEY), how="left_semi", rows_per_slice=rows_per_slice)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def seeded_sample(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Exactly ``n`` rows by seeded hash order of the key, the same on every run; 0 keeps all."""
    if n == 0:
        return df
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))), key).limit(n)
