"""Label work: relabelling late hours, patient splits, class weights, leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.curves import running_totals
from vigil.operators.slices import join_per_key
from vigil.schema import HOUR, KEY, LABEL

ONSET_OFFSET = 6


def relabel_late(df: DataFrame, late_cutoff: int = 3, split: str | None = None, rows_per_slice=None) -> DataFrame:
    """Positive hours later than onset + ``late_cutoff`` become 0; onset is 6 h after the first positive."""
    if split == "test":
        raise ValueError("test labels are frozen: only the train part may be relabelled")
    first = df.filter(F.col(LABEL) == 1).groupBy(KEY).agg(F.min(HOUR).alias("_first"))
    late = (F.col(LABEL) == 1) & (F.col(HOUR) > F.col("_first") + ONSET_OFFSET + late_cutoff)
    return (
        join_per_key(df, first, how="left", rows_per_slice=rows_per_slice)
        .withColumn("relabelled", F.coalesce(late, F.lit(False)))
        .withColumn(LABEL, F.when(F.col("relabelled"), 0).otherwise(F.col(LABEL)))
        .drop("_first")
    )


def relabel_stats(relabelled: DataFrame) -> DataFrame:
    per_patient = relabelled.filter("relabelled").groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
    return per_patient.agg(
        F.count(F.lit(1)).alias("patients_modified"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows_flipped")
    )


def patient_split(df: DataFrame, seed: int = 42, train: float = 0.70, val: float = 0.15) -> DataFrame:
    """Patients in seeded hash order: the first 70 % train, the next 15 % val, the rest test.

    Ranks come from sizes of hash ranges plus a rank within each range, so no task sees all patients.
    """
    ids = df.select(KEY).filter(F.col(KEY).isNotNull()).distinct()
    draw = F.md5(F.concat(F.lit(f"{seed}|"), F.col(KEY)))
    ids = ids.withColumn("_draw", draw).withColumn("_cell", F.conv(F.substring("_draw", 1, 4), 16, 10).cast("long"))
    ids = ids.withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(ids, [], "_cell", ["_draw", KEY], {"_one": "_rank"}, totals={"_one": "_n"})
    n_train = F.floor(F.col("_n") * train)
    n_val = F.floor(F.col("_n") * val)
    return ranked.select(
        KEY,
        F.when(F.col("_rank") <= n_train, "train").when(F.col("_rank") <= n_train + n_val, "val")
        .otherwise("test").alias("split"),
    )


def patient_split_by_hash(df: DataFrame, seed: int = 42, train: float = 0.70, val: float = 0.15) -> DataFrame:
    """Shares kept on average only, but each row decides alone: no shuffle at all."""
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col(KEY)), F.lit(1_000_000)) / 1_000_000
    return df.withColumn("split", F.when(draw < train, "train").when(draw < train + val, "val").otherwise("test"))


def split_stats(df: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows, patients and share of positives per split; rows are summed per patient before the join."""
    per_patient = df.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"), F.sum(LABEL).alias("pos"))
    return per_patient.join(splits, KEY).groupBy("split").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_patients"),
        (100.0 * F.sum("pos") / F.sum("n")).alias("positive_pct"),
    )


def leakage(left: DataFrame, right: DataFrame) -> DataFrame:
    """How many patients two splits share, and whether that is none."""
    shared = left.select(KEY).intersect(right.select(KEY))
    return shared.agg(F.count(F.lit(1)).alias("shared")).withColumn("passed", F.col("shared") == 0)


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights: rows / (classes x rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    share = counts.agg(F.sum("n") / F.count(F.lit(1))).scalar()
    return counts.select(label, "n", (share / F.col("n")).alias("weight"))
