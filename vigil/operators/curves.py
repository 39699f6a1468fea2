"""Order statistics over a whole table without sorting it in one task.

Values fall into cells that follow their order. Totals per cell are few, so their running sum is
cheap; each cell then sorts only its own rows and starts from that sum. Results are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import written

CELLS_PER_PARTITION = 4  # cells for each shuffle partition of the session


def ranged(df: DataFrame, *order: str) -> DataFrame:
    """Add ``_cell``: the stretch of the order a row is in. Its edges are sampled from the data, so cells hold about
    equally many rows however the values lie. The rows are written, so that every later step sees the same cells."""
    cells = CELLS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(cells, *order).withColumn("_cell", F.spark_partition_id().cast("long")), "cells")


def running_totals(df, keys, cell_col, order, sums: dict[str, str], descending=False, totals=None) -> DataFrame:
    """Add ``sums[c]``: total of column ``c`` over all rows up to this one, per key, in order; and
    ``totals[c]``: its total over the whole key.

    ``cell_col`` must follow the first order column.
    """
    totals = totals or {}
    per_cell = df.groupBy(*keys, cell_col).agg(*[F.sum(c).alias(f"_sum_{c}") for c in {**sums, **totals}])
    turn = F.desc if descending else F.asc
    before = Window.partitionBy(*keys).orderBy(turn(cell_col)).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    starts = per_cell.select(
        *keys, cell_col,
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_from_{c}") for c in sums],
        *[F.sum(f"_sum_{c}").over(whole).alias(name) for c, name in totals.items()],
    )
    inside = Window.partitionBy(*keys, cell_col).orderBy(*[turn(c) for c in order])
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = df.join(starts, [*keys, cell_col])
    out = out.withColumns({name: F.col(f"_from_{c}") + F.sum(c).over(inside) for c, name in sums.items()})
    return out.drop(*[f"_from_{c}" for c in sums])


def score_steps(df: DataFrame, score="proba", label="SepsisLabel", keys=()) -> DataFrame:
    """One row per distinct score, highest first in meaning: its positives and negatives and how many
    reach it (``tp``, ``fp``), with the table totals (``p``, ``n``). With ``keys``, a table for each key."""
    points = df.filter(F.col(score).isNotNull()).groupBy(*keys, F.col(score).alias("threshold")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg"),
    )
    points = ranged(points, *keys, "threshold")
    steps = running_totals(
        points, list(keys), "_cell", ["threshold"], {"pos": "tp", "neg": "fp"}, descending=True, totals={"pos": "p", "neg": "n"}
    )
    return steps.drop("_cell")


def roc_curve(steps: DataFrame) -> DataFrame:
    """Every point of the curve, from the origin (threshold infinity) to (1, 1); NULL rates of a class without rows."""
    points = steps.select("threshold", F.try_divide("fp", "n").alias("fpr"), F.try_divide("tp", "p").alias("tpr"))
    origin = steps.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def pr_curve(steps: DataFrame) -> DataFrame:
    """Precision and recall at each score, closed by the point (1, 0) that has no threshold."""
    points = steps.select(
        "threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "p").alias("recall"),
    )
    end = steps.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(end)


def auroc_of_steps() -> Column:
    ranked_right = F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2)
    return F.try_divide(F.sum(ranked_right), F.max("p").cast("double") * F.max("n"))


def auroc(steps: DataFrame) -> DataFrame:
    """Share of positive-negative pairs ranked right, ties counting half; NULL when a class has no rows."""
    return steps.agg(auroc_of_steps().alias("auroc"))


def average_precision_of_steps() -> Column:
    return F.sum(F.try_divide("pos", "p") * (F.col("tp") / (F.col("tp") + F.col("fp"))))


def average_precision(steps: DataFrame) -> DataFrame:
    """Sum of recall steps times the precision there (steps, not trapezoids)."""
    return steps.agg(average_precision_of_steps().alias("average_precision"))


def sensitivity_at_specificity(steps: DataFrame, specificity: float = 0.95) -> DataFrame:
    """Best sensitivity whose specificity is enough, with the highest threshold that reaches it."""
    fit = roc_curve(steps).filter(1 - F.col("fpr") >= specificity)
    return fit.orderBy(F.desc("tpr"), F.desc("threshold")).limit(1).select(
        F.col("tpr").alias("sensitivity"), "threshold"
    )


def exact_quantiles(df: DataFrame, keys, value, quantiles) -> DataFrame:
    """Linear-interpolated quantiles per key, one row per (key, q)."""
    keys = list(keys)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    counts = ranged(counts, *keys, "_v")
    ranked = running_totals(counts, keys, "_cell", ["_v"], {"_n": "_upto"}, totals={"_n": "_total"})
    # A value holds ranks [_upto - _n, _upto); a quantile needs those at floor and ceil of (total - 1) q.
    first = F.col("_upto") - F.col("_n")

    def held(rank):
        return (rank >= first) & (rank < F.col("_upto"))

    def rank_of(q):
        return (F.col("_total") - 1) * q

    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    near = ranked.withColumn(
        "q", F.explode(F.filter(asked, lambda q: held(F.floor(rank_of(q))) | held(F.ceil(rank_of(q)))))
    ).withColumn("_rank", rank_of(F.col("q")))
    holds = {"_low": held(F.floor("_rank")), "_high": held(F.ceil("_rank"))}
    ends = near.groupBy(*keys, "q", "_rank").agg(
        *[F.max(F.when(cond, F.col("_v"))).alias(name) for name, cond in holds.items()]
    )
    part = F.col("_rank") - F.floor("_rank")
    return ends.select(*keys, "q", (F.col("_low") + (F.col("_high") - F.col("_low")) * part).alias("quantile"))
