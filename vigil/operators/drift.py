"""Drift of numeric columns between a reference and a current table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.curves import exact_quantiles, ranged, running_totals
from vigil.schema import VITALS

MAX_DISTANCE, MIN_P = 0.1, 0.05


def shared_columns(reference: DataFrame, current: DataFrame, wanted=VITALS) -> list[str]:
    kept = [c for c in wanted if c in reference.columns and c in current.columns]
    if not kept:
        raise ValueError(f"none of {list(wanted)} is in both tables")
    return kept


def long_values(reference: DataFrame, current: DataFrame, columns) -> DataFrame:
    """(feature, value, is_ref) of all recorded values."""
    def long(df, is_ref):
        cast = df.select(*[F.col(c).cast("double") for c in columns])
        return cast.unpivot([], list(columns), "feature", "value").withColumn("is_ref", F.lit(is_ref))

    return long(reference, 1).unionByName(long(current, 0)).filter("value is not null")


def ks_p_value(d: Column, n: Column, m: Column) -> Column:
    """Asymptotic two-sample p-value."""
    x = F.try_divide(d * d * n * m, n + m)
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(100)), lambda j: F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * x)
    )
    total = F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)
    return F.when(x < 0.04, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def column_distances(reference: DataFrame, current: DataFrame, columns=VITALS) -> DataFrame:
    """Per column: Kolmogorov-Smirnov distance with its p-value, and Wasserstein distance in units of
    the reference's standard deviation. Equal values meet before anything is ordered. A column without recorded
    values on one side keeps its row, with NULL distances."""
    columns = shared_columns(reference, current, columns)
    counts = long_values(reference, current, columns).groupBy("feature", "value").agg(
        F.sum("is_ref").alias("r"), F.sum(1 - F.col("is_ref")).alias("c")
    )
    counts = ranged(counts, "feature", "value")
    ranked = running_totals(
        counts, ["feature"], "_cell", ["value"], {"r": "cum_r", "c": "cum_c"}, totals={"r": "n_ref", "c": "n_cur"}
    )
    gap = F.abs(F.try_divide("cum_r", "n_ref") - F.try_divide("cum_c", "n_cur"))
    inside = Window.partitionBy("feature", "_cell").orderBy("value")
    steps = ranked.withColumn("gap", gap)
    steps = steps.withColumn("width", F.lead("value").over(inside) - F.col("value"))
    cells = steps.groupBy("feature", "_cell").agg(
        F.max("gap").alias("ks"), F.coalesce(F.sum(F.col("gap") * F.col("width")), F.lit(0.0)).alias("area"),
        F.min("value").alias("first"), F.max("value").alias("last"), F.max_by("gap", "value").alias("last_gap"),
        F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"),
    )
    across = Window.partitionBy("feature").orderBy("_cell")
    bridge = F.coalesce(F.col("last_gap") * (F.lead("first").over(across) - F.col("last")), F.lit(0.0))
    per_column = cells.withColumn("bridge", bridge).groupBy("feature").agg(
        F.max("ks").alias("ks"), F.sum(F.col("area") + F.col("bridge")).alias("area"),
        F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"),
    )
    spread = reference.agg(*[F.stddev_pop(c).alias(c) for c in columns]).unpivot([], columns, "feature", "spread")
    out = spread.join(per_column, "feature", "left").fillna(0, ["n_ref", "n_cur"])
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    return out.select(
        "feature", "n_ref", "n_cur", "ks", F.when(both, ks_p_value(F.col("ks"), F.col("n_ref"), F.col("n_cur"))).alias("p_value"),
        F.when(both, F.col("area") / F.greatest("spread", F.lit(0.001))).alias("wasserstein"),
    )


def ks_drift(reference, current, columns=VITALS, alpha: float = MIN_P) -> DataFrame:
    out = column_distances(reference, current, columns).drop("wasserstein")
    return out.withColumn("drifted", F.col("p_value") < alpha)


def drift_columns(reference, current, columns=VITALS, method: str = "wasserstein") -> DataFrame:
    """One test at every size: ``wasserstein`` flags a normed distance of 0.1 and more, ``ks`` a p-value below 0.05.

    ``drifted`` is NULL for a column that cannot be compared.
    """
    tests = {"wasserstein": F.col("wasserstein") >= MAX_DISTANCE, "ks": F.col("p_value") < MIN_P}
    return column_distances(reference, current, columns).withColumn("drifted", tests[method])


def drift_summary(reference, current, columns=VITALS, drift_share=0.5, notify_share=0.3) -> DataFrame:
    flagged = drift_columns(reference, current, columns).agg(
        F.coalesce(F.sum(F.col("drifted").cast("long")), F.lit(0)).alias("n_drifted"), F.count(F.lit(1)).alias("n_columns")
    )
    share = F.col("n_drifted") / F.col("n_columns")
    return flagged.withColumn("share", share).withColumn("dataset_drift", share >= drift_share).withColumn(
        "notify", F.col("dataset_drift") | (share >= notify_share)
    )


def psi(reference, current, columns=VITALS, bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """Population stability index per column over the reference's quantile bins, with its band; NULL for a column
    without recorded values on one side."""
    columns = shared_columns(reference, current, columns)
    values = long_values(reference, current, columns)
    cuts = exact_quantiles(
        values.filter("is_ref = 1"), ["feature"], "value", [i / bins for i in range(1, bins)]
    )
    edges = cuts.groupBy("feature").agg(F.sort_array(F.collect_list("quantile")).alias("edges"))
    binned = values.join(F.broadcast(edges), "feature").groupBy(
        "feature", F.expr("size(filter(edges, e -> value > e))").alias("bin")
    ).agg(F.sum("is_ref").alias("r"), F.sum(1 - F.col("is_ref")).alias("c"))
    whole = Window.partitionBy("feature")  # at most ``bins`` rows
    n_cur, n_ref = F.sum("c").over(whole), F.sum("r").over(whole)
    p, q = F.greatest(F.try_divide("c", n_cur), F.lit(floor)), F.greatest(F.try_divide("r", n_ref), F.lit(floor))
    parts = binned.withColumn("part", F.when((n_cur > 0) & (n_ref > 0), (p - q) * F.log(p / q)))
    named = reference.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("feature"))
    out = named.join(parts.groupBy("feature").agg(F.sum("part").alias("psi")), "feature", "left")
    band = F.when(F.col("psi").isNull(), None).when(F.col("psi") < 0.10, "stable").when(F.col("psi") < 0.25, "moderate").otherwise("severe")
    return out.withColumn("band", band)


def psi_alert(per_column: DataFrame, columns_needed: int = 3) -> DataFrame:
    severe = F.sum((F.col("band") == "severe").cast("long"))
    return per_column.agg(severe.alias("n_severe")).withColumn("notify", F.col("n_severe") >= columns_needed)
