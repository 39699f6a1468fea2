"""Evaluation aggregates: utility, confusion, lead time, calibration, subgroups, counters, telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.rules import above, check_records, flag
from vigil.operators import curves
from vigil.operators.alarms import MISSED, UNIT, patient_outcomes, utility_units
from vigil.schema import HOUR, LABEL


def count_where(condition: Column) -> Column:
    return F.coalesce(F.sum(flag(condition)), F.lit(0))


def patient_utility(outcomes: DataFrame) -> DataFrame:
    units = utility_units(F.col("t_alarm"), F.col("t_onset"))
    return outcomes.withColumn("_units", units).withColumn("utility", F.col("_units") / UNIT)


def _utility_sums(outcomes: DataFrame, more=()) -> DataFrame:
    alarm, septic = F.col("t_alarm").isNotNull(), F.col("t_onset").isNotNull()
    sums = patient_utility(outcomes).agg(
        (F.coalesce(F.sum("_units"), F.lit(0)) / UNIT).alias("raw_utility"),
        count_where(septic).cast("double").alias("max_utility"),
        count_where(septic & alarm).alias("tp"), count_where(septic & ~alarm).alias("fn"),
        count_where(~septic & alarm).alias("fp"), count_where(~septic & ~alarm).alias("tn"), *more,
    )
    return sums.withColumn("normalized_utility", _ratio("raw_utility", "max_utility"))


def normalized_utility(outcomes: DataFrame) -> DataFrame:
    """Sum of utilities over the best possible sum, 0 without septic patients; patients by outcome.

    Any alarm on a septic patient counts as a true positive, whatever its timing.
    """
    return _utility_sums(outcomes)


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) != 0, F.col(a) / F.col(b)).otherwise(0.0)


def utility_official(outcomes: DataFrame) -> DataFrame:
    """Utility rescaled so that never alarming scores 0 and the best possible alarms score 1."""
    septic = F.col("t_onset").isNotNull()
    sums = patient_utility(outcomes).agg(
        (F.sum("_units") / UNIT).alias("observed"),
        (F.sum(flag(septic) * MISSED) / UNIT).alias("inaction"),
        F.sum(flag(septic)).cast("double").alias("perfect"),
    )
    span = F.col("perfect") - F.col("inaction")
    return sums.withColumn("normalized", F.when(span != 0, (F.col("observed") - F.col("inaction")) / span).otherwise(0.0))


def _ahead() -> Column:
    return F.when(F.col("t_alarm") <= F.col("t_onset"), F.col("t_onset") - F.col("t_alarm"))


def per_patient_results(outcomes: DataFrame) -> DataFrame:
    return outcomes.select(
        "patient_id", F.col("t_onset").isNotNull().alias("is_sepsis"), F.col("t_alarm").isNotNull().alias("has_alarm"),
        "t_onset", "t_alarm", _ahead().alias("alert_ahead_h"), "max_proba",
    )


def _lead_aggregates():
    """Leads are whole hours, so the exact median needs one counter per hour of the longest stay."""
    return [
        F.avg("alert_ahead_h").alias("alert_ahead_mean_h"), F.count("alert_ahead_h").alias("alert_ahead_n_patients"),
        F.percentile("alert_ahead_h", F.lit(0.5)).alias("alert_ahead_median_h"),
    ]


def lead_times(results: DataFrame) -> DataFrame:
    """Mean, exact median and number of patients whose alarm came in time."""
    return results.agg(*_lead_aggregates())


def confusion(df: DataFrame, threshold: float, score="proba", label=LABEL) -> DataFrame:
    """Hour-level confusion cells at the raw threshold, without any alarm rule."""
    hit, positive = F.col(score) >= threshold, F.col(label) == 1
    return df.agg(
        count_where(~hit & ~positive).alias("tn"), count_where(hit & ~positive).alias("fp"),
        count_where(~hit & positive).alias("fn"), count_where(hit & positive).alias("tp"),
    )


def evaluation_summary(df: DataFrame, threshold, min_consecutive, warmup_hours, specificity=0.95) -> DataFrame:
    """One row with every test metric of a scored table: one pass over the patients' series, one over
    the distinct scores."""
    outcomes = patient_outcomes(df, above("proba", threshold), min_consecutive, warmup_hours)
    row = _utility_sums(outcomes.withColumn("alert_ahead_h", _ahead()), _lead_aggregates())

    steps = curves.score_steps(df)
    tpr, hit = F.try_divide("tp", "p"), F.col("threshold") >= threshold
    enough = 1 - F.try_divide("fp", "n") >= specificity
    curve = steps.agg(
        curves.auroc_of_steps().alias("auroc"), curves.average_precision_of_steps().alias("auprc"),
        F.max(F.when(enough, F.struct(tpr.alias("tpr"), "threshold"))).alias("best"),
        F.sum(F.when(hit, 0).otherwise(F.col("neg"))).alias("cm_tn"), F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("cm_fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("cm_fn"), F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("cm_tp"),
    )
    names = ["auroc", "auprc", "cm_tn", "cm_fp", "cm_fn", "cm_tp"]
    row = row.withColumn("c", curve.select(F.struct("*")).scalar())
    return row.select(
        *[c for c in row.columns if c != "c"], *[F.col(f"c.{n}").alias(n) for n in names],
        F.coalesce("c.best.tpr", F.lit(0.0)).alias("sensitivity_at_spec"),
        F.coalesce("c.best.threshold", F.lit(float("inf"))).alias("threshold_at_spec"),
        F.lit(float(threshold)).alias("threshold"), F.lit(int(min_consecutive)).alias("min_consecutive"),
        F.lit(int(warmup_hours)).alias("warmup_hours"),
    )


def metric_gate(summary: DataFrame, utility=0.35, auroc=0.80, sensitivity=0.40) -> DataFrame:
    """Whether a model may be promoted, per requirement and in all."""
    checks = {
        "utility_ok": F.col("normalized_utility") >= utility,
        "auroc_ok": F.col("auroc") >= auroc,
        "sensitivity_ok": F.col("sensitivity_at_spec") >= sensitivity,
    }
    out = summary.select("normalized_utility", "auroc", "sensitivity_at_spec", *[c.alias(n) for n, c in checks.items()])
    return out.withColumn("promote", F.expr(" and ".join(checks)))


def brier(df: DataFrame, score="proba", label=LABEL) -> DataFrame:
    return df.agg(F.avg((F.col(score) - F.col(label)) * (F.col(score) - F.col(label))).alias("brier"))


def reliability_bins(df: DataFrame, bins: int = 10, score="proba", label=LABEL) -> DataFrame:
    """Mean probability against share of positives in equal-width probability bins."""
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.filter(F.col(score).isNotNull()).groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_proba"), F.avg(label).alias("observed"),
    )


def subgroup_metrics(df: DataFrame, threshold: float) -> DataFrame:
    """Sensitivity and specificity by age band, gender, unit and time in care, with the gap per attribute."""
    age = F.when(F.col("Age") < 50, "<50").when(F.col("Age") <= 70, "50-70").otherwise(">70")
    groups = {
        "age": age,
        "gender": F.when(F.col("Gender") == 1, "1").otherwise("0"),
        "unit": F.when(F.col("Unit1") == 1, "1").when(F.col("Unit2") == 1, "2").otherwise("none"),
        "time": F.when(F.col(HOUR) < 24, "early").otherwise("late"),
    }
    hit, positive = F.col("proba") >= threshold, F.col(LABEL) == 1
    # All attribute values first meet in one small aggregate, then each attribute sums over it.
    cube = df.groupBy(*[c.alias(n) for n, c in groups.items()]).agg(
        count_where(hit & positive).alias("tp"), count_where(~hit & positive).alias("fn"),
        count_where(hit & ~positive).alias("fp"), count_where(~hit & ~positive).alias("tn"),
    )
    pairs = F.array(*[F.struct(F.lit(n).alias("attribute"), F.col(n).alias("value")) for n in groups])
    sums = cube.withColumn("_pair", F.explode(pairs)).groupBy("_pair.attribute", "_pair.value").agg(
        *[F.sum(c).alias(c) for c in ("tp", "fn", "fp", "tn")]
    )
    return sums.withColumns(
        {
            "sensitivity": F.try_divide("tp", F.col("tp") + F.col("fn")),
            "specificity": F.try_divide("tn", F.col("tn") + F.col("fp")),
        }
    )


def subgroup_gaps(groups: DataFrame, allowed: float = 0.15) -> DataFrame:
    gap = F.max("sensitivity") - F.min("sensitivity")
    out = groups.groupBy("attribute").agg(gap.alias("sensitivity_gap"))
    return out.withColumn("passed", F.col("sensitivity_gap") <= allowed)


def record_counters(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """What a run over arriving records would have counted.

    ``records`` is everything that arrived; ``decisions`` holds a row per scored hour.
    """
    valid = F.col("is_valid")
    counted = check_records(records).agg(
        count_where(valid).alias("processed"), count_where(~valid).alias("invalid"),
        count_where(valid & F.col(HOUR).isNotNull() & F.col("proba").isNull()).alias("predict_errors"),
    )
    scored = decisions.agg(F.count(F.lit(1)).alias("predicted"), count_where(F.col("alarm")).alias("alarms"))
    both = counted.withColumn("d", scored.select(F.struct("*")).scalar())
    return both.select("processed", "invalid", F.col("d.predicted"), F.col("d.alarms"), "predict_errors")


# Upper limits of the latency histogram, in milliseconds.
LATENCY_LIMITS = (5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000)


def event_rate(requests: DataFrame, width="1 minute", by=("handler",)) -> DataFrame:
    """Requests per second in each window."""
    seconds = F.window("ts", width)
    counted = requests.groupBy(seconds.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))
    length = F.timestamp_diff("SECOND", F.col("w.start"), F.col("w.end"))
    return counted.select(F.col("w.start").alias("window_start"), *by, "n", (F.col("n") / length).alias("per_second"))


def error_rate(requests: DataFrame, width="5 minutes") -> DataFrame:
    bad = F.col("status") >= 400
    counted = requests.groupBy(F.window("ts", width).alias("w")).agg(
        F.count(F.lit(1)).alias("n"), count_where(bad).alias("n_errors")
    )
    length = F.timestamp_diff("SECOND", F.col("w.start"), F.col("w.end"))
    return counted.select(
        F.col("w.start").alias("window_start"), "n", "n_errors", (F.col("n_errors") / length).alias("errors_per_second"),
        (F.col("n_errors") / F.col("n")).alias("error_share"),
    )


def status_counts(requests: DataFrame) -> DataFrame:
    return requests.groupBy("handler", "status").agg(F.count(F.lit(1)).alias("n"))


def latency_histogram(requests: DataFrame, width="5 minutes", by=(), limits=LATENCY_LIMITS) -> DataFrame:
    """Cumulative request counts per window and upper limit; the open last bucket has ``le`` infinity."""
    edges = [*[float(x) for x in limits], float("inf")]
    counted = requests.groupBy(F.window("ts", width).alias("w"), *by).agg(
        *[count_where(F.col("latency_ms") <= e).alias(f"_b{i}") for i, e in enumerate(edges)]
    )
    buckets = F.array(
        *[F.struct(F.lit(i).alias("bucket"), F.lit(e).alias("le"), F.col(f"_b{i}").alias("n")) for i, e in enumerate(edges)]
    )
    return counted.select(F.col("w.start").alias("window_start"), *by, F.inline(buckets))


def histogram_quantile(histogram: DataFrame, q: float = 0.95, by=()) -> DataFrame:
    """Quantile read from a cumulative histogram, linear within the bucket; the open bucket gives the
    last finite limit."""
    key = ["window_start", *by]
    rows = F.array_sort(F.collect_list(F.struct("bucket", "le", "n")))
    per_window = histogram.groupBy(*key).agg(rows.alias("b"))
    rank = q * F.element_at("b", -1)["n"]
    hit = F.filter("b", lambda x: x["n"] >= rank)[0]
    below = F.filter("b", lambda x: x["n"] < rank)
    prior = F.when(F.size(below) > 0, F.element_at(below, -1))
    start, seen = F.coalesce(prior["le"], F.lit(0.0)), F.coalesce(prior["n"], F.lit(0))
    inside = start + (hit["le"] - start) * (rank - seen) / (hit["n"] - seen)
    value = F.when(hit["le"] == float("inf"), F.element_at("b", -2)["le"]).otherwise(inside)
    return per_window.filter(F.element_at("b", -1)["n"] > 0).select(*key, value.alias("latency_ms"))
