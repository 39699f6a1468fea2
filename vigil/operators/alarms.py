"""Alarm rules over ordered probabilities. Offline rules name the start of a run, online ones its end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.rules import above as reaches
from vigil.functions.rules import whole_hours
from vigil.operators.slices import position, slice_window, sliced, unsliced
from vigil.schema import HOUR, KEY, LABEL, ORDER, PROBAS_KEPT

# Utility of an alarm by hours from onset, in sixtieths so that sums stay whole numbers.
UNIT = 60
EARLIEST, BEST_FROM, BEST_TO = -12, -6, 3
MISSED, FALSE_ALARM = -120, -3


def utility_units(alarm: Column, onset: Column) -> Column:
    """Utility of a patient in sixtieths; NULL alarm or onset means there is none."""
    dt = alarm - onset
    ramp = UNIT // (BEST_FROM - EARLIEST)
    septic = (
        F.when(alarm.isNull(), MISSED).when(dt < EARLIEST, 0)
        .when(dt <= BEST_FROM, (dt - EARLIEST) * ramp).when(dt <= BEST_TO, UNIT).otherwise(MISSED)
    )
    return F.when(onset.isNotNull(), septic).when(alarm.isNotNull(), FALSE_ALARM).otherwise(0).cast("long")


def patient_outcomes(
    df: DataFrame, is_above: Column, min_consecutive=1, warmup_hours=0, proba="proba", rows_per_slice=None
) -> DataFrame:
    """One row per patient: first alarm, onset (both row positions), rows and highest probability.

    A run of ``k`` ends where the sum over the newest ``k`` rows reaches ``k``; it starts ``k - 1``
    rows before, and must not start within the first ``warmup_hours`` rows.
    """
    k = max(int(min_consecutive), 1)
    kept = [c for c in dict.fromkeys([KEY, *ORDER, LABEL, proba]) if c in df.columns]
    base = sliced(df.select(*kept, is_above.cast("int").alias("_above")), halo=k - 1, rows_per_slice=rows_per_slice)
    w = slice_window()
    run = F.sum("_above").over(w.rowsBetween(1 - k, 0))
    marked = base.withColumns({"_at": position(w), "_run": run}).filter("not _copy")
    start = F.col("_at") - (k - 1)
    aggregates = [
        F.min(F.when((F.col("_run") == k) & (start >= warmup_hours), start)).alias("t_alarm"),
        F.count(F.lit(1)).alias("n_rows"),
    ]
    if LABEL in kept:
        aggregates.append(F.min(F.when(F.col(LABEL) == 1, F.col("_at"))).alias("t_onset"))
    if proba in kept:
        aggregates.append(F.max(proba).alias("max_proba"))
    return marked.groupBy(KEY).agg(*aggregates)


def first_alarm(df, is_above: Column, min_consecutive=1, warmup_hours=0, rows_per_slice=None) -> DataFrame:
    out = patient_outcomes(df, is_above, min_consecutive, warmup_hours, rows_per_slice=rows_per_slice)
    return out.select(KEY, "t_alarm")


def onset_rows(df: DataFrame, rows_per_slice=None) -> DataFrame:
    """Position of each patient's first positive row, NULL when there is none."""
    return patient_outcomes(df, F.lit(False), rows_per_slice=rows_per_slice).select(KEY, "t_onset")


def online_decisions(
    df: DataFrame, threshold=0.05, min_consecutive=6, warmup_hours=0, history=PROBAS_KEPT, rows_per_slice=None
) -> DataFrame:
    """One decision per scored hour: streak of newest probabilities at or over the threshold.

    The streak counts within the newest ``history`` probabilities and goes on counting while alarms
    are muted. Hours without a number or a probability are not scored.
    """
    scored = df.withColumn("iculos_hours", whole_hours()).filter("iculos_hours is not null and proba is not null")
    base = sliced(scored, halo=history - 1, rows_per_slice=rows_per_slice)
    w = slice_window()
    nth = F.row_number().over(w)
    last_below = F.max(F.when(F.col("proba") < threshold, F.col("_nth"))).over(w)
    streak = F.least(F.lit(history), F.col("_nth") - F.coalesce(last_below, F.lit(0)))
    out = base.withColumn("_nth", nth).withColumn("streak", streak)
    muted = F.col("iculos_hours") < warmup_hours
    out = out.withColumns({"muted": muted, "alarm": ~muted & (F.col("streak") >= min_consecutive)})
    return unsliced(out.drop("_nth"))


def alerts(decisions: DataFrame, ts="event_ts") -> DataFrame:
    """One row for every alarming hour, without removing repeats."""
    return decisions.filter("alarm").select(
        F.xxhash64(KEY, HOUR, ts).alias("alert_id"), KEY, F.col(ts).alias("timestamp"), "proba", "iculos_hours",
        F.col("streak").alias("consecutive_above"),
    )


def two_level_alarms(df, warning=0.5, critical=0.7, rows_per_slice=None) -> DataFrame:
    """Critical fires at once; warning needs the hour before to be over the warning level too."""
    base = sliced(df, halo=1, rows_per_slice=rows_per_slice)
    before = F.lag("proba").over(slice_window())
    level = F.when(F.col("proba") >= critical, "critical").when(
        (F.col("proba") >= warning) & (before >= warning), "warning"
    )
    return unsliced(base.withColumn("level", level).withColumn("fired", F.col("level").isNotNull()))
