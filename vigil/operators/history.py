"""Bounded histories and latest states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.rules import finite, whole_hours
from vigil.operators.slices import last_rows
from vigil.schema import HOUR, KEY, ORDER, PREDICTIONS_KEPT, PROBAS_KEPT, VITALS, VITALS_KEPT

STORED_VITALS = tuple(v for v in VITALS if v != "EtCO2")


def latest(df: DataFrame, order=ORDER) -> DataFrame:
    """Whole newest row per patient; combined on the map side."""
    newest = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(KEY).agg(newest.alias("_row")).select("_row.*")


def vitals_history(df: DataFrame, hours: int = 72, ts="event_ts") -> DataFrame:
    """The newest ``hours`` (1 to 168) stored vitals per patient."""
    if not 1 <= hours <= VITALS_KEPT:
        raise ValueError(f"hours must be between 1 and {VITALS_KEPT}")
    lean = df.select(*dict.fromkeys([KEY, *ORDER, ts, *STORED_VITALS]))
    kept = last_rows(lean, hours)
    return kept.select(
        KEY, F.col(ts).alias("timestamp"), F.coalesce(whole_hours(HOUR), F.lit(0)).alias("iculos_hours"),
        *[finite(v).alias(v.lower()) for v in STORED_VITALS],
    )


def chart_vitals(history: DataFrame) -> DataFrame:
    return history.select(KEY, "timestamp", "hr", "o2sat", "resp", "map")


def chart_temperature(history: DataFrame) -> DataFrame:
    return history.filter("temp is not null").select(KEY, "timestamp", "temp")


def proba_window(scores: DataFrame) -> DataFrame:
    """The newest 48 probabilities per patient, the memory of the alarm rule."""
    return last_rows(scores.select(KEY, *ORDER, "proba"), PROBAS_KEPT)


def prediction_log(decisions: DataFrame, ts="event_ts") -> DataFrame:
    """The newest 24 decisions per patient."""
    lean = decisions.select(*dict.fromkeys([KEY, *ORDER, ts, "proba", "alarm", "streak"]))
    return last_rows(lean, PREDICTIONS_KEPT).select(KEY, F.col(ts).alias("timestamp"), "proba", "alarm", "streak")


def recent(predictions: DataFrame, now, hours: int = 48, ts="timestamp") -> DataFrame:
    """Predictions still within their time to live."""
    return predictions.filter(F.col(ts) > F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours)))
