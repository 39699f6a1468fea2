"""Inputs derived from the given tables: patient series and logs come from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.slices import micros, with_position
from vigil.schema import LABS


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


# (expression, when it is missing) per vital; all of them are missing where event_id % 89 = 0.
_VITAL_SQL = {
    "HR": ("if(event_id % 97 = 0, 500, 50 + (c + event_id * 3) % 100)", "event_id % 10 = 0"),
    "O2Sat": ("85 + (c + event_id * 5) % 16", "event_id % 8 = 1"),
    "Temp": ("35 + CAST((c + event_id * 7) % 60 AS DOUBLE) / 10", "event_id % 4 <> 0"),
    "SBP": ("80 + (c + event_id * 11) % 100", "event_id % 6 = 2"),
    "MAP": ("50 + (c + event_id * 13) % 70", "event_id % 7 = 3"),
    "DBP": ("40 + (c + event_id * 17) % 60", "event_id % 3 = 1"),
    "Resp": ("10 + (c + event_id * 19) % 25", "event_id % 9 = 4"),
    "EtCO2": ("20 + (c + event_id * 23) % 40", "event_id % 20 <> 0"),
}
_LAB_STEP = {"WBC": 29, "Lactate": 41, "FiO2": 43}


def _proba(step: int) -> str:
    ripple = f"CAST((c + event_id * {step}) % 500 AS DOUBLE) / 1000"
    return f"{ripple} + if((pos + 1 + user_id) % 30 < 12, 0.4D, 0.0D)"


def vitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly patient records: one per event, integer arithmetic only."""
    # The patient is named before the rows are numbered, so that later steps find them dealt out by patient.
    patient = "concat('p', lpad(CAST(user_id AS STRING), 6, '0')) AS patient_id"
    base = events(spark, sf_dir).selectExpr("event_id", "user_id", patient, "ts", "CAST(round(value * 100) AS BIGINT) AS c")
    placed = with_position(base, "pos", "patient_id", ("ts", "event_id"), axis=micros("ts"))
    signs = [
        f"if({missing} OR event_id % 89 = 0, NULL, CAST({value} AS DOUBLE)) AS {v}"
        for v, (value, missing) in _VITAL_SQL.items()
    ]
    labs = [
        f"if(event_id % 12 = 5, CAST(2 + (c + event_id * {_LAB_STEP[lab]}) % 14 AS DOUBLE), NULL) AS {lab}"
        if lab in _LAB_STEP else f"CAST(NULL AS DOUBLE) AS {lab}"
        for lab in LABS
    ]
    return placed.selectExpr(
        "patient_id", "CAST(pos + 1 AS INT) AS ICULOS",
        "ts AS event_ts", "event_id", *signs, *labs,
        "CAST(20 + user_id * 7 % 70 AS DOUBLE) AS Age", "CAST(user_id % 2 AS DOUBLE) AS Gender",
        "CAST(user_id % 4 = 0 AS DOUBLE) AS Unit1", "CAST(user_id % 4 <> 0 AS DOUBLE) AS Unit2",
        "CAST(-(user_id * 13 % 300) AS DOUBLE) AS HospAdmTime",
        "CAST(user_id % 3 = 0 AND pos + 1 >= 20 + user_id % 25 AS INT) AS SepsisLabel",
        f"{_proba(31)} AS proba", f"{_proba(37)} AS second_proba",
    )


def scores(spark, sf_dir) -> DataFrame:
    return vitals(spark, sf_dir).select(
        "patient_id", "ICULOS", "event_id", "event_ts", "SepsisLabel", "proba"
    )


def second_scores(spark, sf_dir) -> DataFrame:
    """The other learner's scores, with gaps so that a join with the first finds a mismatch."""
    return vitals(spark, sf_dir).filter(F.col("event_id") % 50 != 0).select(
        "patient_id", "ICULOS", F.col("second_proba").alias("proba")
    )


def request_log(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_type").alias("handler"), "ts", F.col("value").alias("latency_ms"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
    )
