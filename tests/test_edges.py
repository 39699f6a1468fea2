"""Ordinary edge data must not stop a job or change with the size of a table."""

import pytest
from pyspark.sql import functions as F

from vigil.functions import rules
from vigil.operators import curves, drift, metrics, prep


def scored(spark, rows):
    return spark.createDataFrame(rows, "proba double, SepsisLabel int")


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_has_no_rates(spark, label):
    steps = curves.score_steps(scored(spark, [(0.1, label), (0.7, label), (0.7, label), (None, label)]))
    assert curves.auroc(steps).first()["auroc"] is None
    assert {r["tpr" if label == 0 else "fpr"] for r in curves.roc_curve(steps).collect()} == {None, 0.0}
    curves.pr_curve(steps).collect(), curves.average_precision(steps).collect(), curves.sensitivity_at_specificity(steps).collect()


def test_scores_packed_together_spread_over_cells(spark):
    rows = spark.range(4000).select((F.col("id") * 1e-10).alias("proba"), (F.col("id") % 7 == 0).cast("int").alias("SepsisLabel"))
    cells = curves.ranged(rows, "proba").groupBy("_cell").count().collect()
    assert len(cells) >= 8 and max(r["count"] for r in cells) < 1000
    assert curves.auroc(curves.score_steps(rows)).first()["auroc"] == pytest.approx(0.5, abs=0.01)


@pytest.mark.parametrize("n", [900, 1100])
def test_drift_does_not_depend_on_the_number_of_rows(spark, n):
    reference = spark.range(n).select((60 + F.pmod(F.col("id") * 37, F.lit(40))).cast("double").alias("HR"))
    for shift, expected in ((0.5, False), (6.0, True)):
        moved = reference.select((F.col("HR") + shift).alias("HR"))
        assert drift.drift_columns(reference, moved, ["HR"]).first()["drifted"] is expected


def test_columns_without_values_keep_their_row(spark):
    full = spark.range(50).select(F.col("id").cast("double").alias("HR"), F.col("id").cast("double").alias("Temp"), F.lit(None).cast("double").alias("SBP"))
    bare = full.withColumn("HR", F.lit(None).cast("double"))
    for reference, current in ((full, bare), (bare, full), (full, full.limit(0))):
        found = {r["feature"]: r for r in drift.drift_columns(reference, current, ["HR", "Temp", "SBP"]).collect()}
        assert set(found) == {"HR", "Temp", "SBP"} and found["HR"]["drifted"] is None and found["SBP"]["ks"] is None
        summary = drift.drift_summary(reference, current, ["HR", "Temp", "SBP"]).first()
        assert (summary["n_drifted"], summary["n_columns"]) == (0, 3)
        index = {r["feature"]: r for r in drift.psi(reference, current, ["HR", "Temp", "SBP"]).collect()}
        assert set(index) == {"HR", "Temp", "SBP"} and index["HR"]["psi"] is None and index["HR"]["band"] is None


def test_hours_out_of_range(spark):
    row = spark.range(1).select(rules.whole_hours(F.lit(1e12)).alias("high"), rules.whole_hours(F.lit(-1e12)).alias("low")).first()
    assert (row["high"], row["low"]) == (2147483647, 0)


def test_no_gender_is_a_group_of_its_own(spark):
    rows = spark.createDataFrame([(30.0, None, 80.0), (31.0, None, None), (30.0, 1.0, 60.0)], "Age double, Gender double, HR double")
    assert sorted(r["HR"] for r in prep.impute_group_mean(rows, ["HR"]).collect()) == [60.0, 80.0, 80.0]


def test_summary_of_one_class(spark):
    rows = spark.createDataFrame([("a", h, h, 0, 0.1 * h) for h in range(1, 8)], "patient_id string, ICULOS int, event_id long, SepsisLabel int, proba double")
    found = metrics.evaluation_summary(rows, 0.5, 1, 0).first()
    assert found["auroc"] is None and found["fp"] == 1
