"""Record checks, scores and decisions on small hand-made rows."""

import pytest
from pyspark.sql import functions as F

from vigil.functions import rules
from vigil.operators import alarms
from vigil.operators.metrics import patient_utility
from vigil.operators.rolling import features
from vigil.schema import VITALS, feature_names, record_schema

BASE = dict(HR=72.0, O2Sat=96.5, Temp=36.6, SBP=131.0, MAP=91.0, DBP=64.0, Resp=14.0, EtCO2=38.0)


def records(spark, rows):
    names = record_schema().fieldNames()
    full = [{"patient_id": "A", "event_id": i, **r} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], record_schema())


def test_validator(spark):
    rows = [
        {"HR": 80.0, "Temp": 37.0, "SBP": 120.0}, {"HR": 500.0, "Temp": 37.0}, {"Temp": 10.0}, {"Age": 65.0},
        {"HR": 80.0, "Temp": None}, {"patient_id": "", "HR": 80.0}, {"HR": 301.0, "Temp": 46.0}, {"Resp": 70.0},
    ]
    got = {r["event_id"]: r["reason"] for r in rules.check_records(records(spark, rows)).collect()}
    assert got[0] is None and got[4] is None and got[7] is None
    assert got[1] == "HR=500.0 out of range [0, 300]"
    assert got[2] == "Temp=10.0 out of range [25, 45]"
    assert got[3] == "All vital signs are null"
    assert got[5] == "Missing patient_id"
    assert got[6].startswith("HR=301.0")


def test_features_of_three_rows(spark):
    rows = [{**BASE, "HR": h, "ICULOS": i + 1} for i, h in enumerate((66.0, 81.0, 96.0))]
    rows.append({**BASE, "patient_id": "B", "HR": 187.0, "ICULOS": 1})
    rows.append({**BASE, "patient_id": "C", "HR": None, "ICULOS": 1})
    rows.append({**BASE, "patient_id": "D", "SBP": 88.0, "Resp": 27.0, "ICULOS": 1})
    rows.append({**BASE, "patient_id": "E", "Temp": 38.9, "HR": 117.0, "Resp": 26.0, "WBC": 13.5, "ICULOS": 1})
    out = {(r["patient_id"], r["ICULOS"]): r for r in features(records(spark, rows)).collect()}
    last = out["A", 3]
    assert len(feature_names()) == 131 and set(feature_names()) <= set(last.asDict())
    assert (last["mean_hr_6h"], last["max_hr_6h"], last["min_hr_6h"]) == (81.0, 96.0, 66.0)
    assert last["slope_hr_6h"] == pytest.approx(15.0)
    assert last["std_hr_6h"] == pytest.approx(150 ** 0.5)
    assert out["A", 1]["slope_hr_6h"] == 0.0 and out["A", 1]["std_hr_6h"] == 0.0
    assert out["B", 1]["mean_hr_24h"] == 187.0
    assert out["C", 1]["missing_hr"] == 1 and out["C", 1]["missing_temp"] == 0 and out["C", 1]["mean_hr_6h"] is None
    assert out["D", 1]["qsofa_score"] == 2
    assert out["E", 1]["sirs_count"] == 4


@pytest.mark.parametrize(
    ("probas", "k", "warmup", "streak", "alarm", "muted"),
    [
        ([0.3, 0.7, 0.8, 0.9, 0.7], 4, 0, 4, True, False),
        ([0.8, 0.7, 0.9, 0.2, 0.7], 3, 0, 1, False, False),
        ([0.7, 0.9, 0.8], 3, 5, 3, False, True),
        ([0.4, 0.3, 0.2], 1, 0, 0, False, False),
        ([0.6] * 60, 48, 0, 48, True, False),
        ([0.6] * 60, 49, 0, 48, False, False),
    ],
)
def test_online_decision(spark, probas, k, warmup, streak, alarm, muted):
    df = records(spark, [{"ICULOS": i + 1, "proba": p} for i, p in enumerate(probas)])
    last = alarms.online_decisions(df, 0.5, k, warmup).orderBy(F.desc("ICULOS")).first()
    assert (last["streak"], last["alarm"], last["muted"]) == (streak, alarm, muted)


@pytest.mark.parametrize(
    ("predictions", "k", "warmup", "expected"),
    [
        ([1, 0, 0, 0, 1, 1, 1, 1], 4, 0, 4), ([1, 1, 0, 1, 1, 0], 3, 0, None), ([1, 1, 0, 0, 1, 1], 2, 2, 4),
        ([0, 0, 1], 1, 0, 2), ([0, 0, 0], 1, 0, None), ([1, 1], 3, 0, None), ([1, 1, 1, 1], 3, 1, 1),
    ],
)
def test_first_alarm(spark, predictions, k, warmup, expected):
    df = records(spark, [{"ICULOS": i + 1, "proba": float(p)} for i, p in enumerate(predictions)])
    assert alarms.first_alarm(df, rules.above("proba", 0.5), k, warmup).first()["t_alarm"] == expected


def test_utility_offsets(spark):
    rows = [("a", 0, 13, 0.0), ("b", 4, 10, 1.0), ("c", 10, 10, 1.0), ("d", 13, 10, 1.0), ("e", 14, 10, -2.0),
            ("f", None, 10, -2.0), ("g", 3, None, -0.05), ("h", None, None, 0.0), ("i", 1, 10, 0.5)]
    df = spark.createDataFrame(rows, "patient_id string, t_alarm long, t_onset long, expected double")
    for r in patient_utility(df).collect():
        assert r["utility"] == pytest.approx(r["expected"]), r


def test_feature_map_ignores_unknown_and_keeps_missing_null(spark):
    df = spark.sql("SELECT 1 AS id, map('mean_hr_6h', 80D, 'qsofa', 2D) AS m")
    row = rules.from_feature_map(df, "m", ["mean_hr_6h", "std_hr_6h"]).first()
    assert row["mean_hr_6h"] == 80.0 and row["std_hr_6h"] is None and "qsofa" not in row.asDict()


def test_numbers(spark):
    df = spark.sql("SELECT * FROM VALUES ('1.5'), ('x'), ('NaN'), ('Infinity'), ('-2'), (NULL) AS t(s)")
    assert [r[0] for r in df.select(rules.finite("s")).collect()] == [1.5, None, None, None, -2.0, None]
    assert [r[0] for r in df.select(rules.whole_hours("s")).collect()] == [1, None, None, None, 0, None]
    assert {c for c in VITALS} == set(BASE)
