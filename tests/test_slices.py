"""Cut series must give what whole series give: every operator with tiny slices against none."""

import random

import pytest
from pyspark.sql import functions as F

from vigil.functions.rules import above
from vigil.operators import alarms, labels, prep, quality, suppression, tuning
from vigil.operators.joins import keep_patients
from vigil.operators.rolling import features, rolling
from vigil.operators.slices import large_keys, micros, sliced, with_position

TINY_SLICE = 9


def same(left, right, digits=7):
    def rows(df):
        out = df.select(*sorted(df.columns))
        out = out.withColumns({c: F.round(c, digits) + 0.0 for c, t in out.dtypes if t == "double"})
        return sorted(map(str, out.collect()))

    a, b = rows(left), rows(right)
    assert len(a) == len(b)
    assert a == b


CASES = {
    "features": lambda v, n: features(v, rows_per_slice=n),
    "means": lambda v, n: rolling(v.select("patient_id", "ICULOS", "event_id", "HR"), ("mean", "slope"), ["HR"], (5, 7), rows_per_slice=n),
    "outcomes": lambda v, n: alarms.patient_outcomes(v, above("proba", 0.4), 5, 6, rows_per_slice=n),
    "onset": lambda v, n: alarms.onset_rows(v, rows_per_slice=n),
    "decisions": lambda v, n: alarms.online_decisions(v.drop("second_proba"), 0.3, 3, 6, history=10, rows_per_slice=n),
    "two_level": lambda v, n: alarms.two_level_alarms(v, rows_per_slice=n),
    "gate": lambda v, n: prep.history_gate(v, rows_per_slice=n),
    "since": lambda v, n: prep.hours_since_last(v.select("patient_id", "ICULOS", "event_id", "HR", "EtCO2"), ["HR", "EtCO2"], rows_per_slice=n),
    "relabel": lambda v, n: labels.relabel_late(v, rows_per_slice=n),
    "grid": lambda v, n: tuning.tune_grid(v, (0.1, 0.4, 0.55), (1, 3, 6), (0, 6, 12), rows_per_slice=n),
    "quality": lambda v, n: quality.quality_report(v, rows_per_slice=n),
    "semi": lambda v, n: keep_patients(v, v.filter("Gender = 1").select("patient_id").distinct(), rows_per_slice=n),
}


@pytest.mark.parametrize("name", CASES)
def test_slices_change_nothing(vitals, name):
    same(CASES[name](vitals, TINY_SLICE), CASES[name](vitals, None))


def test_hour_slices_change_nothing(vitals, monkeypatch):
    from vigil.operators import slices

    lean = vitals.select("patient_id", "ICULOS", "event_id", "HR", "MAP", "SBP", "Resp")
    makers = [
        lambda: prep.forward_fill(lean, ["HR", "MAP"]),
        lambda: prep.interactions(lean),
        lambda: prep.rolling_by_hour(lean, vitals=["HR"], windows=(6,)),
    ]
    whole = [m() for m in makers]
    monkeypatch.setattr(slices.hour_slices, "__defaults__", (5, "ICULOS"))
    for make, expected in zip(makers, whole):
        same(make(), expected)


def test_slices_are_bounded_and_in_order(spark):
    """One key with most rows, most of them at one moment: positions stay exact, slices stay small."""
    rng = random.Random(3)
    rows = [("hot", 7 if rng.random() < 0.7 else rng.randrange(1000), i) for i in range(3000)]
    rows += [(f"k{i % 50}", i, i) for i in range(500)]
    df = spark.createDataFrame(rows, "patient_id string, ICULOS int, event_id long")
    assert [r["patient_id"] for r in large_keys(df, "patient_id", 100)] == ["hot"]
    cut = sliced(df, halo=10, rows_per_slice=100)
    assert cut.groupBy("patient_id", "_slice").count().agg(F.max("count")).first()[0] <= 110
    got = {r["event_id"]: r["at"] for r in with_position(df, "at", rows_per_slice=100).filter("patient_id = 'hot'").collect()}
    hot = sorted((r for r in rows if r[0] == "hot"), key=lambda r: (r[1], r[2]))
    assert got == {r[2]: i for i, r in enumerate(hot)}


@pytest.mark.parametrize("gap", [1.0, 30.0, 100.0])
def test_suppression_in_slices(spark, vitals, gap):
    found = vitals.filter("proba > 0.3").select(
        F.col("event_id").alias("alert_id"), "patient_id", F.col("event_ts").alias("timestamp"), "proba"
    )
    by_patient = {}
    for r in found.orderBy("timestamp").collect():
        emitted = by_patient.setdefault(r["patient_id"], [])
        if not emitted or (r["timestamp"] - emitted[-1][0]).total_seconds() >= gap * 3600:
            emitted.append((r["timestamp"], r["alert_id"]))
    expected = sorted(a for rows in by_patient.values() for _, a in rows)
    for n in (TINY_SLICE, None):
        got = suppression.suppress_repeats(found, gap, rows_per_slice=n)
        assert sorted(r["alert_id"] for r in got.collect()) == expected


def test_micros(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ'1970-01-02 00:00:00.000001' AS t").select(micros("t")).first()
    assert row[0] == 86_400_000_001
