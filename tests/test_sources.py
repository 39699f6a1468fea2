"""Files in and out."""

import pytest
from pyspark.sql import functions as F

from vigil.operators import labels, models
from vigil.schema import psv_schema
from vigil.sources import files


def write_patients(folder, names):
    header = [f.name for f in psv_schema().fields]
    for name in names:
        lines = ["|".join(header)]
        for hour in (1, 2):
            cells = {"HR": "NaN" if hour == 1 else "81", "ICULOS": str(hour), "SepsisLabel": "0"}
            lines.append("|".join(cells.get(c, "NaN") for c in header))
        (folder / f"{name}.psv").write_text("\n".join(lines) + "\n")


def test_psv_names_and_missing(spark, tmp_path):
    inner = tmp_path / "training_setA"
    inner.mkdir()
    write_patients(inner, ["p000001", "p000002", "p000003"])
    df = files.read_psv(spark, str(tmp_path))
    assert sorted(r[0] for r in df.select("patient_id").distinct().collect()) == ["p000001", "p000002", "p000003"]
    assert [r["HR"] for r in df.filter("patient_id = 'p000001'").orderBy("ICULOS").collect()] == [None, 81.0]
    assert dict(df.dtypes)["ICULOS"] == "int"
    first = files.read_psv(spark, str(tmp_path), max_patients=2)
    assert sorted(r[0] for r in first.select("patient_id").distinct().collect()) == ["p000001", "p000002"]
    write_patients(tmp_path, ["p000009"])  # files directly in the folder win
    top = files.read_psv(spark, str(tmp_path))
    assert [r[0] for r in top.select("patient_id").distinct().collect()] == ["p000009"]


def test_many_patients_take_one_file_each_and_few_listing_tasks(spark, tmp_path):
    n, path = 2 * files.LISTING_TASKS, str(tmp_path / "many")
    rows = spark.range(n).selectExpr("concat('p', id) AS patient_id", "*")
    rows = rows.select("patient_id", *[F.lit(1.0).cast(f.dataType).alias(f.name) for f in psv_schema().fields])
    files.write_psv(rows, path)
    written = [p for p in (tmp_path / "many").rglob("*") if p.is_file() and p.parent.name.startswith("patient_id=")]
    assert len(written) == n and all(p.suffix == ".csv" for p in written)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        df = files.read_psv(spark, path, pattern="*.csv", id_from="folder")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert 0 < sum(tracker.getStageInfo(s).numTasks for s in stages) <= files.LISTING_TASKS
    assert df.select("patient_id").distinct().count() == n


def test_splits_on_disk(spark, vitals, tmp_path):
    path = str(tmp_path / "splits")
    split = labels.patient_split(vitals)
    files.write_splits(vitals.select("patient_id", "ICULOS"), split.filter("split <> 'val'"), path)
    train = files.read_split(spark, path, "train")
    assert train.join(split.filter("split = 'train'"), "patient_id").count() == train.count() > 0
    assert files.read_split(spark, path, "val", required=False) is None
    with pytest.raises(FileNotFoundError):
        files.read_split(spark, path, "val")


def test_test_split_is_never_relabelled(vitals):
    with pytest.raises(ValueError):
        labels.relabel_late(vitals, split="test")


def test_split_shares(spark):
    ids = spark.range(1000).select(F.concat(F.lit("p"), F.col("id")).alias("patient_id"))
    counts = {r["split"]: r["count"] for r in labels.patient_split(ids).groupBy("split").count().collect()}
    assert counts == {"train": 700, "val": 150, "test": 150}


def test_bundle_needs_a_feature_order(spark, vitals, tmp_path):
    lean = vitals.select("patient_id", "ICULOS", "event_id", "SepsisLabel", "HR", "Resp")
    model = models.train_trees(lean, ["HR", "Resp"], rounds=2, depth=2, min_leaf=5)
    models.save_bundle(model, ["HR", "Resp"], {"threshold": 0.4}, str(tmp_path / "good"))
    again, names, params = models.load_bundle(spark, str(tmp_path / "good"))
    assert names == ["HR", "Resp"] and params == {"threshold": 0.4}
    assert models.score(again, lean, names).filter("proba between 0 and 1").count() == lean.count()
    assert models.numeric_inputs(lean) == ["HR", "Resp", "event_id"]
    models.save_bundle(model, [], {}, str(tmp_path / "bad"))
    with pytest.raises(ValueError):
        models.load_bundle(spark, str(tmp_path / "bad"))
