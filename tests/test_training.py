"""What a training task holds is bounded by the bytes it may read, not by the table."""

import glob

import pyarrow.parquet as pq

from vigil.operators import models
from vigil.session import written

READING = "spark.sql.files.maxPartitionBytes"


def test_training_reads_bounded_parts(spark, monkeypatch):
    before, seen = spark.conf.get(READING), []

    class Recorded:
        def __init__(self, stages):
            pass

        def fit(self, data):
            seen.append(spark.conf.get(READING))

    monkeypatch.setattr(models, "Pipeline", Recorded)
    rows = spark.createDataFrame([(0, 1.0), (1, 2.0)], "SepsisLabel int, x double")
    models.train_trees(rows, ["x"], rounds=1)
    assert seen == [str(models.TASK_BYTES)] and models.TASK_BYTES <= 32 << 20
    assert spark.conf.get(READING) == before


def test_importance_shuffles_the_wide_rows_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = spark.range(400).selectExpr(
        "id AS event_id", "CAST(id % 7 < 3 AS INT) AS SepsisLabel", "CAST(id % 7 AS DOUBLE) AS x", "CAST(id % 5 AS DOUBLE) AS y",
    )
    inner, ranked = models.running_totals, []
    monkeypatch.setattr(models, "score", lambda model, df, inputs, name="proba": df.withColumn(name, -F.col("x") + F.col("y") / 100))
    monkeypatch.setattr(models, "running_totals", lambda df, *a, **k: ranked.append(1) or inner(df, *a, **k))
    found = {r["feature"]: r["auroc_drop"] for r in models.permutation_importance(None, rows, ["x", "y"], ["x", "y"]).collect()}
    assert len(ranked) == 2  # the rows and the values, not once for each column
    assert found["x"] > 0.2 and abs(found["y"]) < 0.01
    dealt = models.shuffled(rows, ["x", "y"], "event_id", 42).collect()
    assert len(dealt) == 400 and sorted(r["_dealt_x"] for r in dealt) == sorted(r["x"] for r in dealt)
    # values that stood in one row still do: the order is the same for all columns
    pairs = {(r["_dealt_x"], r["_dealt_y"]) for r in dealt}
    assert pairs == {(float(i % 7), float(i % 5)) for i in range(400)} and any(r["x"] != r["_dealt_x"] for r in dealt)


def test_options_reach_the_file(spark):
    rows = spark.range(200_000).selectExpr("id", "rand(1) AS x").coalesce(1)
    path = written(rows, "groups", **{"parquet.block.size": str(64 << 10)}).inputFiles()[0].removeprefix("file://")
    assert pq.ParquetFile(glob.glob(path)[0]).num_row_groups > 1
