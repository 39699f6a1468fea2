"""Plans and files whose cost must not grow faster than the rows."""

from pyspark.sql import functions as F

from vigil.operators import tuning

SCORES = "patient_id string, ICULOS int, event_id long, SepsisLabel int, proba double"


def test_grid_keeps_no_table_per_patient(spark):
    rows = [("a", h, h, int(h > 5), (h * 37 % 11) / 10) for h in range(1, 12)] + [(None, 1, 90, None, 0.5), ("b", 1, 91, 0, None)]
    df = spark.createDataFrame(rows, SCORES)
    grid = tuning.tune_grid(df, (0.2, 0.5, 0.9), (1, 2), (0, 3))
    assert "Aggregate [patient_id" not in grid._jdf.queryExecution().optimizedPlan().toString()
    # a: onset at row 5; b and the nameless patient are not septic, and only the latter reaches 0.5
    by_cell = {(r.threshold, r.min_consecutive, r.warmup_hours): (r.tp, r.fn, r.fp, r.tn) for r in grid.collect()}
    assert by_cell[(0.5, 1, 0)] == (1, 0, 1, 1) and by_cell[(0.5, 1, 3)] == (1, 0, 0, 2) and by_cell[(0.9, 2, 0)] == (0, 1, 0, 2)
    cut = tuning.tune_grid(df, (0.2, 0.5, 0.9), (1, 2), (0, 3), rows_per_slice=3)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, grid.collect()))
