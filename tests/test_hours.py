"""Statistics by the clock, walked through once per task, equal Spark's range frames on odd rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.operators import prep

NAN = float("nan")
ROWS = [
    ("a", 1, 1, 60.0, 1.5), ("a", 1, 2, None, 2.25), ("a", 2, 3, 71.5, None), ("a", 9, 4, 70.0001, 3.0), ("a", 9, 5, 70.0, NAN),
    ("a", 9, 6, 12.5, 8.0), ("a", 10, 7, None, None), ("a", 34, 8, 1.0, 4.0), ("a", None, 9, 5.0, 6.0), ("a", None, 10, 7.5, None),
    ("b", 4095, 11, 1.0, 2.0), ("b", 4096, 12, 2.0, 2.0), ("b", 4100, 13, 4.5, 2.0), ("b", -3, 14, 9.0, 1.0), ("b", 0, 15, 8.0, 1.0),
    (None, 3, 16, 5.0, 5.0), (None, 4, 17, 6.5, 5.0), ("c", 7, 18, None, None),
]


def expected(df, vitals, windows):
    out = df
    for n in windows:
        frame = Window.partitionBy("patient_id").orderBy("ICULOS").rangeBetween(1 - n, 0)
        for v in vitals:
            kinds = {"mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v)}
            out = out.withColumns({f"{v.lower()}_{s}_{n}h": e.over(frame) for s, e in kinds.items()})
            if v == "HR":
                out = out.withColumn(f"hr_slope_{n}h", prep.exact_slope("HR", frame))
    return out


def rows(df, names):
    return sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.select(*names).collect())


def test_hours_equal_range_frames_without_windows(spark):
    df = spark.createDataFrame(ROWS, "patient_id string, ICULOS int, event_id long, HR double, Resp double").repartition(3)
    want = expected(df, ["HR", "Resp"], (2, 24))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for most in ("2", "10000"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", most)
            hr = prep.rolling_by_hour(df, vitals=["HR"], windows=(2, 24))
            assert "Window" not in hr._jdf.queryExecution().optimizedPlan().toString()  # a pass per frame and statistic
            assert rows(hr, hr.columns) == rows(want, hr.columns)
            both = prep.rolling_by_hour(df, ("mean", "std", "min", "max"), ["HR", "Resp"], (2, 24))
            assert rows(both, both.columns) == rows(want, both.columns)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_slopes_beyond_64_bits_stay_exact():
    import numpy as np

    group, hour, last = np.zeros(3, dtype=np.int64), np.array([1, 2, 4]), np.zeros(3, dtype=bool)
    whole = np.array([[0], [10 ** 17], [4 * 10 ** 17]])
    values = np.ma.array(whole / 1e4, mask=np.zeros((3, 1), dtype=bool))
    (slope,) = prep._hour_frames(group, hour, last, values, whole, ("slope",), (24,))
    assert slope.data[1, 0] == 1e13 and abs(slope.data[2, 0] - 1.357142857142857e13) < 1
