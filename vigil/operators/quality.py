"""Data-quality expectations as rows of passed and failed checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.metrics import count_where
from vigil.operators.slices import micros, slice_window, sliced, unsliced
from vigil.schema import HOUR, KEY, LABEL, TIE


def quality_report(df: DataFrame, id_pattern="^[Pp][0-9]+$", null_share=0.3, ts="event_ts", rows_per_slice=None):
    """All expectations from one aggregate over the table; hours must grow per patient in order of arrival."""
    base = sliced(df, order=(ts, TIE), halo=1, axis=micros(ts), rows_per_slice=rows_per_slice)
    before = F.lag(HOUR).over(slice_window(order=(ts, TIE)))
    checked = unsliced(base.withColumn("_back", F.col(HOUR) <= before))
    n = F.count(F.lit(1))

    def outside(column, lo, hi):
        return count_where(~F.col(column).between(lo, hi))

    def nulls(column):
        return count_where(F.col(column).isNull())

    bad = {
        "patient_id not null": nulls(KEY),
        "patient_id pattern": count_where(~F.col(KEY).rlike(id_pattern)),
        "HR between 20 and 250": outside("HR", 20, 250),
        "HR null share": nulls("HR"),
        "O2Sat between 50 and 100": outside("O2Sat", 50, 100),
        "O2Sat null share": nulls("O2Sat"),
        "Temp between 30 and 45": outside("Temp", 30, 45),
        "ICULOS not null": nulls(HOUR),
        "ICULOS grows per patient": count_where(F.col("_back")),
        "SepsisLabel in 0, 1": count_where(~F.col(LABEL).isin(0, 1)),
    }
    sums = checked.agg(n.alias("n"), *[e.alias(f"b{i}") for i, e in enumerate(bad.values())])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("expectation"), F.col(f"b{i}").alias("n_failed"),
                (F.col(f"b{i}") < F.col("n") * null_share if "share" in name else F.col(f"b{i}") == 0).alias("passed"),
            )
            for i, name in enumerate(bad)
        ]
    )
    return sums.select("n", F.inline(rows))
