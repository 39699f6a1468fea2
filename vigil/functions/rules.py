"""Record checks, clinical scores, risk bands and decision parameters as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.schema import HOUR, KEY, MODEL_DEMOGRAPHICS, VALID_RANGE, VITALS, feature_names

OFFLINE_DEFAULTS = {"threshold": 0.5, "min_consecutive": 1, "warmup_hours": 0}
SERVING_DEFAULTS = {"threshold": 0.05, "min_consecutive": 6, "warmup_hours": 0}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0; unknown counts as 0."""
    return F.when(condition, 1).otherwise(0)


def finite(value: Column | str) -> Column:
    """Any castable, finite value as a double, else NULL."""
    number = _col(value).try_cast("double")
    return F.when(F.isnan(number) | (F.abs(number) == float("inf")), None).otherwise(number)


def nan_to_null(df: DataFrame, columns=None) -> DataFrame:
    """NaN becomes NULL in every floating column."""
    floating = [n for n, t in df.dtypes if t in ("double", "float") and (columns is None or n in columns)]
    return df.withColumns({c: F.when(F.isnan(c), None).otherwise(F.col(c)) for c in floating})


def invalid_reason() -> Column:
    """Why a record is refused, NULL when it is fine: range failures in vital order, then no vitals."""
    failures = [
        F.when(
            ~F.col(c).between(lo, hi),
            F.concat(F.lit(f"{c}="), F.col(c).cast("string"), F.lit(f" out of range [{lo}, {hi}]")),
        )
        for c, (lo, hi) in VALID_RANGE.items()
    ]
    empty = F.when(F.coalesce(*[F.col(c) for c in VITALS]).isNull(), F.lit("All vital signs are null"))
    return F.coalesce(*failures, empty)


def check_records(df: DataFrame, key: str = KEY) -> DataFrame:
    """Add ``is_valid`` and ``reason``; a record without a patient is refused first."""
    reason = F.when(F.coalesce(F.col(key), F.lit("")) == "", F.lit("Missing patient_id")).otherwise(invalid_reason())
    return df.withColumn("reason", reason).withColumn("is_valid", F.col("reason").isNull())


def accepted(df: DataFrame, key: str = KEY) -> DataFrame:
    return check_records(df, key).filter("is_valid").drop("is_valid", "reason")


def quarantined(df: DataFrame, key: str = KEY) -> DataFrame:
    return check_records(df, key).filter("not is_valid").drop("is_valid")


def missing_flags() -> dict[str, Column]:
    return {f"missing_{v.lower()}": F.col(v).isNull().cast("int") for v in VITALS}


def qsofa() -> Column:
    """0-2: consciousness is not recorded, so only pressure and breathing count."""
    return flag(F.col("SBP") <= 100) + flag(F.col("Resp") >= 22)


def sirs() -> Column:
    temp, wbc = F.col("Temp"), F.col("WBC")
    criteria = [(temp > 38) | (temp < 36), F.col("HR") > 90, F.col("Resp") > 20, (wbc > 12) | (wbc < 4)]
    return reduce(add, [flag(c) for c in criteria])


def whole_hours(hour: Column | str = HOUR) -> Column:
    """Hours in intensive care as a whole number, toward zero, never negative, at most the largest integer; NULL stays NULL."""
    number = finite(hour)
    return F.when(number.isNotNull(), F.greatest(F.least(number, F.lit(2147483647.0)), F.lit(0.0)).cast("int"))


def risk_band(proba: Column | str, warn: float = 0.1, critical: float = 0.5) -> Column:
    p = _col(proba)
    return F.when(p >= critical, "critical").when(p >= warn, "warn").otherwise("ok")


def severity(proba: Column | str) -> Column:
    p = _col(proba)
    return F.when(p >= 0.7, "CRITICAL").when(p >= 0.5, "WARNING")


def above(proba: Column | str, threshold: float | Column) -> Column:
    """1 when the probability reaches the threshold (inclusive)."""
    return flag(_col(proba) >= threshold)


def feature_map(columns=None) -> Column:
    """The request form of a feature row: name to finite number, absent when NULL."""
    names = columns or [*feature_names(), *MODEL_DEMOGRAPHICS]
    values = [finite(c) for c in names]
    keys = [F.when(v.isNotNull(), F.lit(c)) for c, v in zip(names, values)]
    return F.map_from_arrays(F.array_compact(F.array(*keys)), F.array_compact(F.array(*values)))


def from_feature_map(df: DataFrame, column: str, names) -> DataFrame:
    """Back to columns in model order; unknown names are ignored, absent ones become NULL."""
    wide = [F.try_element_at(F.col(column), F.lit(n)).alias(n) for n in names]
    return df.select(*[c for c in df.columns if c != column], *wide)


def resolve_params(params: DataFrame, defaults: dict) -> DataFrame:
    """Per field: override, else stored artifact, else default.

    ``params`` has ``override_<field>`` and ``artifact_<field>`` columns.
    """
    chosen = [
        F.coalesce(F.col(f"override_{f}"), F.col(f"artifact_{f}"), F.lit(d)).alias(f) for f, d in defaults.items()
    ]
    rest = [c for c in params.columns if not c.startswith(("override_", "artifact_"))]
    return params.select(*rest, *chosen)


# The public NEWS2 chart, as (upper limit, points) steps read from the left;
# a value up to and including the limit scores those points, the last entry is open ended.
NEWS2 = {
    "Resp": [(8, 3), (11, 1), (20, 0), (24, 2), (None, 3)],
    "O2Sat": [(91, 3), (93, 2), (95, 1), (None, 0)],
    "Temp": [(35.0, 3), (36.0, 1), (38.0, 0), (39.0, 1), (None, 2)],
    "SBP": [(90, 3), (100, 2), (110, 1), (219, 0), (None, 3)],
    "HR": [(40, 3), (50, 1), (90, 0), (110, 1), (130, 2), (None, 3)],
}


def news2() -> Column:
    """Early-warning score over the recorded inputs; extra oxygen (FiO2 over 0.21) adds 2.

    Consciousness is not recorded and counts as alert; a missing input adds nothing.
    """
    total = flag(F.col("FiO2") > 0.21) * 2
    for vital, steps in NEWS2.items():
        points = F.when(F.col(vital).isNull(), 0)
        for limit, score in steps:
            points = points.otherwise(score) if limit is None else points.when(F.col(vital) <= limit, score)
        total = total + points
    return total
