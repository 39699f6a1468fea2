"""Column names, schemas and the fixed values every module shares."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "patient_id"
HOUR = "ICULOS"
TIE = "event_id"
LABEL = "SepsisLabel"
ORDER = (HOUR, TIE)

# Names and limits that must equal the published data set's and rules'.
VITALS = ["HR", "O2Sat", "Temp", "SBP", "MAP", "DBP", "Resp", "EtCO2"]
LABS = [
    "BaseExcess", "HCO3", "FiO2", "pH", "PaCO2", "SaO2", "AST", "BUN", "Alkalinephos",
    "Calcium", "Chloride", "Creatinine", "Bilirubin_direct", "Glucose", "Lactate",
    "Magnesium", "Phosphate", "Potassium", "Bilirubin_total", "TroponinI", "Hct", "Hgb",
    "PTT", "WBC", "Fibrinogen", "Platelets",
]
DEMOGRAPHICS = ["Age", "Gender", "Unit1", "Unit2", "HospAdmTime"]
MODEL_DEMOGRAPHICS = ["Age", "Gender", "HospAdmTime"]
VALID_RANGE = {
    "HR": (0, 300), "O2Sat": (0, 100), "Temp": (25, 45), "SBP": (0, 350),
    "MAP": (0, 300), "DBP": (0, 300), "Resp": (0, 70), "EtCO2": (0, 100),
}
WINDOWS = (6, 12, 24)
STATS = ("mean", "std", "min", "max", "slope")
VITALS_KEPT = 168
PROBAS_KEPT = 48
PREDICTIONS_KEPT = 24


def feature_name(stat: str, vital: str, hours: int) -> str:
    return f"{stat}_{vital.lower()}_{hours}h"


def rolling_names(stats=STATS, vitals=VITALS, windows=WINDOWS) -> list[str]:
    return [feature_name(s, v, n) for v in vitals for n in windows for s in stats]


def feature_names() -> list[str]:
    """The 131 model features: per vital its rolling block, then its missing flag; then scores."""
    names: list[str] = []
    for vital in VITALS:
        names += rolling_names(vitals=[vital])
        names.append(f"missing_{vital.lower()}")
    return [*names, "qsofa_score", "sirs_count", "iculos_hours"]


def model_inputs(drop=()) -> list[str]:
    """Features plus demographics in model order, less any dropped names."""
    return [c for c in [*feature_names(), *MODEL_DEMOGRAPHICS] if c not in set(drop)]


def record_schema() -> T.StructType:
    """One hourly record as it travels on files and streams (NULL is the only missing value)."""
    fields = [T.StructField(KEY, T.StringType())]
    fields += [T.StructField(c, T.DoubleType()) for c in [*VITALS, *LABS, *DEMOGRAPHICS]]
    fields += [
        T.StructField(HOUR, T.IntegerType()),
        T.StructField(LABEL, T.IntegerType()),
        T.StructField(TIE, T.LongType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("proba", T.DoubleType()),
    ]
    return T.StructType(fields)


def psv_schema() -> T.StructType:
    """Columns of one pipe-separated patient file, in file order; the id is the file's stem."""
    fields = [T.StructField(c, T.DoubleType()) for c in [*VITALS, *LABS, *DEMOGRAPHICS]]
    fields += [T.StructField(HOUR, T.DoubleType()), T.StructField(LABEL, T.DoubleType())]
    return T.StructType(fields)
