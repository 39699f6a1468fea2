"""SQL each query is checked against, for an engine with ANSI SQL over the same tables."""

from __future__ import annotations

from vigil.schema import DEMOGRAPHICS, LABS, STATS, VALID_RANGE, VITALS, WINDOWS, feature_name, feature_names

SQL: dict[str, str] = {}
THR, RUN, WARM = "0.4::DOUBLE", 3, 6


def r(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0::DOUBLE AS {name}"


def iso(expression: str, name: str) -> str:
    return f"strftime({expression}, '%Y-%m-%dT%H:%M:%S.%f') AS {name}"


# ---- shared inputs -------------------------------------------------------------------------------

_SPREAD = "(c + event_id * {}) % {}"
_VITAL = {
    "HR": ("CASE WHEN event_id % 97 = 0 THEN 500 ELSE 50 + (c + event_id * 3) % 100 END", "event_id % 10 = 0"),
    "O2Sat": ("85 + (c + event_id * 5) % 16", "event_id % 8 = 1"),
    "Temp": ("35 + CAST((c + event_id * 7) % 60 AS DOUBLE) / 10", "event_id % 4 <> 0"),
    "SBP": ("80 + (c + event_id * 11) % 100", "event_id % 6 = 2"),
    "MAP": ("50 + (c + event_id * 13) % 70", "event_id % 7 = 3"),
    "DBP": ("40 + (c + event_id * 17) % 60", "event_id % 3 = 1"),
    "Resp": ("10 + (c + event_id * 19) % 25", "event_id % 9 = 4"),
    "EtCO2": ("20 + (c + event_id * 23) % 40", "event_id % 20 <> 0"),
}
_LAB_STEP = {"WBC": 29, "Lactate": 41, "FiO2": 43}


def _vital_columns() -> str:
    out = [
        f"CASE WHEN {null} OR event_id % 89 = 0 THEN NULL ELSE CAST({value} AS DOUBLE) END AS {name}"
        for name, (value, null) in _VITAL.items()
    ]
    for lab in LABS:
        step = _LAB_STEP.get(lab)
        value = f"CASE WHEN event_id % 12 = 5 THEN CAST(2 + (c + event_id * {step}) % 14 AS DOUBLE) END"
        out.append(f"{value if step else 'CAST(NULL AS DOUBLE)'} AS {lab}")
    return ",\n  ".join(out)


def _proba(step: int) -> str:
    return (
        f"CAST((c + event_id * {step}) % 500 AS DOUBLE) / 1000 + "
        "CASE WHEN (h + user_id) % 30 < 12 THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END"
    )


V = f"""e AS (
  SELECT event_id, user_id, ts, CAST(round(value * 100) AS BIGINT) AS c,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS h
  FROM events),
v AS (
  SELECT concat('p', lpad(CAST(user_id AS VARCHAR), 6, '0')) AS patient_id, CAST(h AS INTEGER) AS ICULOS,
  ts AS event_ts, event_id,
  {_vital_columns()},
  CAST(20 + user_id * 7 % 70 AS DOUBLE) AS Age, CAST(user_id % 2 AS DOUBLE) AS Gender,
  CAST(user_id % 4 = 0 AS DOUBLE) AS Unit1, CAST(user_id % 4 <> 0 AS DOUBLE) AS Unit2,
  CAST(-(user_id * 13 % 300) AS DOUBLE) AS HospAdmTime,
  CAST(user_id % 3 = 0 AND h >= 20 + user_id % 25 AS INTEGER) AS SepsisLabel,
  {_proba(31)} AS proba, {_proba(37)} AS second_proba
  FROM e)"""

# Alarm rules by runs: `streak` counts the rows of the present run, `pos` is the 0-based row.
RUNS = f"""p AS (
  SELECT patient_id, ICULOS, event_id, event_ts, SepsisLabel, proba, ICULOS - 1 AS pos,
         CAST(proba >= {THR} AS INTEGER) AS up FROM v),
g AS (SELECT *, sum(1 - up) OVER (PARTITION BY patient_id ORDER BY pos) AS grp FROM p),
s AS (SELECT *, sum(up) OVER (PARTITION BY patient_id, grp ORDER BY pos) AS run FROM g),
d AS (
  SELECT *, CAST(least(48, run) AS INTEGER) AS streak, ICULOS < {WARM} AS muted,
         ICULOS >= {WARM} AND least(48, run) >= {RUN} AS alarm FROM s)"""


def _outcomes(source: str, run, warm, extra="") -> str:
    return f"""SELECT patient_id{extra},
    CAST(min(CASE WHEN run >= {run} AND pos - {run} + 1 >= {warm} THEN pos - {run} + 1 END) AS BIGINT) AS t_alarm,
    CAST(min(CASE WHEN SepsisLabel = 1 THEN pos END) AS BIGINT) AS t_onset, max(proba) AS max_proba
  FROM {source} GROUP BY patient_id{extra}"""


_UTILITY = """CASE WHEN t_onset IS NULL THEN CASE WHEN t_alarm IS NULL THEN 0.0::DOUBLE ELSE -0.05::DOUBLE END
    WHEN t_alarm IS NULL THEN -2.0::DOUBLE
    WHEN t_alarm - t_onset < -12 THEN 0.0::DOUBLE
    WHEN t_alarm - t_onset <= -6 THEN (t_alarm - t_onset + 12) / 6.0::DOUBLE
    WHEN t_alarm - t_onset <= 3 THEN 1.0::DOUBLE ELSE -2.0::DOUBLE END"""
OUT = f"o AS ({_outcomes('s', RUN, WARM)}), u AS (SELECT *, {_UTILITY} AS utility FROM o)"
_COUNTS = """count(*) FILTER (t_onset IS NOT NULL AND t_alarm IS NOT NULL) AS tp,
  count(*) FILTER (t_onset IS NOT NULL AND t_alarm IS NULL) AS fn,
  count(*) FILTER (t_onset IS NULL AND t_alarm IS NOT NULL) AS fp,
  count(*) FILTER (t_onset IS NULL AND t_alarm IS NULL) AS tn"""
_UTIL_ROW = f"""{r('sum(utility)', 'raw_utility')}, CAST(count(t_onset) AS DOUBLE) AS max_utility,
  {r('CASE WHEN count(t_onset) > 0 THEN sum(utility) / count(t_onset) ELSE 0 END', 'normalized_utility')},
  {_COUNTS}"""


def w(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


SPLIT = """ids AS (SELECT DISTINCT patient_id FROM v),
ranked AS (SELECT patient_id, row_number() OVER (ORDER BY md5(concat('42|', patient_id)), patient_id) AS k,
           count(*) OVER () AS n FROM ids),
split AS (SELECT patient_id, CASE WHEN k <= floor(n * 0.70::DOUBLE) THEN 'train'
          WHEN k <= floor(n * 0.70::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM ranked)"""

# ---- records -------------------------------------------------------------------------------------

SQL["coerce_numeric"] = f"""WITH t AS (SELECT event_id, try_cast(CASE WHEN event_id % 7 = 0 THEN 'n/a'
  WHEN event_id % 11 = 0 THEN 'NaN' WHEN event_id % 13 = 0 THEN 'Infinity' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS x
  FROM events)
SELECT event_id, {r('CASE WHEN isfinite(x) THEN x END', 'number')} FROM t"""

_RANGE_REASONS = ", ".join(
    f"CASE WHEN NOT {c} BETWEEN {lo} AND {hi} THEN concat('{c}=', CAST({c} AS VARCHAR), ' out of range [{lo}, {hi}]') END"
    for c, (lo, hi) in VALID_RANGE.items()
)
CHECKED = f"""c AS (SELECT *, coalesce({_RANGE_REASONS},
  CASE WHEN coalesce({', '.join(VITALS)}) IS NULL THEN 'All vital signs are null' END) AS reason FROM v)"""
SQL["validate_records"] = w(V, CHECKED) + "SELECT patient_id, ICULOS, reason IS NULL AS is_valid, reason FROM c"
SQL["scored_chain_check"] = w(V, CHECKED) + "SELECT count(*) AS n_checked, count(*) AS n_decided, 0 AS n_odd FROM c WHERE reason IS NULL"
SQL["quarantine_counts"] = w(V, CHECKED) + "SELECT reason, count(*) AS n FROM c WHERE reason IS NOT NULL GROUP BY reason"

_MISSING = ", ".join(f"CAST({c} IS NULL AS INTEGER) AS missing_{c.lower()}" for c in VITALS)
SQL["missing_indicators"] = w(V) + f"SELECT patient_id, ICULOS, {_MISSING} FROM v"


def _points(*conditions: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in conditions) + ")"


_QSOFA = _points("SBP <= 100", "Resp >= 22")
_SIRS = _points("Temp > 38 OR Temp < 36", "HR > 90", "Resp > 20", "WBC > 12 OR WBC < 4")
SQL["clinical_scores"] = w(V) + f"SELECT patient_id, ICULOS, {_QSOFA} AS qsofa_score, {_SIRS} AS sirs_count FROM v"
SQL["iculos_normalize"] = """WITH t AS (
  SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value - 20 END AS x FROM events),
n AS (SELECT event_id, CAST(greatest(trunc(x), 0) AS INTEGER) AS h, x FROM t)
SELECT event_id, CASE WHEN x IS NOT NULL THEN h END AS iculos_hours, x IS NOT NULL AS scored FROM n"""


def _band(p: str, warn: str) -> str:
    return f"CASE WHEN {p} >= 0.5::DOUBLE THEN 'critical' WHEN {p} >= {warn} THEN 'warn' ELSE 'ok' END"


SQL["risk_bands"] = w(V) + f"""SELECT {_band('proba', '0.1::DOUBLE')} AS list_band, {_band('proba', THR)} AS detail_band,
  count(*) AS n FROM v GROUP BY ALL"""
SQL["severity"] = w(V) + """SELECT patient_id, ICULOS,
  CASE WHEN proba >= 0.7::DOUBLE THEN 'CRITICAL' ELSE 'WARNING' END AS severity FROM v WHERE proba >= 0.5::DOUBLE"""
SQL["news2"] = w(V) + """SELECT patient_id, ICULOS, CAST(
  CASE WHEN FiO2 > 0.21::DOUBLE THEN 2 ELSE 0 END
  + CASE WHEN Resp <= 8 THEN 3 WHEN Resp <= 11 THEN 1 WHEN Resp <= 20 THEN 0 WHEN Resp <= 24 THEN 2 WHEN Resp > 24 THEN 3 ELSE 0 END
  + CASE WHEN O2Sat <= 91 THEN 3 WHEN O2Sat <= 93 THEN 2 WHEN O2Sat <= 95 THEN 1 ELSE 0 END
  + CASE WHEN Temp <= 35 THEN 3 WHEN Temp <= 36 THEN 1 WHEN Temp <= 38 THEN 0 WHEN Temp <= 39 THEN 1 WHEN Temp > 39 THEN 2 ELSE 0 END
  + CASE WHEN SBP <= 90 THEN 3 WHEN SBP <= 100 THEN 2 WHEN SBP <= 110 THEN 1 WHEN SBP <= 219 THEN 0 WHEN SBP > 219 THEN 3 ELSE 0 END
  + CASE WHEN HR <= 40 THEN 3 WHEN HR <= 50 THEN 1 WHEN HR <= 90 THEN 0 WHEN HR <= 110 THEN 1 WHEN HR <= 130 THEN 2 WHEN HR > 130 THEN 3 ELSE 0 END
  AS INTEGER) AS news2 FROM v"""
SQL["resolve_params"] = w(V) + f""", t AS (SELECT patient_id, max(proba) AS top, count(*) AS n FROM v GROUP BY patient_id)
SELECT patient_id,
  {r("coalesce(CASE WHEN n % 5 = 0 THEN 0.9::DOUBLE END, CASE WHEN n % 2 = 1 THEN top END, 0.05::DOUBLE)", 'threshold')},
  CAST(coalesce(CASE WHEN n % 3 = 0 THEN 2 END, CASE WHEN n % 2 = 1 THEN n % 7 END, 6) AS INTEGER) AS min_consecutive,
  CAST(coalesce(CASE WHEN n % 2 = 1 THEN n % 4 END, 0) AS INTEGER) AS warmup_hours FROM t"""

# ---- rolling windows -----------------------------------------------------------------------------


def _over(rows: int) -> str:
    return f"OVER (PARTITION BY patient_id ORDER BY ICULOS, event_id ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


def _stat(stat: str, vital: str, rows: int) -> str:
    over = _over(rows)
    if stat == "slope":
        return (
            f"CASE WHEN count({vital}) {over} = 1 THEN 0.0 WHEN count({vital}) {over} > 1 "
            f"THEN regr_slope({vital}, rank_{vital}) {over} END"
        )
    function = {"mean": "avg", "std": "stddev_pop", "min": "min", "max": "max"}[stat]
    return f"{function}({vital}) {over}"


_RANKS = ", ".join(
    f"count({c}) OVER (PARTITION BY patient_id ORDER BY ICULOS, event_id) AS rank_{c}" for c in VITALS
)
RANKED = f"k AS (SELECT *, {_RANKS} FROM v)"


def _rolled(stats) -> str:
    return ", ".join(
        r(_stat(s, v, n), feature_name(s, v, n)) for v in VITALS for n in WINDOWS for s in stats
    )


def _feature_select() -> str:
    return f"""SELECT patient_id, ICULOS, event_id, SepsisLabel, Age, Gender, HospAdmTime, {_rolled(STATS)}, {_MISSING},
  {_QSOFA} AS qsofa_score, {_SIRS} AS sirs_count, ICULOS AS iculos_hours FROM k"""


SQL["features_131"] = w(V, RANKED) + _feature_select()
SQL["latest_features"] = w(V, RANKED, f"f AS ({_feature_select()})") + """SELECT * FROM f
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ICULOS DESC, event_id DESC) = 1"""
for _s in STATS:
    SQL[f"rolling_{_s}"] = w(V, RANKED) + f"SELECT patient_id, ICULOS, event_id, {_rolled([_s])} FROM k"
SQL["feature_map_roundtrip"] = w(V, RANKED, f"f AS ({_feature_select()})") + f"""SELECT event_id,
  CAST({' + '.join(f'CAST({c} IS NOT NULL AS INTEGER)' for c in [*feature_names(), 'Age', 'Gender', 'HospAdmTime'])} AS INTEGER)
  AS n_present, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in [*feature_names(), 'Age', 'Gender', 'HospAdmTime'])} FROM f"""


def _hours(rows: int) -> str:
    return f"OVER (PARTITION BY patient_id ORDER BY ICULOS RANGE BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


def _exact_slope(v: str, n: int, digits: int = 4) -> str:
    """Least-squares slope from exact sums: hours relative to the row, values in whole 10^-digits, rounded to six
    decimals half away from zero in whole numbers."""
    y, x = f"CAST(round({v} * {10 ** digits}) AS BIGINT)", f"CASE WHEN {v} IS NOT NULL THEN CAST(ICULOS AS BIGINT) END"
    cnt, sx, sy = f"count({v}) {_hours(n)}", f"sum({x}) {_hours(n)}", f"sum({y}) {_hours(n)}"
    sxx, sxy = f"sum({x} * {x}) {_hours(n)}", f"sum({x} * {y}) {_hours(n)}"
    t = "CAST(ICULOS AS BIGINT)"
    rx, rxx, rxy = f"({sx} - {cnt} * {t})", f"({sxx} - 2 * {t} * {sx} + {cnt} * {t} * {t})", f"({sxy} - {t} * {sy})"
    num, den = f"({cnt} * {rxy} - {rx} * {sy})", f"({cnt} * {rxx} - {rx} * {rx})"
    scaled = f"CAST({den} * {10 ** digits} AS HUGEINT)"
    whole = f"((abs(CAST({num} AS HUGEINT)) * {2 * 10 ** 6} + {scaled}) // (2 * {scaled}))"
    return f"CASE WHEN {den} <> 0 THEN sign({num}) * CAST({whole} AS DOUBLE) / 1000000.0 END"


SQL["rolling_by_hour"] = w(V) + "SELECT patient_id, ICULOS, event_id, " + ", ".join(
    r(f"{f}({v}) {_hours(n)}", f"{v.lower()}_{s}_{n}h")
    for n in WINDOWS for v in VITALS
    for s, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
) + ", " + ", ".join(
    r(_exact_slope(v, n), f"{v.lower()}_slope_{n}h") for n in WINDOWS for v in VITALS
) + " FROM v"

# ---- sources and sinks ---------------------------------------------------------------------------

SQL["psv_scan"] = w(V) + f"""SELECT patient_id, ICULOS, {', '.join([*VITALS, *LABS, *DEMOGRAPHICS])}, SepsisLabel FROM v"""
SQL["union_sources"] = w(V) + """SELECT patient_id, ICULOS, HR, CASE WHEN Unit1 = 1 THEN WBC END AS WBC FROM v"""
SQL["split_roundtrip"] = w(V, SPLIT) + """SELECT split, count(*) AS n_rows, CAST(sum(SepsisLabel) AS BIGINT) AS n_positive
FROM v JOIN split USING (patient_id) GROUP BY split"""
SQL["raw_landing_partitions"] = w(V, CHECKED) + f"""SELECT CAST(year(event_ts) AS INTEGER) AS year,
  CAST(month(event_ts) AS INTEGER) AS month, CAST(day(event_ts) AS INTEGER) AS day, count(*) AS n, count(HR) AS n_hr,
  {r('sum(HR)', 'sum_hr')} FROM c WHERE reason IS NULL GROUP BY ALL"""
_STORED = ", ".join(f"{c} AS {c.lower()}" for c in VITALS[:7])


def _newest(n: int) -> str:
    return f"QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY ICULOS DESC, event_id DESC) <= {n}"


SQL["vitals_history"] = w(V) + f"SELECT patient_id, {iso('event_ts', 'timestamp')}, ICULOS AS iculos_hours, {_STORED} FROM v {_newest(72)}"
SQL["chart_series"] = w(V, f"l AS (SELECT * FROM v {_newest(24)})") + f"""SELECT patient_id, count(*) AS n_points,
  {r('max(HR)', 'max_hr')}, {r('min(MAP)', 'min_map')}, count(Temp) AS n_temps FROM l GROUP BY patient_id"""
SQL["proba_history"] = w(V, RUNS) + f"SELECT patient_id, {iso('event_ts', 'timestamp')}, {r('proba', 'proba')}, alarm, streak FROM d {_newest(24)}"
SQL["proba_window"] = w(V, f"l AS (SELECT * FROM v {_newest(48)})") + f"SELECT patient_id, count(*) AS n, {r('sum(proba)', 'sum_proba')} FROM l GROUP BY patient_id"
SQL["alert_log"] = w(V, RUNS) + f"""SELECT patient_id, {iso('event_ts', 'timestamp')}, {r('proba', 'proba')}, ICULOS AS iculos_hours,
  streak AS consecutive_above FROM d WHERE alarm"""
SQL["prediction_archive"] = w(V, RUNS) + f"""SELECT patient_id, ICULOS, {iso('event_ts', 'timestamp')}, {r('proba', 'probability')},
  'v1' AS model_version, CAST(year(event_ts) AS INTEGER) AS year, CAST(month(event_ts) AS INTEGER) AS month,
  CAST(day(event_ts) AS INTEGER) AS day FROM d"""

# ---- alarms and labels ---------------------------------------------------------------------------

SQL["first_alarm"] = w(V, RUNS, OUT) + "SELECT patient_id, t_alarm FROM o"
SQL["onset_rows"] = w(V, RUNS, OUT) + "SELECT patient_id, t_onset FROM o"
SQL["online_decision"] = w(V, RUNS) + f"SELECT patient_id, ICULOS, {r('proba', 'proba')}, streak, muted, alarm FROM d"
SQL["two_level_alarm"] = w(V) + """, t AS (SELECT patient_id, ICULOS, CASE WHEN proba >= 0.7::DOUBLE THEN 'critical'
  WHEN proba >= 0.5::DOUBLE AND lag(proba) OVER (PARTITION BY patient_id ORDER BY ICULOS) >= 0.5::DOUBLE THEN 'warning' END AS level FROM v)
SELECT *, level IS NOT NULL AS fired FROM t"""
SQL["history_gate"] = w(V) + "SELECT patient_id, ICULOS FROM v WHERE ICULOS >= 6"
RELABEL = """f AS (SELECT patient_id, min(ICULOS) FILTER (SepsisLabel = 1) AS first FROM v GROUP BY patient_id),
rl AS (SELECT v.patient_id, ICULOS, SepsisLabel AS old, coalesce(SepsisLabel = 1 AND ICULOS > first + 9, false) AS relabelled
  FROM v JOIN f ON v.patient_id = f.patient_id)"""
SQL["training_labels"] = w(V, SPLIT, RELABEL) + """SELECT split, count(*) AS n_rows,
  CAST(sum(CASE WHEN split = 'train' AND relabelled THEN 0 ELSE old END) AS BIGINT) AS n_positive
FROM rl JOIN split USING (patient_id) GROUP BY split"""
SQL["relabel_late"] = w(V, RELABEL) + """SELECT patient_id, ICULOS, CASE WHEN relabelled THEN 0 ELSE old END AS SepsisLabel, relabelled FROM rl"""
SQL["relabel_stats"] = w(V, RELABEL) + "SELECT count(DISTINCT patient_id) AS patients_modified, count(*) AS rows_flipped FROM rl WHERE relabelled"
SQL["patient_split"] = w(V, SPLIT) + "SELECT patient_id, split FROM split"
SQL["split_stats"] = w(V, SPLIT) + f"""SELECT split, count(*) AS n_rows, count(DISTINCT patient_id) AS n_patients,
  {r('100.0 * sum(SepsisLabel) / count(*)', 'positive_pct')} FROM v JOIN split USING (patient_id) GROUP BY split"""
SQL["leakage_check"] = w(V, SPLIT) + """, x AS (SELECT patient_id FROM split WHERE split = 'train'
  INTERSECT SELECT patient_id FROM split WHERE split <> 'train') SELECT count(*) AS shared, count(*) = 0 AS passed FROM x"""
SQL["class_weights"] = w(V) + f""", c AS (SELECT SepsisLabel, count(*) AS n FROM v GROUP BY SepsisLabel)
SELECT SepsisLabel, n, {r('(SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n)', 'weight')} FROM c"""
SQL["split_membership"] = w(V, SPLIT) + "SELECT patient_id, ICULOS FROM v WHERE patient_id IN (SELECT patient_id FROM split WHERE split = 'val')"

# ---- joins, sampling -----------------------------------------------------------------------------

SECOND = "s2 AS (SELECT patient_id, ICULOS, second_proba FROM v WHERE event_id % 50 <> 0)"
SQL["join_scores"] = w(V, SECOND) + f"""SELECT v.patient_id, v.ICULOS, SepsisLabel, {r('proba', 'proba')}, {r('s2.second_proba', 'second_proba')}
FROM v JOIN s2 ON v.patient_id = s2.patient_id AND v.ICULOS = s2.ICULOS"""
SQL["join_audit"] = w(V, SECOND) + """, j AS (SELECT 1 FROM v JOIN s2 ON v.patient_id = s2.patient_id AND v.ICULOS = s2.ICULOS),
c AS (SELECT (SELECT count(*) FROM v) AS n_first, (SELECT count(*) FROM s2) AS n_second, (SELECT count(*) FROM j) AS n_joined)
SELECT *, n_first = n_joined AND n_second = n_joined AS complete FROM c"""
SQL["seeded_sample"] = "SELECT event_id, user_id FROM events ORDER BY md5(concat('42|', CAST(event_id AS VARCHAR))), event_id LIMIT 500"

# ---- evaluation ----------------------------------------------------------------------------------

SQL["patient_utility"] = w(V, RUNS, OUT) + f"SELECT patient_id, t_onset, t_alarm, {r('utility', 'utility')} FROM u"
SQL["normalized_utility"] = w(V, RUNS, OUT) + f"SELECT {_UTIL_ROW} FROM u"
SQL["utility_official"] = w(V, RUNS, OUT) + f"""SELECT {r('sum(utility)', 'observed')},
  {r('-2.0::DOUBLE * count(t_onset)', 'inaction')}, CAST(count(t_onset) AS DOUBLE) AS perfect,
  {r('CASE WHEN count(t_onset) > 0 THEN (sum(utility) + 2 * count(t_onset)) / (3.0::DOUBLE * count(t_onset)) ELSE 0 END', 'normalized')} FROM u"""
_CONFUSION = f"""count(*) FILTER (proba < {THR} AND SepsisLabel = 0) AS tn, count(*) FILTER (proba >= {THR} AND SepsisLabel = 0) AS fp,
  count(*) FILTER (proba < {THR} AND SepsisLabel = 1) AS fn, count(*) FILTER (proba >= {THR} AND SepsisLabel = 1) AS tp"""
SQL["hourly_confusion"] = w(V) + f"SELECT {_CONFUSION} FROM v"
CURVE = """gs AS (SELECT proba AS threshold, sum(SepsisLabel) AS pos, sum(1 - SepsisLabel) AS neg FROM v GROUP BY proba),
cs AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp,
  sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM gs)"""
# By definition: every positive-negative pair, ties counting half.
_PAIRS = """(SELECT sum(CASE WHEN a.threshold > b.threshold THEN a.pos * b.neg WHEN a.threshold = b.threshold
  THEN a.pos * b.neg / 2.0::DOUBLE ELSE 0 END) / (max(a.p) * max(b.n)) FROM cs a, cs b)"""
_AP = "(SELECT sum(pos::DOUBLE / p * tp / (tp + fp)) FROM cs)"
_SENS = """(SELECT tp::DOUBLE / p AS sensitivity, threshold FROM cs WHERE 1 - fp::DOUBLE / n >= 0.95::DOUBLE
  ORDER BY sensitivity DESC, threshold DESC LIMIT 1)"""
SQL["auroc"] = w(V, CURVE) + f"SELECT {r(_PAIRS, 'auroc')}"
SQL["average_precision"] = w(V, CURVE) + f"SELECT {r(_AP, 'average_precision')}"
SQL["roc_curve"] = w(V, CURVE) + f"""SELECT {r('threshold', 'threshold')}, {r('fp::DOUBLE / n', 'fpr')}, {r('tp::DOUBLE / p', 'tpr')} FROM cs
UNION ALL SELECT 'Infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE"""
SQL["pr_curve"] = w(V, CURVE) + f"""SELECT {r('threshold', 'threshold')}, {r('tp::DOUBLE / (tp + fp)', 'precision')}, {r('tp::DOUBLE / p', 'recall')} FROM cs
UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE"""
SQL["sens_at_spec"] = w(V, CURVE) + f"SELECT {r('sensitivity', 'sensitivity')}, {r('threshold', 'threshold')} FROM {_SENS}"
RESULTS = """res AS (SELECT patient_id, t_onset IS NOT NULL AS is_sepsis, t_alarm IS NOT NULL AS has_alarm, t_onset, t_alarm,
  CASE WHEN t_alarm <= t_onset THEN t_onset - t_alarm END AS alert_ahead_h, max_proba FROM o)"""
SQL["per_patient_results"] = w(V, RUNS, OUT, RESULTS) + f"SELECT * REPLACE ({r('max_proba', 'max_proba')}) FROM res"
SQL["result_csv"] = SQL["result_json"] = SQL["per_patient_results"]
_LEAD = f"""{r('avg(alert_ahead_h)', 'alert_ahead_mean_h')}, count(alert_ahead_h) AS alert_ahead_n_patients,
  {r('quantile_cont(alert_ahead_h, 0.5)', 'alert_ahead_median_h')}"""
SQL["lead_time_stats"] = w(V, RUNS, OUT, RESULTS) + f"SELECT {_LEAD} FROM res"

THRESHOLDS = "thr AS (SELECT i, 0.02::DOUBLE + i * 0.02::DOUBLE AS threshold FROM range(47) t(i))"
KNOBS = "knobs AS (SELECT k, wu FROM (VALUES (1),(2),(3),(4),(6),(8),(12),(16)) a(k), (VALUES (0),(6),(12),(18),(24),(36),(48)) b(wu))"


def _grid(source: str) -> str:
    """Run lengths per threshold, then the first long enough run of every patient and setting."""
    return f"""{THRESHOLDS}, {KNOBS},
q AS (SELECT patient_id, pos, i, CAST(proba >= threshold AS INTEGER) AS up FROM {source}, thr),
qg AS (SELECT *, sum(1 - up) OVER (PARTITION BY patient_id, i ORDER BY pos) AS grp FROM q),
qs AS (SELECT patient_id, i, pos, sum(up) OVER (PARTITION BY patient_id, i, grp ORDER BY pos) AS run FROM qg),
fa AS (SELECT patient_id, i, k, wu, min(pos - k + 1) AS t_alarm FROM qs JOIN knobs ON run >= k AND pos - k + 1 >= wu
  GROUP BY ALL),
pt AS (SELECT patient_id, min(CASE WHEN SepsisLabel = 1 THEN pos END) AS t_onset FROM {source} GROUP BY patient_id),
full_grid AS (SELECT pt.patient_id, t_onset, thr.i, threshold, knobs.k, knobs.wu, t_alarm FROM pt CROSS JOIN thr CROSS JOIN knobs
  LEFT JOIN fa ON fa.patient_id = pt.patient_id AND fa.i = thr.i AND fa.k = knobs.k AND fa.wu = knobs.wu),
gu AS (SELECT *, {_UTILITY} AS utility FROM full_grid),
grid AS (SELECT threshold AS thr0, CAST(k AS INTEGER) AS min_consecutive, CAST(wu AS INTEGER) AS warmup_hours, {_UTIL_ROW}
  FROM gu GROUP BY threshold, k, wu)"""


_GRID_COLUMNS = f"{r('thr0', 'threshold')}, * EXCLUDE (thr0)"
_BEST = "ORDER BY round(normalized_utility, 9) DESC, thr0, min_consecutive, warmup_hours LIMIT 1"
SQL["tune_grid"] = w(V, RUNS, _grid("p")) + f"SELECT {_GRID_COLUMNS} FROM grid"
SQL["tune_best"] = w(V, RUNS, _grid("p")) + f"SELECT {_GRID_COLUMNS} FROM grid {_BEST}"
SQL["apply_best_params"] = w(
    V, RUNS, SPLIT, "pv AS (SELECT p.* FROM p JOIN split USING (patient_id) WHERE split = 'val')", _grid("pv"),
    f"best AS (SELECT * FROM grid {_BEST})",
    """tp0 AS (SELECT p.* EXCLUDE (up), CAST(proba >= thr0 AS INTEGER) AS up, min_consecutive AS kk, warmup_hours AS ww
  FROM p JOIN split USING (patient_id) CROSS JOIN best WHERE split = 'test')""",
    "tg AS (SELECT *, sum(1 - up) OVER (PARTITION BY patient_id ORDER BY pos) AS grp FROM tp0)",
    "ts AS (SELECT *, sum(up) OVER (PARTITION BY patient_id, grp ORDER BY pos) AS run FROM tg)",
    f"ot AS ({_outcomes('ts', 'kk', 'ww')}), ut AS (SELECT *, {_UTILITY} AS utility FROM ot)",
) + f"SELECT {_UTIL_ROW}, {r('(SELECT thr0 FROM best)', 'threshold')}, (SELECT min_consecutive FROM best) AS min_consecutive, (SELECT warmup_hours FROM best) AS warmup_hours FROM ut"

SUMMARY = f"""sens AS (SELECT * FROM {_SENS}), conf AS (SELECT {_CONFUSION} FROM v), lead AS (SELECT {_LEAD} FROM res),
ur AS (SELECT {_UTIL_ROW} FROM u)"""
SQL["eval_summary"] = w(V, RUNS, OUT, RESULTS, CURVE, SUMMARY) + f"""SELECT ur.*, {r(THR, 'threshold')}, {RUN} AS min_consecutive,
  {WARM} AS warmup_hours, {r(_PAIRS, 'auroc')}, {r(_AP, 'auprc')}, {r('sensitivity', 'sensitivity_at_spec')},
  {r('sens.threshold', 'threshold_at_spec')}, conf.tn AS cm_tn, conf.fp AS cm_fp, conf.fn AS cm_fn, conf.tp AS cm_tp, lead.*
FROM ur, sens, conf, lead"""
SQL["metric_gate"] = w(V, RUNS, OUT, RESULTS, CURVE, SUMMARY) + f"""SELECT normalized_utility, {r(_PAIRS, 'auroc')},
  {r('sensitivity', 'sensitivity_at_spec')}, normalized_utility >= 0.35 AS utility_ok, {_PAIRS} >= 0.8 AS auroc_ok,
  sensitivity >= 0.4 AS sensitivity_ok, normalized_utility >= 0.35 AND {_PAIRS} >= 0.8 AND sensitivity >= 0.4 AS promote FROM ur, sens"""
SQL["brier"] = w(V) + f"SELECT {r('avg((proba - SepsisLabel) * (proba - SepsisLabel))', 'brier')} FROM v"
SQL["reliability_bins"] = w(V) + f"""SELECT CAST(least(floor(proba * 10), 9) AS INTEGER) AS bin, count(*) AS n,
  {r('avg(proba)', 'mean_proba')}, {r('avg(SepsisLabel)', 'observed')} FROM v GROUP BY bin"""
SUBGROUPS = f"""sg AS (
  SELECT a.attribute, a.value, {_CONFUSION} FROM v, LATERAL (VALUES
    ('age', CASE WHEN Age < 50 THEN '<50' WHEN Age <= 70 THEN '50-70' ELSE '>70' END),
    ('gender', CASE WHEN Gender = 1 THEN '1' ELSE '0' END),
    ('unit', CASE WHEN Unit1 = 1 THEN '1' WHEN Unit2 = 1 THEN '2' ELSE 'none' END),
    ('time', CASE WHEN ICULOS < 24 THEN 'early' ELSE 'late' END)) a(attribute, value)
  GROUP BY a.attribute, a.value),
sm AS (SELECT *, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) END AS sensitivity,
  CASE WHEN tn + fp > 0 THEN tn::DOUBLE / (tn + fp) END AS specificity FROM sg)"""
SQL["subgroup_metrics"] = w(V, SUBGROUPS) + f"SELECT attribute, value, tp, fn, fp, tn, {r('sensitivity', 'sensitivity')}, {r('specificity', 'specificity')} FROM sm"
SQL["subgroup_gaps"] = w(V, SUBGROUPS) + f"""SELECT attribute, {r('max(sensitivity) - min(sensitivity)', 'sensitivity_gap')},
  max(sensitivity) - min(sensitivity) <= 0.15::DOUBLE AS passed FROM sm GROUP BY attribute"""
SQL["record_counters"] = w(
    V, CHECKED,
    f"""ok AS (SELECT patient_id, ICULOS, event_id, row_number() OVER (PARTITION BY patient_id ORDER BY ICULOS, event_id) AS pos,
  CAST(proba >= {THR} AS INTEGER) AS up FROM c WHERE reason IS NULL AND event_id % 40 <> 0)""",
    "og AS (SELECT *, sum(1 - up) OVER (PARTITION BY patient_id ORDER BY pos) AS grp FROM ok)",
    "os AS (SELECT *, sum(up) OVER (PARTITION BY patient_id, grp ORDER BY pos) AS run FROM og)",
) + f"""SELECT (SELECT count(*) FROM c WHERE reason IS NULL) AS processed, (SELECT count(*) FROM c WHERE reason IS NOT NULL) AS invalid,
  (SELECT count(*) FROM os) AS predicted, (SELECT count(*) FROM os WHERE run >= {RUN} AND ICULOS >= {WARM}) AS alarms,
  (SELECT count(*) FROM c WHERE reason IS NULL AND event_id % 40 = 0) AS predict_errors"""

# ---- telemetry -----------------------------------------------------------------------------------

SQL["event_rate"] = f"""SELECT {iso("time_bucket(INTERVAL '1 minute', ts)", 'window_start')}, event_type AS handler, count(*) AS n,
  {r('count(*) / 60.0::DOUBLE', 'per_second')} FROM events GROUP BY time_bucket(INTERVAL '1 minute', ts), event_type"""
SQL["error_rate"] = f"""SELECT {iso("time_bucket(INTERVAL '5 minutes', ts)", 'window_start')}, count(*) AS n,
  count(*) FILTER (event_type = 'error') AS n_errors, {r("count(*) FILTER (event_type = 'error') / 300.0::DOUBLE", 'errors_per_second')},
  {r("count(*) FILTER (event_type = 'error')::DOUBLE / count(*)", 'error_share')} FROM events GROUP BY time_bucket(INTERVAL '5 minutes', ts)"""
SQL["status_counts"] = """SELECT event_type AS handler, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, count(*) AS n
FROM events GROUP BY event_type"""
_LIMITS = [5, 10, 25, 50, 75, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10000]
_EDGES = "ed AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {le}::DOUBLE)" for i, le in enumerate([*_LIMITS, "'Infinity'"])
) + ") t(bucket, le))"


def _histogram(width: str) -> str:
    return f"""{_EDGES}, ws AS (SELECT DISTINCT time_bucket(INTERVAL '{width}', ts) AS ws FROM events),
hg AS (SELECT ws.ws, bucket, le, (count(value) FILTER (value <= le)) AS n FROM ws CROSS JOIN ed
  JOIN events ON time_bucket(INTERVAL '{width}', ts) = ws.ws GROUP BY ws.ws, bucket, le)"""


SQL["latency_histogram"] = w(_histogram("1 hour")) + f"SELECT {iso('ws', 'window_start')}, bucket, le, n FROM hg"
SQL["latency_p95"] = w(
    _histogram("5 minutes"),
    """hh AS (SELECT *, 0.95::DOUBLE * max(n) OVER (PARTITION BY ws) AS rank, lag(n, 1, 0) OVER (PARTITION BY ws ORDER BY bucket) AS seen,
  lag(le, 1, 0) OVER (PARTITION BY ws ORDER BY bucket) AS lower FROM hg)""",
) + f"""SELECT {iso('ws', 'window_start')}, {r("CASE WHEN isinf(le) THEN lower ELSE lower + (le - lower) * (rank - seen) / (n - seen) END", 'latency_ms')}
FROM hh WHERE n >= rank AND seen < rank AND rank > 0"""

# ---- drift, quality, preparation -----------------------------------------------------------------

_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value, CAST(event_ts < TIMESTAMP '2024-01-16' AS INTEGER) AS is_ref FROM v WHERE {c} IS NOT NULL"
    for c in VITALS
)
DRIFT = f"""lv AS ({_LONG}),
dc AS (SELECT feature, value, sum(is_ref) AS rr, sum(1 - is_ref) AS cc FROM lv GROUP BY feature, value),
dd AS (SELECT *, sum(rr) OVER (PARTITION BY feature ORDER BY value) AS cr, sum(cc) OVER (PARTITION BY feature ORDER BY value) AS ccum,
  sum(rr) OVER (PARTITION BY feature) AS nr, sum(cc) OVER (PARTITION BY feature) AS nc,
  lead(value) OVER (PARTITION BY feature ORDER BY value) - value AS width FROM dc),
dg AS (SELECT feature, CAST(max(nr) AS BIGINT) AS n_ref, CAST(max(nc) AS BIGINT) AS n_cur,
  max(abs(cr / nr::DOUBLE - ccum / nc::DOUBLE)) AS ks, sum(abs(cr / nr::DOUBLE - ccum / nc::DOUBLE) * width) AS area FROM dd GROUP BY feature),
dx AS (SELECT dg.*, ks * ks * n_ref * n_cur / (n_ref + n_cur) AS x, sp.spread FROM dg JOIN
  (SELECT feature, stddev_pop(value) AS spread FROM lv WHERE is_ref = 1 GROUP BY feature) sp USING (feature)),
dp AS (SELECT feature, n_ref, n_cur, ks, CASE WHEN x < 0.04 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, list_sum(list_transform(
  range(1, 101), lambda j: CASE WHEN j % 2 = 1 THEN 2.0::DOUBLE ELSE -2.0::DOUBLE END * exp(-2.0::DOUBLE * j * j * x))))) END AS p_value,
  area / greatest(spread, 0.001::DOUBLE) AS wasserstein FROM dx),
df AS (SELECT *, wasserstein >= 0.1::DOUBLE AS drifted FROM dp)"""
_KS = f"feature, n_ref, n_cur, {r('ks', 'ks')}, {r('p_value', 'p_value')}"
SQL["ks_drift"] = w(V, DRIFT) + f"SELECT {_KS}, p_value < 0.05::DOUBLE AS drifted FROM df"
SQL["drift_columns"] = w(V, DRIFT) + f"SELECT {_KS}, {r('wasserstein', 'wasserstein')}, drifted FROM df"
SQL["drift_summary"] = w(V, DRIFT) + f"""SELECT count(*) FILTER (drifted) AS n_drifted, count(*) AS n_columns,
  {r('count(*) FILTER (drifted)::DOUBLE / count(*)', 'share')}, count(*) FILTER (drifted)::DOUBLE / count(*) >= 0.5 AS dataset_drift,
  count(*) FILTER (drifted)::DOUBLE / count(*) >= 0.3 AS notify FROM df"""
PSI = f"""lv AS ({_LONG}),
ce AS (SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM lv WHERE is_ref = 1 GROUP BY feature),
bn AS (SELECT feature, len(list_filter(edges, lambda e: value > e)) AS bin, sum(is_ref) AS rr, sum(1 - is_ref) AS cc
  FROM lv JOIN ce USING (feature) GROUP BY ALL),
bp AS (SELECT feature, greatest(cc / sum(cc) OVER (PARTITION BY feature), 0.0001::DOUBLE) AS p,
  greatest(rr / sum(rr) OVER (PARTITION BY feature), 0.0001::DOUBLE) AS q FROM bn),
ps AS (SELECT feature, sum((p - q) * ln(p / q)) AS psi FROM bp GROUP BY feature),
pb AS (SELECT feature, psi, CASE WHEN psi < 0.10 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'severe' END AS band FROM ps)"""
SQL["psi_drift"] = w(V, PSI) + f"SELECT feature, {r('psi', 'psi')}, band FROM pb"
SQL["psi_alert"] = w(V, PSI) + "SELECT count(*) FILTER (band = 'severe') AS n_severe, count(*) FILTER (band = 'severe') >= 3 AS notify FROM pb"


def _dq(name: str, bad: str) -> str:
    passed = "count(*) FILTER ({0}) < 0.3 * count(*)" if "share" in name else "count(*) FILTER ({0}) = 0"
    return f"SELECT count(*) AS n, '{name}' AS expectation, count(*) FILTER ({bad}) AS n_failed, {passed.format(bad)} AS passed FROM t"


SQL["dq_report"] = w(
    V, "t AS (SELECT *, ICULOS <= lag(ICULOS) OVER (PARTITION BY patient_id ORDER BY event_ts, event_id) AS back FROM v)"
) + " UNION ALL ".join(
    _dq(n, b)
    for n, b in {
        "patient_id not null": "patient_id IS NULL",
        "patient_id pattern": "NOT regexp_matches(patient_id, '^[Pp][0-9]+$')",
        "HR between 20 and 250": "HR NOT BETWEEN 20 AND 250", "HR null share": "HR IS NULL",
        "O2Sat between 50 and 100": "O2Sat NOT BETWEEN 50 AND 100", "O2Sat null share": "O2Sat IS NULL",
        "Temp between 30 and 45": "Temp NOT BETWEEN 30 AND 45", "ICULOS not null": "ICULOS IS NULL",
        "ICULOS grows per patient": "back", "SepsisLabel in 0, 1": "SepsisLabel NOT IN (0, 1)",
    }.items()
)


def _fill(column: str, source: str | None = None) -> str:
    return f"""last_value({source or column} IGNORE NULLS) OVER (PARTITION BY patient_id ORDER BY ICULOS
    RANGE BETWEEN 4 PRECEDING AND CURRENT ROW)"""


SQL["ffill_4h"] = w(V) + "SELECT patient_id, ICULOS, " + ", ".join(f"{_fill(c)} AS {c}" for c in VITALS) + " FROM v"
_AGE = "CASE WHEN Age < 50 THEN 0 WHEN Age <= 70 THEN 1 ELSE 2 END"
SQL["impute_group_mean"] = w(
    V, "ff AS (SELECT patient_id, ICULOS, Age, Gender, " + ", ".join(f"{_fill(c)} AS {c}" for c in VITALS) + " FROM v)"
) + "SELECT patient_id, ICULOS, Age, Gender, " + ", ".join(
    r(f"coalesce({c}, avg({c}) OVER (PARTITION BY {_AGE}, Gender))", c) for c in VITALS
) + " FROM ff"
_TIGHT = {"HR": (20, 250), "O2Sat": (50, 100), "Temp": (30, 45)}
SQL["outlier_null"] = w(V) + "SELECT patient_id, ICULOS, " + ", ".join(
    f"{_fill(c, f'CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END')} AS {c}" for c, (lo, hi) in _TIGHT.items()
) + " FROM v"
SQL["lab_flags"] = w(V) + "SELECT patient_id, ICULOS, " + ", ".join(
    [f"CAST({c} IS NULL AS INTEGER) AS missing_{c.lower()}" for c in LABS]
    + [f"CAST(count({c}) {_hours(24)} > 0 AS INTEGER) AS measured_{c.lower()}_24h" for c in LABS]
) + " FROM v"
SQL["hours_since_last"] = w(V) + "SELECT patient_id, ICULOS, event_id, " + ", ".join(
    f"ICULOS - max(CASE WHEN {c} IS NOT NULL THEN ICULOS END) OVER (PARTITION BY patient_id ORDER BY ICULOS) AS since_{c.lower()}"
    for c in VITALS
) + " FROM v"
SQL["interaction_features"] = w(V) + f"""SELECT a.patient_id, a.ICULOS, {r('a.HR / nullif(a.SBP, 0)', 'shock_index')},
  {r('a.Resp / nullif(a.HR, 0)', 'resp_hr_ratio')}, {r('a.MAP - b.MAP', 'map_delta_24h')}
FROM v a LEFT JOIN v b ON a.patient_id = b.patient_id AND b.ICULOS = a.ICULOS - 24"""
SQL["labs_long"] = w(V) + " UNION ALL ".join(
    f"SELECT patient_id, ICULOS, '{c}' AS name, {c} AS value FROM v WHERE {c} IS NOT NULL" for c in _LAB_STEP
)
SQL["labs_wide"] = w(V) + """SELECT patient_id, ICULOS, """ + f"""{', '.join(LABS)} FROM v
WHERE coalesce({', '.join(LABS)}) IS NOT NULL"""

# ---- views ---------------------------------------------------------------------------------------

LATEST = f"st AS (SELECT patient_id, proba AS latest_proba, alarm AS latest_alarm, {iso('event_ts', 'last_update')}, ICULOS AS iculos_hours FROM d {_newest(1)})"
SQL["active_patients"] = w(V, RUNS, LATEST) + f"SELECT * REPLACE ({r('latest_proba', 'latest_proba')}), {_band('latest_proba', '0.1::DOUBLE')} AS band FROM st"
SQL["latest_state_join"] = w(
    V, RUNS, f"pr AS (SELECT patient_id, alarm, {iso('event_ts', 'ts')} FROM d WHERE alarm OR muted {_newest(1)})",
    f"me AS (SELECT patient_id, ICULOS AS h FROM d WHERE ICULOS >= 55 {_newest(1)})",
    f"la AS (SELECT patient_id, proba FROM d {_newest(1)})",
) + f"""SELECT la.patient_id, {r('la.proba', 'latest_proba')}, coalesce(pr.alarm, false) AS latest_alarm, coalesce(pr.ts, '') AS last_update,
  coalesce(me.h, 0) AS iculos_hours FROM la LEFT JOIN pr ON la.patient_id = pr.patient_id LEFT JOIN me ON la.patient_id = me.patient_id"""
SQL["overlay_merge"] = w(
    V, RUNS, f"sn AS (SELECT patient_id, proba, alarm, event_ts, ICULOS FROM d WHERE event_ts < TIMESTAMP '2024-01-25' {_newest(1)})",
    "li AS (SELECT patient_id, proba, alarm, event_ts, ICULOS FROM d WHERE alarm QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY event_ts DESC) = 1)",
    """mg AS (SELECT coalesce(s.patient_id, l.patient_id) AS patient_id, s.patient_id IS NULL OR coalesce(l.event_ts > s.event_ts, false) AS live,
  s.proba AS sp, l.proba AS lp, s.alarm AS sa, s.event_ts AS st, l.event_ts AS lt, s.ICULOS AS sh, l.ICULOS AS lh
  FROM sn s FULL OUTER JOIN li l ON s.patient_id = l.patient_id)""",
) + f"""SELECT patient_id, {r('CASE WHEN live THEN lp ELSE sp END', 'latest_proba')}, CASE WHEN live THEN true ELSE sa END AS latest_alarm,
  {iso('CASE WHEN live THEN lt ELSE st END', 'last_update')}, CASE WHEN live THEN lh ELSE sh END AS iculos_hours FROM mg"""
ALERTS = """al AS (SELECT event_id AS alert_id, patient_id, event_ts AS ts, proba, ICULOS AS iculos_hours, streak AS consecutive_above FROM d WHERE alarm),
ak AS (
  SELECT CASE WHEN alert_id % 30 = 0 THEN alert_id + 1000000000000 ELSE alert_id END AS alert_id,
    CASE alert_id % 5 % 3 WHEN 0 THEN 'ann' WHEN 1 THEN 'bob' ELSE 'eve' END AS username, ts + INTERVAL 10 MINUTE AS ack_ts, 1 AS seq
  FROM al WHERE alert_id % 3 = 0
  UNION ALL SELECT alert_id, 'bob', ts + INTERVAL 20 MINUTE, 2 FROM al WHERE alert_id % 6 = 0),
la AS (SELECT * FROM ak WHERE username <> 'eve' QUALIFY row_number() OVER (PARTITION BY alert_id ORDER BY ack_ts DESC, seq DESC) = 1),
fo AS (SELECT al.*, la.alert_id IS NOT NULL AS acknowledged, username AS acknowledged_by, ack_ts AS acknowledged_at
  FROM al LEFT JOIN la ON al.alert_id = la.alert_id)"""
_ALERT = f"alert_id, patient_id, {iso('ts', 'timestamp')}, {r('proba', 'proba')}, iculos_hours, consecutive_above"
SQL["alert_ack_fold"] = w(V, RUNS, ALERTS) + f"SELECT {_ALERT}, acknowledged, acknowledged_by, {iso('acknowledged_at', 'acknowledged_at')} FROM fo"
SQL["orphan_acks"] = w(V, RUNS, ALERTS) + f"SELECT alert_id, username, {iso('ack_ts', 'ack_ts')}, seq FROM ak WHERE alert_id NOT IN (SELECT alert_id FROM al)"
SQL["alerts_feed"] = w(V, RUNS, ALERTS) + f"SELECT {_ALERT}, acknowledged FROM fo WHERE NOT acknowledged ORDER BY ts DESC, patient_id LIMIT 50"
SQL["live_feed"] = w(V, RUNS, ALERTS) + f"SELECT {_ALERT} FROM al ORDER BY ts DESC, patient_id LIMIT 200"
SQL["board_counts"] = w(V, RUNS, LATEST, ALERTS, f"bd AS (SELECT {_band('latest_proba', '0.1::DOUBLE')} AS band FROM st WHERE patient_id LIKE '%1%')") + """SELECT
  count(*) AS n_all, count(*) FILTER (band = 'critical') AS n_critical, count(*) FILTER (band = 'warn') AS n_warn, count(*) FILTER (band = 'ok') AS n_ok,
  (SELECT count(*) FILTER (acknowledged) FROM fo WHERE patient_id LIKE '%1%') AS n_acknowledged,
  (SELECT count(*) FILTER (NOT acknowledged) FROM fo WHERE patient_id LIKE '%1%') AS n_open FROM bd"""



def _suppressed(hours: int) -> str:
    return "WITH RECURSIVE " + ",\n".join([V, RUNS, ALERTS, f"""em AS (SELECT patient_id, min(ts) AS ts FROM al GROUP BY patient_id
  UNION ALL SELECT em.patient_id, (SELECT min(al.ts) FROM al WHERE al.patient_id = em.patient_id AND al.ts >= em.ts + INTERVAL {hours} HOUR)
  FROM em WHERE EXISTS (SELECT 1 FROM al WHERE al.patient_id = em.patient_id AND al.ts >= em.ts + INTERVAL {hours} HOUR))"""]) + f"""
SELECT {_ALERT} FROM al WHERE (patient_id, ts) IN (SELECT (patient_id, ts) FROM em)"""


SQL["alert_dedup"] = _suppressed(1)
SQL["alert_dedup_day"] = _suppressed(24)

# ---- streams: the same as in batch, over checked records ------------------------------------------

OK = "v0 AS (SELECT * FROM c WHERE reason IS NULL)"
SQL["stream_validated"] = w(V, CHECKED) + f"SELECT patient_id, ICULOS, {', '.join(VITALS)} FROM c WHERE reason IS NULL"
SQL["stream_quarantine"] = SQL["quarantine_counts"]
SQL["stream_features"] = w(V, CHECKED, OK, RANKED.replace("FROM v)", "FROM v0)")) + _feature_select()
SQL["stream_decisions"] = SQL["online_decision"]
SQL["stream_alerts"] = SQL["alert_log"]
SQL["stream_landing"] = w(V, CHECKED) + """SELECT CAST(year(event_ts) AS INTEGER) AS year,
  CAST(month(event_ts) AS INTEGER) AS month, CAST(day(event_ts) AS INTEGER) AS day, count(*) AS n FROM c WHERE reason IS NULL GROUP BY ALL"""
SQL["stream_latest"] = w(V, CHECKED) + f"SELECT patient_id, ICULOS, event_id, {', '.join(VITALS)} FROM c WHERE reason IS NULL {_newest(1)}"
