"""Slopes by the hour from exact sums: decimal ties round the same way in Spark and in DuckDB."""

from fractions import Fraction

import duckdb
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.operators.prep import exact_slope
from vigil.plans.oracle import _exact_slope

ROWS = [("p", 1, 10.0), ("p", 9, 10.0001), ("p", 10, None), ("q", 1, 97.5), ("q", 2, 97.5), ("r", 3, 5.0),
        ("s", 1, 1.0), ("s", 2, 2.5), ("s", 5, 2.0), ("s", 13, 4.1)]


def half_away(x: Fraction) -> float:
    sign = -1 if x < 0 else 1
    return sign * float(Fraction(int(abs(x) * 10**6 + Fraction(1, 2)), 10**6))


def plain(rows, n=24):
    out = {}
    for pid, hour, _ in rows:
        seen = [(h, Fraction(str(v))) for p, h, v in rows if p == pid and hour - n < h <= hour and v is not None]
        k = len(seen)
        sx, sy = sum(h for h, _ in seen), sum(v for _, v in seen)
        den = k * sum(h * h for h, _ in seen) - sx * sx
        out[(pid, hour)] = half_away((k * sum(h * v for h, v in seen) - sx * sy) / den) if den else None
    return out


def test_ties_and_nulls_agree(spark):
    want = plain(ROWS)
    assert want[("p", 9)] == 1.3e-05  # 0.0000125, a tie at the seventh digit
    df = spark.createDataFrame(ROWS, "patient_id string, ICULOS int, HR double")
    frame = Window.partitionBy("patient_id").orderBy("ICULOS").rangeBetween(-23, 0)
    got = {(r.patient_id, r.ICULOS): r.s for r in df.select("patient_id", "ICULOS", exact_slope("HR", frame).alias("s")).collect()}
    assert got == want
    con = duckdb.connect()
    con.execute("CREATE TABLE v (patient_id VARCHAR, ICULOS INTEGER, HR DOUBLE)")
    con.executemany("INSERT INTO v VALUES (?, ?, ?)", ROWS)
    sql = {(p, h): s for p, h, s in con.execute(f"SELECT patient_id, ICULOS, {_exact_slope('HR', 24)} FROM v").fetchall()}
    assert sql == want
