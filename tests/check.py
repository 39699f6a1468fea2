"""Compare every catalogue query with its SQL: ``python tests/check.py SF_DIR [key ...]``."""

from __future__ import annotations

import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return (0, "")
    if isinstance(x, bool):
        return (1, str(x))
    if isinstance(x, (int, float)):
        return (2, f"{float(x):.6f}")
    return (3, str(x))


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql) -> str:
    """Empty when both give the same columns and rows."""
    left = as_rows(spark_df.columns, spark_df.collect())
    cursor = con.execute(sql)
    right = as_rows([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return f"columns {sorted(set(left[0]) ^ set(right[0]))}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(c, x[1], y[1]) for c, x, y in zip(left[0], a, b) if x != y]
        return f"{len(wrong)} of {len(left[1])} rows differ, first in {cells[:4]}"
    return ""


def main() -> int:
    import __spark_entry__ as entry
    from vigil.session import build_session

    sf_dir, keys = sys.argv[1], sys.argv[2:]
    spark = build_session("check", 8, 8)
    con = oracle_connection(sf_dir)
    found, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in keys or found:
        start = time.time()
        try:
            if key in sqls:
                problem = differences(found[key](spark, sf_dir), con, sqls[key])
            else:
                problem = "" if found[key](spark, sf_dir).count() else "no rows"
        except Exception as exc:  # report and go on with the next query
            problem = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += bool(problem)
        print(f"{'ok  ' if not problem else 'FAIL'} {key} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main() > 0)
