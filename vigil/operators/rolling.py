"""Rolling statistics over the newest rows of each patient, and the full feature row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.functions.rules import missing_flags, qsofa, sirs
from vigil.operators.slices import COPY, POS, SLICE, last_rows, sliced, unsliced
from vigil.schema import (
    HOUR, KEY, LABEL, MODEL_DEMOGRAPHICS, ORDER, STATS, VITALS, WINDOWS, feature_name, feature_names,
)


# A block of rows is summed up by: count, sum, squared deviations, deviations times rank, extremes.
# Expressions are SQL text: hundreds of them are parsed at once instead of being built call by call.
_PARTS = ("n", "s", "q", "c", "lo", "hi")


def _part(part: str, vital: str, size: int) -> str:
    return f"_{part}_{vital}_{size}"


def _single(vital: str) -> list[str]:
    parts = {
        "n": f"if({vital} is null, 0D, 1D)", "s": f"coalesce({vital}, 0D)", "q": "0D", "c": "0D",
        "lo": vital, "hi": vital,
    }
    return [f"{e} AS {_part(p, vital, 1)}" for p, e in parts.items()]


def _older(part: str, vital: str, size: int) -> str:
    return f"_older_{part}_{vital}_{size}"


def _lagged(vital: str, old: int, new: int, size: int, over: str) -> list[str]:
    return [
        f"lag({_part(p, vital, old)}, {new}, {'NULL' if p in ('lo', 'hi') else '0D'}) OVER ({over})"
        f" AS {_older(p, vital, size)}"
        for p in _PARTS
    ]


def _merged(vital: str, new: int, size: int) -> list[str]:
    """Join the newest ``new`` rows with the older rows of the block (pairwise update of moments)."""
    a = {p: _older(p, vital, size) for p in _PARTS}
    b = {p: _part(p, vital, new) for p in _PARTS}
    both = f"{a['n']} * {b['n']}"
    n = f"({a['n']} + {b['n']})"
    gap = f"({b['s']} / greatest({b['n']}, 1D) - {a['s']} / greatest({a['n']}, 1D))"
    parts = {
        "n": n,
        "s": f"{a['s']} + {b['s']}",
        "q": f"{a['q']} + {b['q']} + {gap} * {gap} * {both} / greatest({n}, 1D)",
        "c": f"{a['c']} + {b['c']} + {gap} * {both} / 2D",
        "lo": f"least({a['lo']}, {b['lo']})",
        "hi": f"greatest({a['hi']}, {b['hi']})",
    }
    return [f"{e} AS {_part(p, vital, size)}" for p, e in parts.items()]


def _statistic(stat: str, vital: str, size: int) -> str:
    n, s, q, c, lo, hi = (_part(p, vital, size) for p in _PARTS)
    return {
        "mean": f"if({n} > 0, {s} / {n}, NULL)",
        "std": f"if({n} > 0, sqrt({q} / {n}), NULL)",
        "min": lo,
        "max": hi,
        # Least squares against the rank among recorded values; a single value has slope 0.
        "slope": f"CASE WHEN {n} > 1 THEN {c} * 12D / ({n} * ({n} * {n} - 1)) WHEN {n} = 1 THEN 0D END",
    }[stat]


def _ladder(windows) -> list[int]:
    """Block sizes to build, smallest first: each is its newer half plus its older half."""
    sizes, todo = set(), list(windows)
    while todo:
        size = todo.pop()
        if size > 1 and size not in sizes:
            sizes.add(size)
            todo += [size - size // 2, size // 2]
    return sorted(sizes)


def rolling(df, stats=STATS, vitals=VITALS, windows=WINDOWS, order=ORDER, rows_per_slice=None, found=None) -> DataFrame:
    """Add ``{stat}_{vital}_{n}h`` over the newest ``n`` rows, current one included.

    Frames count rows, not hours: a NULL takes a place but adds no value. Longer frames are put
    together from shorter ones a lag apart, so a row costs a few merges instead of a pass over
    every frame, and one exchange and one sort serve all of them. ``found`` names the large keys
    when they are known (an empty list when there are none), which saves counting.
    """
    over = f"PARTITION BY {KEY}, {SLICE} ORDER BY {', '.join(order)}"
    base = sliced(df, KEY, order, halo=max(windows) - 1, rows_per_slice=rows_per_slice, found=found)
    out = base.selectExpr("*", *[e for v in vitals for e in _single(v)])
    for size in _ladder(windows):
        old = size // 2
        new = size - old
        out = out.selectExpr("*", *[e for v in vitals for e in _lagged(v, old, new, size, over)])
        out = out.selectExpr("*", *[e for v in vitals for e in _merged(v, new, size)])
    added = [
        f"{_statistic(s, v, n)} AS {feature_name(s, v, n)}" for v in vitals for n in windows for s in stats
    ]
    return unsliced(out.selectExpr(*df.columns, SLICE, COPY, POS, *added))


def feature_row(df: DataFrame, extra=()) -> DataFrame:
    scores = {"qsofa_score": qsofa(), "sirs_count": sirs(), "iculos_hours": F.col(HOUR)}
    label = [F.coalesce(F.col(LABEL), F.lit(0)).alias(LABEL)] if LABEL in df.columns else []
    return df.withColumns({**missing_flags(), **scores}).select(
        KEY, HOUR, *extra, *label, *MODEL_DEMOGRAPHICS, *feature_names()
    )


def features(df: DataFrame, extra=("event_id",), rows_per_slice=None) -> DataFrame:
    """The 131 features per hour with keys, label and demographics."""
    needed = {KEY, HOUR, *ORDER, LABEL, "WBC", *VITALS, *MODEL_DEMOGRAPHICS, *extra}
    lean = df.select(*[c for c in df.columns if c in needed])
    return feature_row(rolling(lean, rows_per_slice=rows_per_slice), extra)


def latest_features(df: DataFrame, extra=("event_id",)) -> DataFrame:
    """Each patient's newest feature row. It depends on the newest 24 rows only, so the rest is
    dropped on the map side before anything is shuffled."""
    recent = last_rows(df, max(WINDOWS), rank="_age")
    newest = feature_row(rolling(recent, found=[]), (*extra, "_age"))
    return newest.filter("_age = 1").drop("_age")
