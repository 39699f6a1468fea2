"""Grid search over threshold, run length and warm-up in one pass over the scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.alarms import MISSED, UNIT, utility_units
from vigil.operators.slices import POS, ROWS_PER_SLICE, SLICE, large_keys, position, slice_window, sliced
from vigil.schema import KEY, LABEL, ORDER

# The published search grid.
THRESHOLDS = tuple(0.02 + i * 0.02 for i in range(47))
RUN_LENGTHS = (1, 2, 3, 4, 6, 8, 12, 16)
WARMUPS = (0, 6, 12, 18, 24, 36, 48)


def _steps_reached(value: str, steps) -> str:
    """SQL for how many of the ascending ``steps`` a value reaches: a balanced tree of comparisons."""
    def tree(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high + 1) // 2
        limit = f"{steps[middle - 1]!r}D" if isinstance(steps[middle - 1], float) else str(steps[middle - 1])
        return f"if({value} >= {limit}, {tree(middle, high)}, {tree(low, middle - 1)})"

    return tree(0, len(steps))


def grid_table(spark, thresholds=THRESHOLDS, run_lengths=RUN_LENGTHS, warmups=WARMUPS) -> DataFrame:
    rows = [
        (i + 1, j + 1, h, float(t), int(k), int(w))
        for i, t in enumerate(thresholds) for h, k in enumerate(run_lengths) for j, w in enumerate(warmups)
    ]
    rows.append((0, 0, -1, None, None, None))  # stands for the patients themselves
    return spark.createDataFrame(
        rows, "level int, warm int, run int, threshold double, min_consecutive int, warmup_hours int"
    )


def tune_grid(
    df: DataFrame, thresholds=THRESHOLDS, run_lengths=RUN_LENGTHS, warmups=WARMUPS, rows_per_slice=None
) -> DataFrame:
    """Normalized utility and patient counts of every (threshold, run length, warm-up).

    A run of ``k`` rows reaches every threshold up to its lowest probability, so one rolling minimum
    per ``k`` answers all thresholds. Among the starts after a warm-up, a row changes the first alarms only
    where its level is above all levels before it: for the levels in between it is the first alarm. It adds
    its gain at its own level and takes it off at the level before, so that the sum over all higher levels
    is the gain at a level. These few whole numbers are summed per grid cell as the rows stream by.
    The last step runs over at most one row per grid cell.
    """
    thresholds, warmups = sorted(float(t) for t in thresholds), sorted(int(w) for w in warmups)
    runs = [max(int(k), 1) for k in run_lengths]
    lean = df.select(*dict.fromkeys([KEY, *ORDER, LABEL]), F.coalesce("proba", F.lit(float("-inf"))).alias("_p"))
    rows = rows_per_slice or ROWS_PER_SLICE
    found = large_keys(lean, KEY, max(rows, 2 * (max(runs) - 1), 1))
    base = sliced(lean, halo=max(runs) - 1, rows_per_slice=rows_per_slice, found=found)
    w = slice_window()
    lowest = {f"_low{k}": F.min("_p").over(w.rowsBetween(1 - k, 0)) for k in set(runs)}
    rows = base.withColumns({"_at": position(w), **lowest}).filter("not _copy")

    # The level that each row reaches with each run length (0: none), and the highest before it after each warm-up.
    rows = rows.selectExpr(
        KEY, SLICE, POS, "_at", f"if({LABEL} = 1, _at, NULL) AS _positive",
        *[f"if(_at >= {k - 1}, {_steps_reached(f'_low{k}', thresholds)}, 0) AS _level{i}" for i, k in enumerate(runs)],
    )
    cells = [(i, j + 1, k, warm) for i, k in enumerate(runs) for j, warm in enumerate(warmups)]
    after_warm = {f"_of{i}_{j}": f"if(_at - {k - 1} >= {warm}, _level{i}, 0)" for i, j, k, warm in cells}
    series, earlier = f"PARTITION BY {KEY}, {SLICE}", "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    walked = rows.selectExpr(
        "*", f"min(_positive) OVER ({series}) AS _onset", f"row_number() OVER ({series} ORDER BY _at) AS _nth",
        *[f"max({e}) OVER ({series} ORDER BY _at {earlier}) AS _before{c}" for c, e in after_warm.items()],
    )
    if found:  # slices of a large key go on from the levels before them
        per_slice = rows.filter(F.col(POS).isNotNull()).groupBy(KEY, SLICE).agg(
            F.min("_positive").alias("_positive"), *[F.max(F.expr(e)).alias(f"_m{c}") for c, e in after_warm.items()]
        )
        carried = per_slice.selectExpr(
            f"{KEY} AS _key", f"{SLICE} AS _of", f"min(_positive) OVER (PARTITION BY {KEY}) AS _first",
            *[f"max(_m{c}) OVER (PARTITION BY {KEY} ORDER BY {SLICE} {earlier}) AS _from{c}" for c in after_warm],
        )
        walked = walked.join(F.broadcast(carried), (F.col(KEY) == F.col("_key")) & (F.col(SLICE) == F.col("_of")) & F.col(POS).isNotNull(), "left")
        walked = walked.withColumn("_onset", F.coalesce("_first", "_onset")).withColumn("_nth", F.coalesce(F.col(POS) + 1, F.col("_nth")))
        walked = walked.withColumns({f"_before{c}": F.greatest(f"_before{c}", f"_from{c}") for c in after_warm})

    # Entries (run, warm, level, start, sign); the patients themselves are run -1.
    entries = ["if(_nth = 1, array(named_struct('run', -1, 'warm', 0, 'level', 0, 'start', CAST(NULL AS BIGINT), 'sign', 1)), array())"]
    for i, j, k, _ in cells:
        now, before = after_warm[f"_of{i}_{j}"], f"coalesce(_before_of{i}_{j}, 0)"
        made = [
            f"named_struct('run', {i}, 'warm', {j}, 'level', {level}, 'start', _at - {k - 1}, 'sign', {sign})"
            for level, sign in ((now, 1), (before, -1))
        ]
        entries.append(f"if({now} > {before}, if({before} > 0, array({made[0]}, {made[1]}), array({made[0]})), array())")
    stairs = walked.selectExpr("_onset AS onset", f"inline(concat({', '.join(entries)}))")
    sign, septic = F.col("sign").cast("long"), F.col("onset").isNotNull()
    gain = utility_units(F.col("start"), F.col("onset")) - utility_units(F.lit(None).cast("long"), F.col("onset"))
    changes = stairs.groupBy("run", "warm", "level").agg(
        F.sum(sign * gain).alias("gain"), F.sum(F.when(septic, sign).otherwise(0)).alias("tp"),
        F.sum(F.when(septic, 0).otherwise(sign)).alias("fp"),
    )

    grid = F.broadcast(grid_table(df.sparkSession, thresholds, runs, warmups))
    cells = grid.join(changes, ["run", "warm", "level"], "left")
    down = Window.partitionBy("run", "warm").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, 0)
    sums = {c: F.coalesce(F.sum(c).over(down), F.lit(0)) for c in ("gain", "tp", "fp")}
    cells = cells.select("run", "threshold", "min_consecutive", "warmup_hours", *[e.alias(c) for c, e in sums.items()])
    whole_grid = Window.partitionBy(F.lit(0))
    patients = {
        "septic": F.max(F.when(F.col("run") == -1, F.col("tp"))).over(whole_grid),
        "all": F.max(F.when(F.col("run") == -1, F.col("tp") + F.col("fp"))).over(whole_grid),
    }
    cells = cells.withColumns(patients).filter("run >= 0")
    raw = (F.col("gain") + F.col("septic") * MISSED) / UNIT
    return cells.select(
        "threshold", "min_consecutive", "warmup_hours",
        F.when(F.col("septic") > 0, raw / F.col("septic")).otherwise(0.0).alias("normalized_utility"),
        raw.alias("raw_utility"), F.col("septic").cast("double").alias("max_utility"),
        "tp", (F.col("septic") - F.col("tp")).alias("fn"), "fp",
        (F.col("all") - F.col("septic") - F.col("fp")).alias("tn"),
    )


def best_params(grid: DataFrame) -> DataFrame:
    """The best cell; equal utilities go to the first in search order."""
    order = [F.desc(F.round("normalized_utility", 9)), "threshold", "min_consecutive", "warmup_hours"]
    return grid.orderBy(*order).limit(1)
