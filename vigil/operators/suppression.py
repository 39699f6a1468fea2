"""Suppressing alerts that follow an emitted one too closely.

Whether an alert is emitted depends on the last emitted one, so the rule is a chain. An alert whose
predecessor lies at least the gap back is emitted whatever came before; it starts an *island*, and
islands do not depend on each other. An island shorter than the gap emits its first alert alone.
Each slice of a longer one says, for every possible entry, when its last emitted alert would be;
chaining these short answers gives the true entry of every slice.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators.slices import (
    COPY, POS, ROWS_PER_SLICE, SLICE, large_keys, micros, running_max, slice_window, sliced, unsliced,
)
from vigil.schema import KEY
from vigil.session import written

NEVER = -(2**62)


def _islands(alerts: DataFrame, order, gap: int, rows: int, found: list) -> DataFrame:
    """Add ``_at`` (microseconds) and ``_island`` (its first alert's time)."""
    axis = F.col("_at")
    timed = alerts.withColumn("_at", micros(order[0]))
    base = sliced(timed, KEY, order, halo=1, axis=axis, rows_per_slice=rows, found=found)
    before = F.lag("_at").over(slice_window(KEY, order))
    starts = F.when(before.isNull() | (axis - before >= gap), axis)
    marked = unsliced(base.withColumn("_first", starts))
    # ``_first`` grows with time, so the newest one seen is the largest one seen.
    out = running_max(marked, {"_island": F.col("_first")}, KEY, ("_at", *order[1:]), rows, found)
    return out.drop("_first")


def _chain(ts: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: the next emitted row if this one is emitted, and the last emitted one of the slice."""
    following = np.searchsorted(ts, ts + gap)
    last = np.where(following < len(ts), following, np.arange(len(ts)))
    while True:  # jumps double in length until all stand at the end of their chain
        further = last[last]
        if (further == last).all():
            return following, last
        last = further


def _slice_answer(gap: int):
    """Per slice: entries (times after which the first row is emitted) and the last time emitted then."""
    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        ts = np.sort(rows["_at"].to_numpy())
        _, last = _chain(ts, gap)
        reach = min(np.searchsorted(ts, ts[0] + gap) + 1, len(ts))
        change = np.flatnonzero(np.append(True, last[1:reach] != last[: reach - 1]))
        upto = np.append(change[1:], reach) - 1  # entries up to and including this row give the same end
        out = rows.iloc[[0]][[KEY, "_island", SLICE]].copy()
        out["entries"], out["ends"] = [ts[upto].tolist()], [ts[last[change]].tolist()]
        return out

    return answer


def _slice_entries(gap: int):
    """Per island: the last emitted time before each of its slices."""
    def enter(answers: pd.DataFrame) -> pd.DataFrame:
        answers, last, before = answers.sort_values(SLICE), NEVER, []
        for entries, ends in zip(answers["entries"], answers["ends"]):
            before.append(last)
            i = int(np.searchsorted(np.asarray(entries), last + gap))
            last = ends[i] if i < len(ends) else last
        return answers[[KEY, "_island", SLICE]].assign(before=np.array(before, dtype="int64"))

    return enter


def _slice_emitted(gap: int):
    def emitted(rows: pd.DataFrame) -> pd.DataFrame:
        ts = np.sort(rows["_at"].to_numpy())
        following, _ = _chain(ts, gap)
        kept, i = [], int(np.searchsorted(ts, rows["before"].iloc[0] + gap))
        while i < len(ts):
            kept.append(ts[i])
            i = following[i]
        return pd.DataFrame({KEY: rows[KEY].iloc[0], "_at": np.array(kept, dtype="int64")})

    return emitted


def _emitted_in_slices(islands: DataFrame, gap: int, rows: int, order, found) -> DataFrame:
    cut = _real_rows(sliced(islands, KEY, ("_at", *order[1:]), axis=F.col("_at"), rows_per_slice=rows, found=found))
    cut = written(cut.select(KEY, "_island", SLICE, "_at"), "island-slices")
    group = [KEY, "_island", SLICE]
    kinds = {f: cut.schema[f].dataType for f in group}
    keys = T.StructType([T.StructField(f, t) for f, t in kinds.items()])
    several = T.ArrayType(T.LongType())
    answers = cut.groupBy(*group).applyInPandas(
        _slice_answer(gap), T.StructType([*keys.fields, T.StructField("entries", several), T.StructField("ends", several)])
    )
    entries = answers.groupBy(KEY, "_island").applyInPandas(
        _slice_entries(gap), T.StructType([*keys.fields, T.StructField("before", T.LongType())])
    )
    out = T.StructType([T.StructField(KEY, kinds[KEY]), T.StructField("_at", T.LongType())])
    return cut.join(entries, group).groupBy(*group).applyInPandas(_slice_emitted(gap), out)


def _real_rows(df: DataFrame) -> DataFrame:
    """Only real rows, with their slice."""
    return df.filter(~F.col(COPY)).drop(COPY, POS)


def suppress_repeats(
    alerts: DataFrame, gap_hours: float = 1.0, order=("timestamp", "alert_id"), rows_per_slice=None
) -> DataFrame:
    """Alerts left when none may follow an emitted one of its patient by less than ``gap_hours``.

    Alerts of one patient at the very same time stand or fall together.
    """
    rows = rows_per_slice or ROWS_PER_SLICE
    width = int(gap_hours * 3_600_000_000)
    found = large_keys(alerts, KEY, rows)
    islands = written(_islands(alerts, order, width, rows, found), "islands")
    spans = written(islands.groupBy(KEY, "_island").agg(F.max("_at").alias("_end")), "islands")
    short = F.col("_end") - F.col("_island") < width
    longer = islands.join(spans.filter(~short).select(KEY, "_island"), [KEY, "_island"], "left_semi")
    kept = spans.filter(short).select(KEY, F.col("_island").alias("_at")).unionByName(
        _emitted_in_slices(longer, width, rows, order, found)
    ).distinct()
    return islands.join(kept, [KEY, "_at"], "left_semi").select(*alerts.columns)
