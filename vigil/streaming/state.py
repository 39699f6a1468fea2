"""State of the streams: rolling vitals and alarm streaks of each patient, kept and worked through by bucket of patients."""

from __future__ import annotations

import numpy as np
import pandas as pd

from vigil.schema import KEY, ORDER, STATS, VITALS, WINDOWS, feature_name

BUCKET = "_bucket"
#: Rows whose frames are unfolded at a time; it bounds the memory besides the batch's own rows.
ROWS_AT_ONCE = 4096


def frame_stats(frames: np.ndarray) -> list[np.ndarray]:
    """Mean, std, min, max and slope over the last axis; NaN is missing and slopes count recorded values only."""
    seen = ~np.isnan(frames)
    n = seen.sum(axis=2)
    none = n == 0
    mean = np.where(seen, frames, 0.0).sum(axis=2) / np.maximum(n, 1)
    off = np.where(seen, frames - mean[..., None], 0.0)
    std = np.sqrt((off * off).sum(axis=2) / np.maximum(n, 1))
    low = np.where(seen, frames, np.inf).min(axis=2)
    high = np.where(seen, frames, -np.inf).max(axis=2)
    rank = np.cumsum(seen, axis=2)
    slope = (off * rank).sum(axis=2) * 12 / np.maximum(n * (n * n - 1.0), 1.0)
    return [np.where(none, np.nan, s) for s in (mean, std, low, high, slope)]


def window_stats(values: np.ndarray, rows: int, first: int) -> list[np.ndarray]:
    """``frame_stats`` over the newest ``rows`` of each line from ``first`` on; ``values`` is (lines, vitals)."""
    padded = np.vstack([np.full((rows - 1, values.shape[1]), np.nan), values])
    return frame_stats(np.lib.stride_tricks.sliding_window_view(padded, rows, axis=0)[first:])


def rolled_order() -> list[str]:
    return [feature_name(stat, vital, hours) for vital in VITALS for hours in WINDOWS for stat in STATS]


def in_order(frames) -> pd.DataFrame:
    """The batch's rows of one bucket, patient after patient, each oldest first; how many there are is set by the batch size."""
    rows = pd.concat(list(frames), ignore_index=True).drop(columns=BUCKET)
    return rows.sort_values([KEY, *ORDER], kind="stable", ignore_index=True)


def patients(new: pd.DataFrame, known: list) -> tuple[np.ndarray, list]:
    """(number of each row's patient, all patients): those in ``known`` keep their numbers, others follow."""
    key = new[KEY].to_numpy(dtype=object)
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    number = {k: i for i, k in enumerate(known)}
    of = [number.setdefault(k, len(number)) for k in key[begins].tolist()]
    return np.repeat(of, np.diff(np.append(begins, len(key)))), list(number)


def _places(of: np.ndarray) -> np.ndarray:
    """The place of each row in its patient's stretch of rows, from 0."""
    begins = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    return np.arange(len(of)) - np.repeat(begins, np.diff(np.append(begins, len(of))))


def rolled(values: np.ndarray, place: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The rolling statistics of the ``wanted`` lines in the order of ``rolled_order``. ``values`` holds the rows of patient
    after patient; ``place`` is a row's place in its patient's series, and a frame ends where that series begins."""
    longest = max(WINDOWS)
    padded = np.vstack([np.full((longest - 1, values.shape[1]), np.nan), values])
    views = np.lib.stride_tricks.sliding_window_view(padded, longest, axis=0)
    back = np.arange(longest - 1, -1, -1)
    out = np.empty((len(wanted), values.shape[1] * len(WINDOWS) * len(STATS)))
    for a in range(0, len(wanted), ROWS_AT_ONCE):
        rows = wanted[a:a + ROWS_AT_ONCE]
        frames = np.where((back <= place[rows, None])[:, None, :], views[rows], np.nan)
        tables = [t for hours in WINDOWS for t in frame_stats(frames[..., longest - hours:])]
        out[a:a + len(rows)] = np.stack(tables, axis=2).reshape(len(rows), -1)
    return out


def add_rolled(key, frames, state):
    """Keeps the newest 23 records of each patient of a bucket and adds the 120 rolling statistics to each new one,
    as one array in the order of ``rolled_order``; NaN stands for missing."""
    new = in_order(frames)
    known, held, blob = state.get if state.exists else ([], [], b"")
    of_new, known = patients(new, list(known))
    held = np.append(np.array(held, dtype=np.int64), np.zeros(len(known) - len(held), dtype=np.int64))
    old = np.frombuffer(bytes(blob)).reshape(-1, len(VITALS))
    of = np.concatenate([np.repeat(np.arange(len(known)), held), of_new])
    order = np.argsort(of, kind="stable")  # a patient's kept records, then the new ones
    of, values = of[order], np.vstack([old, new[VITALS].to_numpy(dtype=float)])[order]
    # One array column for all statistics: a hundred narrow columns cost far more to hand over.
    at = np.empty(len(order), dtype=np.int64)
    at[order] = np.arange(len(order))
    table = rolled(values, _places(of), at[len(old):])
    sizes = np.bincount(of, minlength=len(known))
    newest = np.cumsum(sizes)[of] - np.arange(len(of)) <= max(WINDOWS) - 1
    state.update((known, np.minimum(sizes, max(WINDOWS) - 1).tolist(), values[newest].tobytes()))
    yield new.assign(rolled=list(table))


def add_streaks(threshold: float, min_consecutive: int, warmup_hours: int, history: int):
    """A function that turns each probability of the patients of a bucket into one alarm decision."""
    def decide(key, frames, state):
        new = in_order(frames)
        known, streaks = state.get if state.exists else ([], [])
        of, known = patients(new, list(known))
        now = np.append(np.array(streaks, dtype=np.int64), np.zeros(len(known) - len(streaks), dtype=np.int64))
        hit = (new["proba"] >= threshold).to_numpy()
        place = _places(of) + 1
        line = np.arange(len(hit))
        begin = line - place  # one before the patient's first line
        last_miss = np.maximum(np.maximum.accumulate(np.where(hit, -1, line)), begin)
        runs = np.minimum(line - last_miss + np.where(last_miss == begin, now[of], 0), history)
        ends = np.flatnonzero(np.append(of[1:] != of[:-1], True))
        now[of[ends]] = runs[ends]
        state.update((known, now.tolist()))
        muted = new["iculos_hours"] < warmup_hours
        yield new.assign(streak=runs, muted=muted, alarm=~muted & (runs >= min_consecutive))

    return decide
