"""Preparation steps on raw vitals and labs: filling, outliers, flags, time-based statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.slices import COPY, SLICE, hour_slices, running_max, slice_window, sliced, unsliced
from vigil.schema import HOUR, KEY, LABS, VITALS

# Tighter limits for measuring errors.
OUTLIER_RANGE = {"HR": (20, 250), "O2Sat": (50, 100), "Temp": (30, 45)}


def _hours_back(back_from: int, back_to: int = 0):
    return Window.partitionBy(KEY, SLICE).orderBy(HOUR).rangeBetween(-back_from, -back_to)


def forward_fill(df: DataFrame, columns=VITALS, hours: int = 4) -> DataFrame:
    """A missing value takes the last one recorded at most ``hours`` before."""
    frame = _hours_back(hours)
    base = hour_slices(df, hours)
    return unsliced(base.withColumns({c: F.last(c, ignorenulls=True).over(frame) for c in columns}))


def outliers_to_null(df: DataFrame, limits=None) -> DataFrame:
    limits = limits or OUTLIER_RANGE
    return df.withColumns({c: F.when(F.col(c).between(lo, hi), F.col(c)) for c, (lo, hi) in limits.items()})


def age_band():
    return F.when(F.col("Age") < 50, "<50").when(F.col("Age") <= 70, "50-70").otherwise(">70")


def impute_group_mean(df: DataFrame, columns=VITALS) -> DataFrame:
    """Missing values take the mean of their age band and gender (a handful of groups; no gender is one too)."""
    banded = df.withColumn("_band", age_band())
    means = banded.groupBy(F.col("_band").alias("_of_band"), F.col("Gender").alias("_of_gender")).agg(
        *[F.avg(c).alias(f"_mean_{c}") for c in columns]
    )
    group = (F.col("_band") == F.col("_of_band")) & F.col("Gender").eqNullSafe(F.col("_of_gender"))
    out = banded.join(F.broadcast(means), group, "left")
    filled = {c: F.coalesce(c, f"_mean_{c}") for c in columns}
    return out.withColumns(filled).select(*df.columns)


def lab_flags(df: DataFrame, labs=LABS, hours: int = 24) -> DataFrame:
    """Per lab: missing now, and measured at least once in the newest ``hours``."""
    frame = _hours_back(hours - 1)
    base = hour_slices(df, hours - 1)
    added = {f"missing_{c.lower()}": F.col(c).isNull().cast("int") for c in labs}
    added |= {f"measured_{c.lower()}_{hours}h": (F.count(c).over(frame) > 0).cast("int") for c in labs}
    return unsliced(base.withColumns(added))


def hours_since_last(df: DataFrame, columns=VITALS, rows_per_slice=None) -> DataFrame:
    """Hours since each column was last recorded, NULL before the first time."""
    seen = {f"_seen_{c}": F.when(F.col(c).isNotNull(), F.col(HOUR)) for c in columns}
    out = running_max(df, seen, rows_per_slice=rows_per_slice)
    since = {f"since_{c.lower()}": F.col(HOUR) - F.col(f"_seen_{c}") for c in columns}
    return out.withColumns(since).drop(*seen)


def interactions(df: DataFrame) -> DataFrame:
    """Shock index, breathing to pulse ratio, and the change of MAP against exactly 24 h before."""
    base = hour_slices(df, 24)
    day_before = F.max("MAP").over(_hours_back(24, 24))
    return unsliced(
        base.withColumns(
            {
                "shock_index": F.try_divide("HR", "SBP"), "resp_hr_ratio": F.try_divide("Resp", "HR"),
                "map_delta_24h": F.col("MAP") - day_before,
            }
        )
    )


def history_gate(df: DataFrame, hours: int = 6, rows_per_slice=None) -> DataFrame:
    """Only rows with at least ``hours`` rows of history, themselves included."""
    if hours <= 1:
        return df
    base = sliced(df, halo=hours - 1, rows_per_slice=rows_per_slice)
    enough = F.lag(F.lit(1), hours - 1).over(slice_window())
    return unsliced(base.withColumn("_enough", enough).filter("_enough = 1")).drop("_enough")


def exact_slope(v: str, frame, hour: str = HOUR, digits: int = 4, places: int = 6) -> F.Column:
    """Least-squares slope of ``v`` over the hour within ``frame``, from exact whole-number sums.

    Hours are taken relative to the row and values as whole numbers of 10^-``digits``, so every sum is exact; the
    quotient is rounded to ``places`` decimals (half away from zero) in whole numbers, so every engine gives the same
    double. Rows with a null value are left out; fewer than two values or one hour only: NULL.
    """
    y = F.round(F.col(v) * F.lit(10 ** digits)).cast("long")
    x = F.when(F.col(v).isNotNull(), F.col(hour).cast("long"))
    n, sx, sy = F.count(v).over(frame), F.sum(x).over(frame), F.sum(y).over(frame)
    sxx, sxy = F.sum(x * x).over(frame), F.sum(x * y).over(frame)
    t = F.col(hour).cast("long")
    rx, rxx, rxy = sx - n * t, sxx - 2 * t * sx + n * t * t, sxy - t * sy
    num, den = n * rxy - rx * sy, n * rxx - rx * rx
    # rounded half away from zero to ``places`` decimals with whole numbers, so no engine meets a decimal tie in doubles
    wide = "decimal(38,0)"
    scaled = (den * F.lit(10 ** digits)).cast(wide)
    top = F.abs(num).cast(wide) * F.lit(2 * 10 ** places).cast(wide) + scaled
    bottom = scaled * F.lit(2).cast(wide)
    whole = ((top - F.pmod(top, bottom)) / bottom).cast("long")
    return F.when(den != 0, F.signum(num) * whole.cast("double") / F.lit(float(10 ** places)))


def _half_away(num: np.ndarray, den: np.ndarray, digits: int = 4, places: int = 6) -> np.ndarray:
    """num / (den * 10^digits) rounded half away from zero to ``places`` decimals, by whole numbers as in ``exact_slope``."""
    scaled = den * 10 ** digits
    whole, rest = abs(num) // scaled, abs(num) % scaled
    whole = whole * 10 ** places + (rest * (2 * 10 ** places) + scaled) // (2 * scaled)
    return np.sign(num).astype(np.float64) * whole.astype(np.float64) / float(10 ** places)


def _hour_frames(group, hour, last, values, whole, stats, windows, digits: int = 4, places: int = 6) -> list[np.ndarray]:
    """Masked statistics per window of rows sorted by (group, hour), as (rows, vitals) arrays in the order of ``windows``
    and ``stats``; ``last`` marks each group's null hour, whose rows see only each other.

    Rows of one hour are summed up first, so a frame joins at most as many hours as it is wide, however many rows those
    have. ``values`` is a masked array; ``whole`` holds the values in whole numbers of 10^-digits.
    """
    first = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (hour[1:] != hour[:-1]) | (last[1:] != last[:-1])))
    of_row = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(group))))
    group, hour, last = group[first], hour[first], last[first]
    seen = ~np.ma.getmaskarray(values)
    raw = values.filled(0.0)
    real = seen & ~np.isnan(raw)
    per_hour = lambda x: np.add.reduceat(x, first, axis=0)
    n, total, n_real = per_hour(seen.astype(np.int64)), per_hour(np.where(seen, raw, 0.0)), per_hour(real.astype(np.int64))
    low = np.minimum.reduceat(np.where(real, raw, np.inf), first, axis=0)
    high = np.maximum.reduceat(np.where(seen, raw, -np.inf), first, axis=0)
    mean = total / np.maximum(n, 1)
    off = np.where(seen, raw - mean[of_row], 0.0)
    square = per_hour(off * off)
    if "slope" in stats:
        most = int(per_hour(seen.astype(np.int64).sum(1)).max()) * max(windows)
        # beyond 64 bits the same sums in Python's whole numbers
        if whole.size and max(abs(int(whole.max())), abs(int(whole.min()))) * most * most * max(windows) >= 1 << 61 or most * most * max(windows) ** 2 >= 1 << 28:
            whole, n_whole = whole.astype(object), n.astype(object)
        else:
            n_whole = n
        sum_whole = per_hour(whole)
    count = len(first)

    def joined(width: int):
        """(hours, their k-th hours before) for each k, as long as a frame of ``width`` hours has such a pair."""
        for k in range(count):
            if k >= width:
                return
            own = slice(k, count)
            old = slice(0, count - k)
            inside = (group[own] == group[old]) & ~last[own] & ~last[old] & (hour[own] - hour[old] < width) if k else np.ones(count, dtype=bool)
            if not inside.any():
                return
            yield np.flatnonzero(inside) + k, np.flatnonzero(inside)

    out = []
    for width in windows:
        shape = n.shape
        w_n, w_total, w_real = np.zeros(shape, dtype=np.int64), np.zeros(shape), np.zeros(shape, dtype=np.int64)
        w_low, w_high, pairs = np.full(shape, np.inf), np.full(shape, -np.inf), list(joined(width))
        for to, old in reversed(pairs):  # oldest hour first, as a running sum over the frame adds
            w_n[to] += n[old]
            w_total[to] += total[old]
            w_real[to] += n_real[old]
            w_low[to] = np.minimum(w_low[to], low[old])
            w_high[to] = np.maximum(w_high[to], high[old])
        none, w_mean = w_n == 0, w_total / np.maximum(w_n, 1)
        found = {"mean": (w_mean, none), "max": (w_high, none), "min": (np.where(w_real > 0, w_low, np.nan), none)}
        if "std" in stats:
            w_square = np.zeros(shape)
            for to, old in pairs:
                gap = np.where(n[old] > 0, mean[old] - w_mean[to], 0.0)
                w_square[to] += square[old] + n[old] * gap * gap
            found["std"] = (np.sqrt(w_square / np.maximum(w_n - 1, 1)), w_n < 2)
        if "slope" in stats:
            sums = [np.zeros(shape, dtype=whole.dtype) for _ in range(5)]
            for to, old in pairs:
                x = (hour[old] - hour[to]).astype(whole.dtype)[:, None]
                for s, part in zip(sums, (n_whole[old], n_whole[old] * x, n_whole[old] * x * x, sum_whole[old], sum_whole[old] * x)):
                    s[to] += part
            s_n, s_x, s_xx, s_y, s_xy = sums
            num, den = s_n * s_xy - s_x * s_y, s_n * s_xx - s_x * s_x
            flat = den == 0
            found["slope"] = (_half_away(num, np.where(flat, 1, den), digits, places), flat.astype(bool))
        out += [np.ma.array(found[s][0][of_row], mask=found[s][1][of_row]) for s in stats]
    return out


def rolling_by_hour(df, stats=("mean", "std", "min", "max", "slope"), vitals=VITALS, windows=(6, 12, 24)) -> DataFrame:
    """Statistics over the newest ``W`` hours by the clock, t - W excluded; ``std`` is the sample one; slopes come from
    exact sums (``exact_slope``).

    Rows are dealt out and sorted by patient, slice and hour; each task walks through its rows once and keeps the last
    hours of one patient, so a row costs as many array steps as the frames have hours, not a pass over each frame for
    each statistic.
    """
    names = [f"{v.lower()}_{s}_{n}h" for n in windows for v in vitals for s in stats]
    back = max(windows) - 1
    numbers = {f"_as_{v}": F.col(v).cast("double") for v in vitals}
    wholes = {f"_whole_{v}": F.round(F.col(v) * F.lit(10 ** 4)).cast("long") for v in vitals} if "slope" in stats else {}
    base = hour_slices(df, back).withColumns({"_hour": F.col(HOUR).cast("long"), **numbers, **wholes})
    dealt = base.repartition(KEY, SLICE).sortWithinPartitions(KEY, SLICE, HOUR)
    kept = [*df.columns]
    sent = dealt.select(*kept, COPY, F.col(KEY).alias("_key"), F.col(SLICE).alias("_of"), "_hour", *numbers, *wholes)
    of_number, of_whole = list(numbers), list(wholes)

    def run(batches):
        held: list[pa.RecordBatch] = []

        def key_of(batch, i):
            return tuple(batch.column(batch.schema.get_field_index(c))[i].as_py() for c in ("_key", "_of", "_hour"))

        def frames(table: pa.Table, skip: int, stop: int):
            """Result rows ``skip`` to ``stop`` of rows that hold every frame of theirs."""
            table = table.slice(0, stop).combine_chunks()
            at = {c: table.column(c).combine_chunks() if table.column(c).num_chunks != 1 else table.column(c).chunk(0) for c in table.column_names if c.startswith("_")}
            new = np.zeros(stop, dtype=bool)
            for c in ("_key", "_of"):
                codes = at[c].dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                new[1:] |= codes[1:] != codes[:-1]
            hour, last = at["_hour"].fill_null(0).to_numpy(zero_copy_only=False), at["_hour"].is_null().to_numpy(zero_copy_only=False)
            values = np.ma.array(np.stack([at[c].fill_null(0.0).to_numpy(zero_copy_only=False) for c in of_number], axis=1), mask=np.stack([at[c].is_null().to_numpy(zero_copy_only=False) for c in of_number], axis=1))
            whole = np.stack([at[c].fill_null(0).to_numpy(zero_copy_only=False) for c in of_whole], axis=1) if of_whole else None
            found = _hour_frames(np.cumsum(new), hour, last, values, whole, stats, windows)
            mine = ~at[COPY].to_numpy(zero_copy_only=False)
            mine[:skip] = False
            out = [table.column(i).filter(pa.array(mine)).combine_chunks() for i in range(len(kept))]
            for w in range(len(windows)):
                for k in range(len(vitals)):
                    for s in range(len(stats)):
                        x = found[w * len(stats) + s]
                        out.append(pa.array(x.data[mine, k], mask=np.ma.getmaskarray(x)[mine, k]))
            return pa.RecordBatch.from_arrays([c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in out], [*kept, *names])

        skip = 0  # rows held only for the frames of later ones
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            end = key_of(batch, batch.num_rows - 1)
            if key_of(batch, 0) == end and key_of(held[0], 0) == end:
                continue  # rows of one hour that goes on
            table = pa.Table.from_batches(held)
            n = table.num_rows
            codes = _same_as_last(table, ("_key", "_of", "_hour"))
            stop = n - codes  # the last hour may go on in the next batch
            if stop > skip:
                for part in _even(frames(table, skip, stop)):
                    yield part
                group = _same_as_last(table, ("_key", "_of"))
                start = n - group
                if end[2] is not None:
                    hours = table.column("_hour").slice(start).combine_chunks()
                    old = pc.fill_null(pc.less(hours, end[2] - back), True)
                    start += int(pc.sum(pc.cast(old, pa.int64())).as_py() or 0)
                else:
                    start = stop
                start = min(start, stop)
                held, skip = table.slice(start).to_batches(), stop - start
        if held:
            table = pa.Table.from_batches(held)
            if table.num_rows > skip:
                yield from _even(frames(table, skip, table.num_rows))

    kinds = dict(df.dtypes)
    fields = ", ".join([*[f"`{c}` {kinds[c]}" for c in kept], *[f"`{c}` double" for c in names]])
    return sent.mapInArrow(run, fields)


def _same_as_last(table: pa.Table, columns) -> int:
    """How many rows at the end of a table equal the last one in ``columns``; nulls are equal."""
    n = table.num_rows
    differ = np.zeros(n, dtype=bool)
    for c in columns:
        column, last = table.column(c), table.column(c)[n - 1].as_py()
        other = pc.is_valid(column) if last is None else pc.fill_null(pc.not_equal(column, pa.scalar(last, column.type)), True)
        differ |= other.to_numpy()
    places = np.flatnonzero(differ)
    return n - 1 - int(places[-1]) if len(places) else n


def _even(batch: pa.RecordBatch, rows: int = 20_000):
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def labs_long(df: DataFrame, labs=LABS) -> DataFrame:
    """One row per recorded lab value."""
    long = df.select(KEY, HOUR, *labs).unpivot([KEY, HOUR], list(labs), "name", "value")
    return long.filter("value is not null")


def labs_wide(long: DataFrame, labs=LABS) -> DataFrame:
    """One column per lab; of several values of one lab and hour the largest."""
    return long.groupBy(KEY, HOUR).pivot("name", list(labs)).agg(F.max("value"))
