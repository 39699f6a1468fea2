"""Ordered per-key work that survives a key holding a third of all rows.

A plain ``Window.partitionBy(key)`` puts a whole key into one task. Here keys that are small stay
one slice each (the plain window, one shuffle), and keys above ``rows_per_slice`` are cut into
consecutive slices of exactly that many rows. A slice may ask for a *halo*: copies of the rows just
before it, so that a frame looking ``halo`` rows back sees the same rows as in the whole series.

The list of large keys is the top ``MAX_HOT_KEYS`` by row count, so it stays small enough to
broadcast whatever the data; by the pigeonhole principle every other key has less than
``total / MAX_HOT_KEYS`` rows. The list is found by one map-side-combined count over the key column
when the operator is called; if it is empty, which is the usual case, the plan is the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.schema import KEY, ORDER
from vigil.session import written

MAX_HOT_KEYS = 100_000
ROWS_PER_SLICE = 1_000_000
SLICE, COPY, POS = "_slice", "_copy", "_pos"


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts)


def large_keys(df: DataFrame, key, rows_per_slice: int) -> list:
    """Keys above the slice size with their row counts, never more than ``MAX_HOT_KEYS`` of them."""
    keys = _names(key)
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_slice)
        .filter(" and ".join(f"`{k}` is not null" for k in keys))
        .orderBy(F.desc("_n"), *keys).limit(MAX_HOT_KEYS)
        .collect()
    )


def sliced(
    df: DataFrame,
    key: str | Sequence[str] = KEY,
    order: Sequence[str] = ORDER,
    halo: int = 0,
    axis: Column | None = None,
    rows_per_slice: int | None = None,
    found: list | None = None,
) -> DataFrame:
    """Add ``_slice``, ``_copy`` (row is a halo copy) and ``_pos`` (known only on large keys).

    ``axis`` is a whole number that grows with the first order column; it places rows of a large key
    into coarse ranges, whose sizes give each row's exact position without a global sort.
    """
    keys, rows = _names(key), max(rows_per_slice or ROWS_PER_SLICE, 2 * halo, 1)
    small = {SLICE: F.lit(0).cast("long"), COPY: F.lit(False), POS: F.lit(None).cast("long")}
    found = large_keys(df, keys, rows) if found is None else found
    if not found:
        return df.withColumns(small)

    schema = T.StructType([*[df.schema[k] for k in keys], T.StructField("_n", T.LongType())])
    large = F.broadcast(df.sparkSession.createDataFrame(found, schema))
    axis = F.col(order[0]) if axis is None else axis
    # Rows of large keys are read several times below: they are computed once and written.
    hot = written(df.join(large, keys).withColumn("_axis", axis.cast("double")), "large-keys")
    span = hot.groupBy(*keys, "_n").agg(F.min("_axis").alias("_lo"), F.max("_axis").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo") + 1) / F.ceil(F.col("_n") / F.lit(rows))
    ranged = hot.drop("_n").join(F.broadcast(span), keys).withColumn(
        "_range", F.coalesce(F.floor((F.col("_axis") - F.col("_lo")) / width), F.lit(-1))
    )
    # A range that is still too large is cut once more: by the axis again, or by the second order
    # column where the axis is the same throughout.
    second = F.col(order[-1]).cast("double")
    stats = {"_size": F.count(F.lit(1)), "_a": F.min("_axis"), "_z": F.max("_axis"), "_a2": F.min(second), "_z2": F.max(second)}
    per_range = ranged.groupBy(*keys, "_range").agg(*[e.alias(c) for c, e in stats.items()])
    tied = F.col("_a") == F.col("_z")
    offset = F.when(tied, second - F.col("_a2")).otherwise(F.col("_axis") - F.col("_a"))
    extent = F.when(tied, F.col("_z2") - F.col("_a2")).otherwise(F.col("_z") - F.col("_a")) + 1
    finer = F.coalesce(F.floor(offset / (extent / F.ceil(F.col("_size") / F.lit(rows)))), F.lit(-1))
    ranged = ranged.join(per_range, [*keys, "_range"]).withColumn("_finer", finer).drop(*stats)
    place = [*keys, "_range", "_finer"]
    sizes = ranged.groupBy(*place).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*keys).orderBy("_range", "_finer").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*place, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*place).orderBy(*order)
    placed = ranged.join(starts, place).withColumn(POS, F.col("_start") + F.row_number().over(inside) - 1)
    placed = written(placed.select(*df.columns, POS), "placed")
    placed = placed.withColumns({SLICE: F.floor(F.col(POS) / rows).cast("long"), COPY: F.lit(False)})
    if halo:
        near_end = F.col(POS) % rows >= rows - halo
        both = F.when(near_end, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
        placed = placed.withColumn(COPY, F.explode(both))
        placed = placed.withColumn(SLICE, F.col(SLICE) + F.col(COPY).cast("long"))
    columns = [*df.columns, *small]
    cold = df.join(large, keys, "left_anti").withColumns(small)
    return cold.select(*columns).unionByName(placed.select(*columns))


def slice_window(key=KEY, order=ORDER):
    return Window.partitionBy(*_names(key), SLICE).orderBy(*order)


def position(window) -> Column:
    """0-based row position in the whole series."""
    return F.coalesce(F.col(POS), F.row_number().over(window).cast("long") - 1)


def unsliced(df: DataFrame) -> DataFrame:
    """Drop halo copies and helper columns."""
    return df.filter(~F.col(COPY)).drop(SLICE, COPY, POS)


def with_position(df, name, key=KEY, order=ORDER, axis=None, rows_per_slice=None) -> DataFrame:
    """Add the dense 0-based position of each row in its key's order."""
    base = sliced(df, key, order, axis=axis, rows_per_slice=rows_per_slice)
    return unsliced(base.withColumn(name, position(slice_window(key, order))))


def last_rows(df: DataFrame, n: int, key=KEY, order=ORDER, rank: str | None = None) -> DataFrame:
    """The newest ``n`` rows per key. Spark trims each map task to ``n`` rows per key first."""
    w = Window.partitionBy(*_names(key)).orderBy(*[F.desc(c) for c in order])
    out = df.withColumn("_newest", F.row_number().over(w)).filter(F.col("_newest") <= n)
    return out.withColumnRenamed("_newest", rank) if rank else out.drop("_newest")


def hour_slices(df: DataFrame, back: int, width: int = 4096, hour: str = "ICULOS") -> DataFrame:
    """Slices of ``width`` hours for frames that look ``back`` hours (not rows) behind.

    Hours alone decide, so nothing is counted first; a row near the end of its slice is copied into
    the next one. ``_slice`` and ``_copy`` are as in ``sliced``.
    """
    width = max(width, 2 * back)
    into_next = F.pmod(F.col(hour), F.lit(width)) >= width - back
    both = F.when(into_next, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    out = df.withColumn(COPY, F.explode(both))
    return out.withColumns(
        {SLICE: F.floor(F.col(hour) / width).cast("long") + F.col(COPY).cast("long"), POS: F.lit(None).cast("long")}
    )


def running_max(
    df: DataFrame, columns: dict[str, Column], key=KEY, order=ORDER, rows_per_slice=None, found: list | None = None
) -> DataFrame:
    """Add the largest value so far of each expression, however far back. On large keys each slice
    starts from the maximum of the slices before it."""
    keys, rows = _names(key), rows_per_slice or ROWS_PER_SLICE
    found = large_keys(df, keys, rows) if found is None else found
    base = sliced(df, key, order, rows_per_slice=rows, found=found).withColumns({f"_now_{n}": e for n, e in columns.items()})
    w = slice_window(key, order)
    out = base.withColumns({n: F.max(f"_now_{n}").over(w) for n in columns})
    if found:
        before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        per_slice = base.filter(F.col(POS).isNotNull()).groupBy(*keys, SLICE).agg(*[F.max(f"_now_{n}").alias(f"_m_{n}") for n in columns])
        carried = per_slice.select(*keys, SLICE, *[F.max(f"_m_{n}").over(before).alias(f"_from_{n}") for n in columns])
        out = out.join(carried, [*keys, SLICE], "left")
        out = out.withColumns({n: F.greatest(n, f"_from_{n}") for n in columns})
    return unsliced(out).select(*df.columns, *columns)


def join_per_key(rows: DataFrame, table: DataFrame, key=KEY, how: str = "inner", rows_per_slice=None) -> DataFrame:
    """Join rows with a table of one row per key. Rows of large keys stay where they are and meet
    their few table rows by broadcast; the others are joined as usual."""
    keys = _names(key)
    found = large_keys(rows, keys, rows_per_slice or ROWS_PER_SLICE)
    if not found:
        return rows.join(table, keys, how)
    schema = T.StructType([rows.schema[k] for k in keys])
    large = F.broadcast(rows.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in found], schema))
    few = F.broadcast(table.join(large, keys, "left_semi"))
    cold = rows.join(large, keys, "left_anti").join(table, keys, how)
    return cold.unionByName(rows.join(large, keys, "left_semi").join(few, keys, how))
