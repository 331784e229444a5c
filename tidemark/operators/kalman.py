"""Kalman filter (scalar random walk) as a distributed linear scan.

The gain of step ``i`` depends only on ``i`` (and the two variances), so the
filter is the affine recurrence ``x_i = (1 - k_i) x_{i-1} + k_i z_i`` seeded with
the first measurement. For series of one block of ``B`` rows the closed form

    x_i = A_i (seed + S_i),  A_i = exp(sum log(1 - k_j)),  S_i = sum k_j z_j / A_j

is two cumulative window sums (``B`` keeps ``A`` in double range). Longer series are one
scan of rows that lie in order: a row is an affine map, a batch is combined by doubling
steps, and a task holds a batch and a state. In chunks, the partitions of the range index
first yield the maps of their chunks, read from the indexed rows alone, so other filters'
windows run once; the states that enter chunks are a scan over those maps.

Missing measurements (null or NaN) output null and leave the state unchanged; the
gain schedule still advances by row position.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import kernels
from tidemark.operators.index import IDX, N, SeriesSpec, max_series_length
from tidemark.session import written

FOLD_ROWS = 4096


def gain_column(step: Column, process_variance: float, measurement_variance: float) -> Column:
    """Gain of a step column (1, 2, ...) in closed form: no table, any length."""
    q, r = float(process_variance), float(measurement_variance)
    if q < 0 or r < 0:
        raise ValueError("variances must not be negative")
    if r == 0:
        return F.lit(1.0)  # exact measurements: every one resets the state
    if q == 0:
        return F.lit(1.0) / (F.lit(r) + step)
    low, span, u0, log_rate = kernels.kalman_riccati(q, r)
    i = step.cast("double") - 1
    grown = -F.expm1(F.lit(math.log1p(-span / (1.0 - low))) + i * log_rate) if u0 > 0 else F.lit(1.0) - F.lit(u0) * F.exp(i * log_rate)
    p = F.lit(low + q) + F.lit(span) / grown
    return p / (p + r)


def _log_keep(k: Column) -> Column:
    """``log(1 - k)``, floored where the gain is 1 (see ``kernels.kalman_log_keep``)."""
    return F.when(k > 0.5, F.log(F.greatest(F.lit(1.0) - k, F.lit(kernels.KEEP_FLOOR)))).otherwise(F.log1p(-k))


def _row_maps(outputs: dict[str, str], process_variance: float, measurement_variance: float) -> dict[str, Column]:
    """Every row as a map ``x -> A x + B`` of the state, and its measurement ``Z`` (null if missing)."""
    from tidemark.operators.filters import numeric

    idx = F.col(IDX)
    k = gain_column(idx, process_variance, measurement_variance)
    maps = {}
    for i, src in enumerate(outputs.values()):
        z = numeric(src)
        ok = z.isNotNull() & (idx >= 1)
        maps[f"_kA{i}"] = F.when(ok, F.lit(1.0) - k).otherwise(F.lit(1.0))
        maps[f"_kB{i}"] = F.when(ok, k * z).otherwise(F.lit(0.0))
        maps[f"_kZ{i}"] = z
    return maps


def kalman_columns(
    df: DataFrame,
    spec: SeriesSpec,
    outputs: dict[str, str],
    process_variance: float,
    measurement_variance: float,
    max_len: int | None = None,
    base: DataFrame | None = None,
) -> DataFrame:
    """Add Kalman-filtered columns ``{output: source}`` to an indexed frame (``_idx``, ``_n``).

    ``base``: the indexed frame without the columns other filters have added; the maps of chunks
    are read from it, so that those filters run once."""
    block = kernels.kalman_block_rows(process_variance, measurement_variance)
    if spec.chunked:
        block = min(block, spec.rows_per_chunk)
    if max_len is None:
        max_len = int(df.agg(F.max(N)).first()[0] or 0)
    if max_len <= block:
        return _one_block(df, spec, outputs, process_variance, measurement_variance)

    maps = _row_maps(outputs, process_variance, measurement_variance)
    rows = df.withColumns(maps)
    if spec.chunked:
        chunk = F.floor(F.col(IDX) / F.lit(spec.rows_per_chunk)).cast("long")
        narrow = (df if base is None else base).select(
            *[F.col(f"`{c}`").alias(f"_kk{i}") for i, c in enumerate(spec.keys)],
            chunk.alias("_kpos"), F.col(IDX).alias("_kfirst"), *[c.alias(name) for name, c in maps.items()],
        )
        rows = _join_carries(rows, narrow, spec, len(outputs))
    # the same keys and order as the filters before it: rows stay where those windows have put them
    w = Window.partitionBy(*[F.col(f"`{c}`") for c in spec.window_keys()]).orderBy(*[F.col(c) for c in spec.order])
    return _scanned(rows.withColumn("_kstart", F.row_number().over(w) == 1), df.columns, {o: i for i, o in enumerate(outputs)}, spec.chunked)


def _one_block(df: DataFrame, spec: SeriesSpec, outputs: dict[str, str], process_variance: float, measurement_variance: float) -> DataFrame:
    """Series of one block at most: the closed form by two cumulative sums, no Python."""
    from tidemark.operators.filters import numeric

    idx = F.col(IDX)
    k = gain_column(idx, process_variance, measurement_variance)
    names = list(outputs)
    tmp = {}
    for i, src in enumerate(outputs.values()):
        z = numeric(src)
        ok = z.isNotNull() & (idx >= 1)
        tmp[f"_kz{i}"] = z
        tmp[f"_ka{i}"] = F.when(ok, _log_keep(k)).otherwise(F.lit(0.0))
        tmp[f"_kb{i}"] = F.when(ok, k * z).otherwise(F.lit(0.0))
    df = df.withColumns(tmp)
    w = Window.partitionBy(*spec.window_keys()).orderBy(*[F.col(c) for c in spec.order])
    cum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = df.withColumns({f"_kg{i}": F.sum(f"_ka{i}").over(cum) for i in range(len(names))})
    df = df.withColumns({f"_ks{i}": F.sum(F.col(f"_kb{i}") * F.exp(-F.col(f"_kg{i}"))).over(cum) for i in range(len(names))})
    df = df.withColumns({f"_kc{i}": F.first(f"_kz{i}", ignorenulls=True).over(whole) for i in range(len(names))})
    res = {
        out: F.when(F.col(f"_kz{i}").isNotNull(), F.exp(F.col(f"_kg{i}")) * (F.col(f"_kc{i}") + F.col(f"_ks{i}")))
        for i, out in enumerate(names)
    }
    drop = [c for c in df.columns if c.startswith("_k") and c not in res]
    return df.withColumns(res).drop(*drop)


def scan_maps(a: np.ndarray, b: np.ndarray, z: np.ndarray, starts: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States entering and leaving the maps ``x -> a x + b`` of consecutive runs.

    ``starts``: first place of each run (the first is 0); ``entry``: the state each run begins
    with, NaN for none. A run without one takes its first ``z`` that is not NaN as the state
    entering there; before that, states are NaN. Maps are combined with those 1, 2, 4, ...
    places before them, so the work is a few array operations whatever the runs are."""
    n = len(a)
    at, run = np.arange(n), np.zeros(n, dtype=np.int64)
    run[starts[1:]] = 1
    run = np.cumsum(run)
    known = ~np.isnan(entry)
    seeded = np.where(known, starts, np.minimum.reduceat(np.where(np.isnan(z), n, at), starts))
    there = seeded < n
    places = seeded[there]
    scale, shift = a.copy(), b.copy()
    scale[starts], shift[starts] = 0.0, 0.0
    shift[places] = a[places] * np.where(known, entry, np.nan)[there] + b[places]
    fresh = places[~known[there]]
    shift[fresh] = a[fresh] * z[fresh] + b[fresh]
    scale[places] = 0.0
    d = 1
    while d < n and scale[d:].any():
        open_ = scale[d:] != 0.0  # the rest depend on nothing before them
        shift[d:] = np.where(open_, scale[d:] * shift[:-d] + shift[d:], shift[d:])
        scale[d:] = scale[d:] * scale[:-d]
        d *= 2
    after = np.where(at >= seeded[run], shift, np.nan)
    entering = np.concatenate([[np.nan], after[:-1]])
    entering[starts] = entry
    return np.where(np.isnan(entering), z, entering), after


def _doubles(table, column: str) -> np.ndarray:
    return table.column(column).to_numpy(zero_copy_only=False).astype(np.float64)


def _scanned(rows: DataFrame, kept: list[str], outputs: dict[str, int], carried: bool, entering: bool = False) -> DataFrame:
    """``kept`` and the states after (or entering) each row's map, from rows that lie in order:
    ``_kstart`` marks where a run begins, ``_kX`` its state if one is carried in. One pass; a
    task holds a batch and a state."""
    schema = T.StructType([*[rows.schema[c] for c in kept], *[T.StructField(o, T.DoubleType()) for o in outputs]])
    work = [c for c in rows.columns if c[:3] in ("_kA", "_kB", "_kZ", "_kX") or c == "_kstart"]
    rows = rows.select(*[F.col(f"`{c}`").alias(f"_kc{j}") for j, c in enumerate(kept)], *work)  # mapInArrow takes no names with dots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = dict.fromkeys(outputs, np.nan)
        for batch in batches:
            if not batch.num_rows:
                continue
            begins = batch.column("_kstart").to_numpy(zero_copy_only=False).astype(bool)
            goes_on = not begins[0]
            begins[0] = True
            starts = np.flatnonzero(begins)
            arrays = [batch.column(i) for i in range(len(kept))]
            for o, i in outputs.items():
                entry = _doubles(batch, f"_kX{i}")[starts] if carried else np.full(len(starts), np.nan)
                if goes_on:
                    entry[0] = state[o]
                z = _doubles(batch, f"_kZ{i}")
                before, after = scan_maps(_doubles(batch, f"_kA{i}"), _doubles(batch, f"_kB{i}"), z, starts, entry)
                state[o] = after[-1]
                x = before if entering else np.where(np.isnan(z), np.nan, after)
                arrays.append(pa.array(x, mask=np.isnan(x)))
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *outputs])

    return rows.mapInArrow(run, schema)


def _combined(maps: DataFrame, groups: list[str], order: str, ncols: int, consecutive: bool) -> DataFrame:
    """One map for each stretch of rows of a group that lie one after another (``consecutive``:
    with places one after another too), with the place of its first row. Rows may come in any
    order: a group in pieces gives a map a piece."""
    cols = [f"_k{x}{i}" for i in range(ncols) for x in "ABZ"]
    maps = maps.select(*groups, order, *cols, F.xxhash64(*groups).alias("_kseg"))
    schema = T.StructType(maps.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            seg = batch.column("_kseg").to_numpy()
            cut = seg[1:] != seg[:-1]
            if consecutive:
                place = batch.column(order).to_numpy()
                cut |= place[1:] != place[:-1] + 1
            starts = np.concatenate([[0], np.flatnonzero(cut) + 1])
            ends = np.concatenate([starts[1:], [len(seg)]]) - 1
            heads = batch.take(pa.array(starts))
            arrays = [heads.column(c) for c in [*groups, order]]
            for i in range(ncols):
                a, z = _doubles(batch, f"_kA{i}"), _doubles(batch, f"_kZ{i}")
                _, after = scan_maps(a, _doubles(batch, f"_kB{i}"), z, starts, np.zeros(len(starts)))
                first = np.minimum.reduceat(np.where(np.isnan(z), len(z), np.arange(len(z))), starts)
                seed = np.append(z, np.nan)[first]
                arrays += [pa.array(np.multiply.reduceat(a, starts)), pa.array(after[ends]), pa.array(seed, mask=np.isnan(seed))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*groups, order, *cols])

    return maps.mapInArrow(run, schema)


def _join_carries(rows: DataFrame, narrow: DataFrame, spec: SeriesSpec, ncols: int) -> DataFrame:
    """The state ``_kX`` that enters each chunk, on each of its rows. Rows lie in series order in
    the partitions of the range index, so each partition yields a map a chunk (a map a batch
    at most) where it lies; only maps travel."""
    keys = [f"_kk{i}" for i in range(len(spec.keys))]
    maps = written(_combined(narrow, [*keys, "_kpos"], "_kfirst", ncols, consecutive=True), "kalman-maps")
    carries = written(chunk_carries(maps, keys, ncols), "kalman-carries")
    same = F.col("_kpos") == F.col("_chunk")
    for k, c in zip(keys, spec.keys):  # a null key is a series of its own
        same = same & rows[f"`{c}`"].eqNullSafe(F.col(k))
    return rows.join(carries, same, "left")


def chunk_carries(maps: DataFrame, keys: list[str], ncols: int) -> DataFrame:
    """For a table ``(keys, _kpos, _kfirst, _kA, _kB, _kZ)`` of maps, in the order of ``_kfirst``
    within a series and ``_kpos`` never falling, ``(keys, _kpos, _kX)``: the state entering the
    first map of each ``_kpos``. A series of over ``FOLD_ROWS`` maps is first taken ``FOLD_ROWS``
    positions at a time, each solved as one, so no task ever scans a whole long series."""
    by = Window.partitionBy(*keys, "_kpos").orderBy("_kfirst")
    heads = F.row_number().over(by) == 1
    longest = maps.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    span = int(maps.agg(F.max("_kpos")).first()[0] or 0)
    outs = {f"_kX{i}": i for i in range(ncols)}
    kept = [*keys, "_kpos", "_kfirst"]
    if longest <= FOLD_ROWS or span < FOLD_ROWS:
        w = Window.partitionBy(*keys).orderBy("_kfirst") if keys else Window.partitionBy(F.lit(0)).orderBy("_kfirst")
        states = _scanned(maps.withColumn("_kstart", F.row_number().over(w) == 1), kept, outs, False, entering=True)
    else:
        sup = maps.withColumn("_ksup", F.floor(F.col("_kpos") / F.lit(FOLD_ROWS)).cast("long"))
        ordered = sup.repartition(*keys, "_ksup").sortWithinPartitions(*keys, "_ksup", "_kfirst")
        whole = _combined(ordered, [*keys, "_ksup"], "_kfirst", ncols, consecutive=False)
        above = chunk_carries(written(whole.withColumnRenamed("_ksup", "_kpos"), "kalman-supers"), keys, ncols)
        above = above.select(*[F.col(k).alias(f"{k}_s") for k in keys], F.col("_kpos").alias("_kspos"), *outs)
        same = F.col("_ksup") == F.col("_kspos")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"{k}_s"))
        w = Window.partitionBy(*keys, "_ksup").orderBy("_kfirst")
        states = sup.join(above, same, "left").withColumn("_kstart", F.row_number().over(w) == 1)
        states = _scanned(states, kept, outs, True, entering=True)
    return states.withColumn("_khead", heads).where("_khead").select(*keys, "_kpos", *outs)


def kalman_pandas(df: DataFrame, spec: SeriesSpec, column: str, output: str,
                  process_variance: float, measurement_variance: float) -> DataFrame:
    """Cross-check form: the textbook loop per series with ``applyInPandas``.

    One task holds one whole series, so this is only for bounded series.
    """
    cols = list(spec.keys) + list(spec.order) + [column]
    sub = df.select(*cols)
    schema = T.StructType([f for f in sub.schema.fields if f.name != column] + [T.StructField(output, T.DoubleType())])
    q, r = float(process_variance), float(measurement_variance)
    order = list(spec.order)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        z = pdf[column].astype("float64").values
        out = np.full(len(z), np.nan)
        x, p, started, step = None, 1.0, False, 0
        for i, v in enumerate(z):
            if i >= 1:
                pm = p + q
                k = pm / (pm + r) if r > 0 else 1.0
                p = (1.0 - k) * pm
            if np.isnan(v):
                continue
            if not started:
                x, started = v, True
            elif i >= 1:
                x = x + k * (v - x)
            out[i] = x
        res = pdf.drop(columns=[column]).copy()
        res[output] = out
        return res

    return sub.groupBy(*spec.keys).applyInPandas(run, schema)


def kalman_filter(df: DataFrame, spec: SeriesSpec, columns, process_variance: float = 1e-5,
                  measurement_variance: float = 0.1) -> DataFrame:
    """Replace ``columns`` by their Kalman-filtered values (indexes the frame itself)."""
    from tidemark.operators.filters import apply_filter

    return apply_filter(df, spec, "kalman", columns, process_variance=process_variance,
                        measurement_variance=measurement_variance)


__all__ = ["kalman_columns", "kalman_filter", "kalman_pandas", "chunk_carries", "scan_maps", "max_series_length"]
