"""Wide filters on rows that stream past in series order.

A Savitzky-Golay window or a median kernel of hundreds of rows is a plan of as many shifts a
row as a window expression. Here the rows of many series (or chunks with their halos) pass
through a task in order, in pieces with as much context as the filter reaches, and the
filters work on arrays: a dot product per row, or one insertion and one removal in a
sorted block. A task holds a piece and its context, however long the series.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.index import CHUNK, IDX, N, OWNER, SeriesSpec, expand_halo

PIECE_ROWS = 1 << 16  # rows worked on at once
_DOT_ROWS = 4096  # windows held at once


def pieces(batches: Iterator[pa.RecordBatch], reach: int, rows: int) -> Iterator[tuple[pa.Table, int, int]]:
    """Consecutive rows of a task in pieces ``(table, first, end)``: the rows ``[first, end)``
    are to be worked on, up to ``reach`` rows before and after them are context."""
    held: list[pa.RecordBatch] = []
    size = first = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size - first < rows + reach:
            continue
        table = pa.Table.from_batches(held)
        yield table, first, size - reach
        begin = max(0, size - 2 * reach)  # context of the rows that are still to come
        held = table.slice(begin).combine_chunks().to_batches()
        first, size = size - reach - begin, size - begin
    if size > first:
        yield pa.Table.from_batches(held), first, size


def polynomial_smooth(x: np.ndarray, idx: np.ndarray, n: np.ndarray, rows: np.ndarray, hat: np.ndarray) -> np.ndarray:
    """Savitzky-Golay at ``rows`` of one series' run: each row's window (the first or last one
    near an end) times its row of the hat matrix. A missing value makes its windows missing."""
    width = len(hat)
    out = np.where(n[rows] < width, x[rows], np.nan)
    rows_ = np.flatnonzero(n[rows] >= width)
    if not len(rows_) or len(x) < width:
        return out
    windows = np.lib.stride_tricks.sliding_window_view(x, width)
    for at in range(0, len(rows_), _DOT_ROWS):
        some = rows_[at : at + _DOT_ROWS]
        place = idx[rows[some]]
        low = np.clip(place - width // 2, 0, n[rows[some]] - width)
        out[some] = np.einsum("ij,ij->i", windows[rows[some] - (place - low)], hat[place - low])
    return out


def sliding_median(x: np.ndarray, idx: np.ndarray, n: np.ndarray, rows: np.ndarray, width: int, edge: str) -> np.ndarray:
    """Median at ``rows`` (consecutive) of one series' run: the window's values in a sorted block,
    one value in and one out a row. Outside the series are zeros (``edge="zero"``) or nothing
    (``"shrink"``). A missing value makes its windows missing."""
    h = width // 2
    out = np.where(n[rows] < width, x[rows], np.nan)
    if not len(rows) or n[rows[0]] < width:
        return out
    length, values, shift = int(n[rows[0]]), x.tolist(), int(idx[rows[0]]) - int(rows[0])  # position = place in x + shift

    def at(position: int) -> float | None:
        if 0 <= position < length:
            return values[position - shift]
        return 0.0 if edge == "zero" else None

    block: list[float] = []
    missing = 0
    first = int(idx[rows[0]])
    for position in range(first - h, first + h):  # all but the newest of the first window
        v = at(position)
        if v is not None:
            if v == v:
                insort(block, v)
            else:
                missing += 1
    for k, position in enumerate(range(first, first + len(rows))):
        v = at(position + h)
        if v is not None:
            if v == v:
                insort(block, v)
            else:
                missing += 1
        if not missing:
            m = len(block)
            out[k] = block[m // 2] if m % 2 else (block[m // 2 - 1] + block[m // 2]) / 2
        v = at(position - h)
        if v is not None:
            if v == v:
                del block[bisect_left(block, v)]
            else:
                missing -= 1
    return out


def streamed_columns(df: DataFrame, spec: SeriesSpec, outputs: dict[str, tuple[str, object]]) -> DataFrame:
    """Add ``{output: (source, filter)}`` to an indexed frame; a filter has ``reach`` (rows on
    either side) and ``smooth(x, idx, n, rows)``."""
    from tidemark.operators.filters import numeric

    reach = max(f.reach for _, f in outputs.values())
    base = df.drop(CHUNK) if spec.chunked else df
    kept = base.columns
    base = expand_halo(base, spec, reach, reach)
    keys = [F.col(f"`{k}`") for k in spec.keys] + ([F.col(CHUNK)] if spec.chunked else [])
    marks = {"_seg": F.xxhash64(*keys), "_own": F.col(CHUNK) == F.col(OWNER) if spec.chunked else F.lit(True)}
    sources = list(dict.fromkeys(c for c, _ in outputs.values()))
    base = base.withColumns(marks | {f"_z{i}": numeric(c) for i, c in enumerate(sources)})
    ordered = base.repartition(*keys).sortWithinPartitions(*keys, F.col(IDX))
    schema = T.StructType([*[ordered.schema[c] for c in kept], *[T.StructField(o, T.DoubleType()) for o in outputs]])
    names = {c: f"_c{j}" for j, c in enumerate(kept)}  # mapInArrow takes no names with dots
    ordered = ordered.select(*[F.col(f"`{c}`").alias(name) for c, name in names.items()], "_seg", "_own", *[f"_z{i}" for i in range(len(sources))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, first, end in pieces(batches, reach, PIECE_ROWS):
            idx, n, seg = (table[c].combine_chunks().to_numpy() for c in (names[IDX], names[N], "_seg"))
            xs = [table[f"_z{i}"].combine_chunks().to_numpy(zero_copy_only=False).astype(np.float64) for i in range(len(sources))]
            cuts = np.flatnonzero((seg[1:] != seg[:-1]) | (idx[1:] != idx[:-1] + 1)) + 1
            results = {o: np.full(len(idx), np.nan) for o in outputs}
            own = table["_own"].combine_chunks().to_numpy(zero_copy_only=False)
            for a, b in zip([0, *cuts], [*cuts, len(idx)]):
                rows = np.arange(max(a, first), min(b, end))
                rows = rows[own[rows]] - a  # copies for a neighbour are context only
                if not len(rows):
                    continue
                for o, (c, f) in outputs.items():
                    results[o][a + rows] = f.smooth(xs[sources.index(c)][a:b], idx[a:b], n[a:b], rows)
            whole = table.select(list(names.values())).rename_columns(kept)
            for o, v in results.items():
                whole = whole.append_column(o, pa.array(v, mask=np.isnan(v)))
            yield from whole.slice(first, end - first).filter(pa.array(own[first:end])).combine_chunks().to_batches()

    return ordered.mapInArrow(run, schema)
