"""Metrics from Python functions whose states merge, for groups of any size.

A metric is four functions: ``start()`` gives a state (an array of doubles), ``add(state,
labels, predictions)`` takes the rows of one group in one Arrow batch, ``merge(state, state)``
joins two, ``finish(state)`` gives the value. Every task folds its batches and sends one
state per group; states meet in two shuffles, first in ``SALTS`` shares of the tasks, then
all of a group. Rows are never dealt by group, so a hot group is folded where its rows lie, and
a merging task holds one state at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

HELD_GROUPS = 4096  # groups whose states a task keeps before it sends them on
SALTS = 64


@dataclass(frozen=True)
class Mergeable:
    start: Callable[[], np.ndarray]
    add: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    merge: Callable[[np.ndarray, np.ndarray], np.ndarray]
    finish: Callable[[np.ndarray], float]


def _guarded(fn: Callable, *args):
    """A function that fails makes its metric NaN (a null state) and leaves the others alone."""
    if any(a is None for a in args):
        return None
    try:
        return fn(*args)
    except Exception:  # noqa: BLE001 - user code
        return None


def _rows_of(batch: pa.RecordBatch, names: list[str]) -> list[tuple]:
    columns = [batch.column(n).to_pylist() for n in names]
    return list(zip(*columns)) if columns else [()] * batch.num_rows


def _same(key: tuple) -> tuple:
    return tuple("nan" if isinstance(v, float) and v != v else v for v in key)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _groups_of(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """The different keys of a batch, each with the places of its rows."""
    if not names:
        yield (), np.arange(batch.num_rows)
        return
    codes = np.column_stack([batch.column(n).dictionary_encode("encode").indices.to_numpy() for n in names])
    _, first, group = np.unique(codes, axis=0, return_index=True, return_inverse=True)
    order = np.argsort(group.ravel(), kind="stable")
    places = np.split(order, np.cumsum(np.bincount(group.ravel()))[:-1])
    yield from zip(_rows_of(batch.take(pa.array(first)), names), places)


def _fold(metrics: list[Mergeable], names: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[tuple, list]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            y, p = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_y", "_p"))
            for key, at in _groups_of(batch, names):
                states = held.setdefault(_same(key), (key, [_guarded(m.start) for m in metrics]))[1]
                states[:] = [_guarded(m.add, s, y[at], p[at]) for m, s in zip(metrics, states)]
            if len(held) > HELD_GROUPS:
                yield _batch([(*key, *states) for key, states in held.values()], schema)
                held = {}
        if held:
            yield _batch([(*key, *states) for key, states in held.values()], schema)

    return run


def _merge(metrics: list[Mergeable], names: list[str], schema: pa.Schema, finish: bool):
    """Rows sorted by group -> one row a group: its merged states, or their values."""

    def end(key: tuple, states: list) -> tuple:
        if not finish:
            return (*key, *states)
        values = [_guarded(m.finish, s) for m, s in zip(metrics, states)]
        return (*key, *[float("nan") if v is None else float(v) for v in values])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            columns = [batch.column(f"_s{i}") for i in range(len(metrics))]
            for at, key in enumerate(_rows_of(batch, names)):
                states = [c[at].values.to_numpy() if c[at].is_valid else None for c in columns]
                if now is not None and _same(now[0]) == _same(key):
                    now = now[0], [_guarded(m.merge, a, b) for m, a, b in zip(metrics, now[1], states)]
                    continue
                if now is not None:
                    done.append(end(*now))
                now = key, states
            if len(done) > HELD_GROUPS:
                yield _batch(done, schema)
                done = []
        if now is not None:
            done.append(end(*now))
        if done:
            yield _batch(done, schema)

    return run


def fold(df: DataFrame, y, p, group: list[str], metrics: dict[str, Mergeable]) -> DataFrame:
    """One row per group (one row without ``group``): ``group``, one double per metric.

    Only rows with a label and a prediction reach a metric; a group without such rows is
    absent (so is the only row of an ungrouped call). A null group is a group; the
    columns of ``group`` are of plain types. A metric whose function raises is NaN.
    """
    from tidemark.functions.metrics import present
    from tidemark.operators.filters import qcol

    def key(c: str):
        real = isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
        return (qcol(c) + F.lit(0).cast(df.schema[c].dataType) if real else qcol(c)).alias(c)  # -0.0 is 0.0

    rows = df.where(present(y, p)).select(*[key(c) for c in group], y.alias("_y"), p.alias("_p"))
    keys = [rows.schema[c] for c in group]
    partial = T.StructType([*keys, *[T.StructField(f"_s{i}", T.ArrayType(T.DoubleType())) for i in range(len(metrics))]])
    result = T.StructType([*keys, *[T.StructField(n, T.DoubleType()) for n in metrics]])
    specs, by = list(metrics.values()), [qcol(c) for c in group]
    states = rows.mapInArrow(_fold(specs, group, to_arrow_schema(partial)), partial)
    salted = states.withColumn("_salt", F.spark_partition_id() % F.lit(SALTS)).repartition(*by, "_salt")
    salted = salted.sortWithinPartitions(*by, "_salt") if group else salted
    fewer = salted.mapInArrow(_merge(specs, group, to_arrow_schema(partial), False), partial)
    whole = fewer.repartition(*by).sortWithinPartitions(*by) if group else fewer.repartition(1)
    return whole.mapInArrow(_merge(specs, group, to_arrow_schema(result), True), result)
