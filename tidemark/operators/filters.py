"""Smoothing filters as window expressions over ordered series.

Every filter except Kalman is a closed-form expression of a few neighbouring
rows, the row's position ``_idx`` and the series length ``_n``, evaluated with
``lag``/``lead`` over one shared window (one shuffle and one sort for all filters
and columns). Edges follow the reference library defaults: moving-average frames
shrink at the ends, the median pads with zeros, Savitzky-Golay fits one
polynomial to the first/last window, the Gaussian reflects about the half sample.

Missing values: NaN is treated as null, and a null among the values a filter
actually reads for a row gives a null result for that row.
"""

from __future__ import annotations

import warnings
from abc import ABC, abstractmethod
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import kernels
from tidemark.operators.index import IDX, N, SeriesSpec, drop_halo, expand_halo, max_series_length, resolve, with_index_info
from tidemark.operators.streamed import polynomial_smooth, sliding_median, streamed_columns

WIDE = 25  # rows of a window from which a filter works on streamed rows instead of shifts


def qcol(name: str) -> Column:
    """Column by exact name (names may hold spaces, brackets, dots or unit signs)."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric(name: str) -> Column:
    """The column as double with NaN turned into null."""
    c = qcol(name).cast("double")
    return F.nanvl(c, F.lit(None).cast("double"))


class SmoothingFilter(ABC):
    """A filter: ``name``, ``params()`` and a window expression or a scan.

    ``sql(x, w)`` returns Spark SQL text for the filtered value of the column named
    ``x`` (already double, NaN as null) on an indexed frame, where ``w`` is the
    ``PARTITION BY ... ORDER BY ...`` clause of the series window. It may instead
    return ``(helpers, final)``: helper expressions computed once per row and a
    function building the result from the helper column names.
    """

    name: str = ""
    scan = False
    streamed = False  # a window too wide for an expression: see ``streamed_columns``

    def params(self) -> dict[str, float]:
        return {}

    def halo(self) -> tuple[int, int]:
        """Rows of context needed before and after a row."""
        return (0, 0)

    @abstractmethod
    def sql(self, x: str, w: str):
        """Filtered value of column ``x`` (see class docstring)."""


def _shift(x: str, o: int, w: str, default: str | None = None) -> str:
    if o == 0:
        return x
    d = f", {default}" if default is not None else ""
    fn = "lead" if o > 0 else "lag"
    return f"{fn}({x}, {abs(o)}{d}) OVER ({w})"


def _num(v: float) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def _frame_size(h_left: int, h_right: int) -> str:
    return f"(least({IDX} + {h_right}, {N} - 1) - greatest({IDX} - {h_left}, 0) + 1)"


class NoFilter(SmoothingFilter):
    name = "none"

    def sql(self, x, w):
        return x


@dataclass
class MovingAverageFilter(SmoothingFilter):
    window: int = config.MA_WINDOW
    head: str = "expanding"

    name = "moving_average"

    def __post_init__(self):
        self.window = int(self.window)
        if self.window < 1:
            raise ValueError("moving_average window must be at least 1")
        if self.head not in ("expanding", "as_reference"):
            raise ValueError("head must be 'expanding' or 'as_reference'")

    def params(self):
        return {"window": float(self.window)}

    def halo(self):
        h = self.window // 2
        return (h, 2 * h - 1 if self.head == "as_reference" else h)

    def sql(self, x, w):
        h = self.window // 2
        frame = f"OVER ({w} ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)"
        size = _frame_size(h, h)
        total = f"sum({x}) {frame}"
        complete = f"count({x}) {frame} = {size}"
        if self.head == "expanding":
            return f"CASE WHEN {N} < {self.window} THEN {x} WHEN {complete} THEN {total} / {size} END"
        # Reference arithmetic: head row i sums 2i+h+1 values over h+i+1, the
        # interior sums 2h+1 values over ``window``; series shorter than 3h-1 fail.
        parts = [f"WHEN {N} < {self.window} THEN {x}", f"WHEN NOT ({complete}) OR {N} < {3 * h - 1} THEN NULL"]
        for i in range(h):
            extra = "".join(f" + {_shift(x, o, w)}" for o in range(h + 1, i + h + 1))
            parts.append(f"WHEN {IDX} = {i} THEN ({total}{extra}) / {h + i + 1}")
        parts.append(f"WHEN {IDX} >= {N} - {h} THEN {total} / ({h} + {N} - {IDX})")
        parts.append(f"ELSE {total} / {self.window}")
        return "CASE " + " ".join(parts) + " END"


@dataclass
class MedianFilter(SmoothingFilter):
    kernel_size: int = config.MEDIAN_KERNEL_SIZE
    edge: str = "zero"

    name = "median"

    def __post_init__(self):
        self.kernel_size = kernels.median_kernel(self.kernel_size)
        if self.edge not in ("zero", "shrink"):
            raise ValueError("edge must be 'zero' or 'shrink'")

    def params(self):
        return {"kernel_size": float(self.kernel_size)}

    def halo(self):
        h = self.kernel_size // 2
        return (h, h)

    @property
    def streamed(self):
        return self.kernel_size > WIDE

    @property
    def reach(self):
        return self.kernel_size // 2

    def smooth(self, x, idx, n, rows):
        return sliding_median(x, idx, n, rows, self.kernel_size, self.edge)

    def sql(self, x, w):
        k = self.kernel_size
        h = k // 2
        if self.edge == "zero":
            vals = [_shift(x, o, w, "0.0D") for o in range(-h, h + 1)]
            nulls = " OR ".join(f"{v} IS NULL" for v in vals)
            med = f"element_at(array_sort(array({', '.join(vals)})), {h + 1})"
            return f"CASE WHEN {N} < {k} THEN {x} WHEN {nulls} THEN NULL ELSE {med} END"
        vals = [_shift(x, o, w) for o in range(-h, h + 1)]
        size = _frame_size(h, h)
        present = " + ".join(f"CAST({v} IS NOT NULL AS INT)" for v in vals)
        srt = f"array_sort(array({', '.join(vals)}))"  # nulls (outside the series) sort last
        lo = f"element_at({srt}, CAST(floor(({size} + 1) / 2) AS INT))"
        hi = f"element_at({srt}, CAST(floor({size} / 2) AS INT) + 1)"
        return f"CASE WHEN {N} < {k} THEN {x} WHEN {present} = {size} THEN ({lo} + {hi}) / 2 END"


@dataclass
class SavitzkyGolayFilter(SmoothingFilter):
    window: int = config.SG_WINDOW
    polyorder: int = config.SG_POLYORDER

    name = "savitzky_golay"

    def __post_init__(self):
        self.window, self.polyorder = kernels.savgol_params(self.window, self.polyorder)

    def params(self):
        return {"window": float(self.window), "polyorder": float(self.polyorder)}

    def halo(self):
        return (self.window - 1, self.window - 1)

    @property
    def streamed(self):
        return self.window > WIDE

    @property
    def reach(self):
        return self.window - 1

    def smooth(self, x, idx, n, rows):
        return polynomial_smooth(x, idx, n, rows, np.array(kernels.savgol_hat(self.window, self.polyorder)))

    def sql(self, x, w):
        width = self.window
        h = width // 2
        hat = kernels.savgol_hat(width, self.polyorder)
        # Interior rows: a fixed dot product with the middle hat row. Edge rows pick
        # their hat row and window start; the table of hat rows is in the plan once, the
        # row's weights and the shift array are built once per row.
        interior = " + ".join(f"{_num(hat[h][d + h])} * {_shift(x, d, w)}" for d in range(-h, h + 1))
        rows = ", ".join(f"array({', '.join(_num(v) for v in row)})" for row in hat)
        lo = f"least(greatest({IDX} - {h}, 0), {N} - {width})"
        place = f"CAST(least(greatest({IDX} - {lo}, 0), {width - 1}) + 1 AS INT)"  # short series take no weights
        helpers = {
            "vals": f"array({', '.join(_shift(x, o, w) for o in range(-(width - 1), width))})",
            "lo": lo,
            "hat": f"element_at(array({rows}), {place})",
            "mid": interior,
        }

        def final(col):
            base = f"CAST({col('lo')} - {IDX} + {width} AS INT)"
            edge = " + ".join(f"element_at({col('hat')}, {j + 1}) * element_at({col('vals')}, {base} + {j})" for j in range(width))
            return (f"CASE WHEN {N} < {width} THEN {x} WHEN {IDX} >= {h} AND {IDX} < {N} - {h} THEN {col('mid')} "
                    f"ELSE {edge} END")

        return helpers, final


@dataclass
class GaussianFilter(SmoothingFilter):
    sigma: float = config.GAUSSIAN_SIGMA
    truncate: float = config.GAUSSIAN_TRUNCATE

    name = "gaussian"

    def __post_init__(self):
        self.sigma = float(self.sigma)
        if self.sigma <= 0:
            raise ValueError("sigma must be positive")

    def params(self):
        return {"sigma": self.sigma}

    def halo(self):
        r = kernels.gaussian_radius(self.sigma, self.truncate)
        return (r, r)

    def sql(self, x, w):
        weights = kernels.gaussian_weights(self.sigma, self.truncate)
        rad = len(weights) // 2
        interior = " + ".join(f"{_num(wt)} * {_shift(x, d, w)}" for d, wt in zip(range(-rad, rad + 1), weights))
        helpers = {
            "vals": f"array({', '.join(_shift(x, o, w) for o in range(-rad, rad + 1))})",
            "mid": interior,
        }

        def final(col):
            terms = []
            for d, wt in zip(range(-rad, rad + 1), weights):
                # half-sample reflection, repeated for series shorter than the radius
                m = f"pmod({IDX} + {d}, 2 * {N})"
                folded = f"CASE WHEN {m} < {N} THEN {m} ELSE 2 * {N} - 1 - {m} END"
                terms.append(f"{_num(wt)} * element_at({col('vals')}, CAST({folded} - {IDX} + {rad + 1} AS INT))")
            return f"CASE WHEN {IDX} >= {rad} AND {IDX} < {N} - {rad} THEN {col('mid')} ELSE {' + '.join(terms)} END"

        return helpers, final


@dataclass
class KalmanFilter(SmoothingFilter):
    process_variance: float = config.KALMAN_PROCESS_VARIANCE
    measurement_variance: float = config.KALMAN_MEASUREMENT_VARIANCE

    name = "kalman"
    scan = True

    def params(self):
        return {"process_variance": float(self.process_variance), "measurement_variance": float(self.measurement_variance)}

    def sql(self, x, w):
        raise TypeError("kalman is a scan; use apply_filters")


FILTERS: dict[str, type] = {
    "none": NoFilter,
    "savitzky_golay": SavitzkyGolayFilter,
    "moving_average": MovingAverageFilter,
    "gaussian": GaussianFilter,
    "median": MedianFilter,
    "kalman": KalmanFilter,
}


def list_filters() -> list[str]:
    return list(FILTERS)


def register_filter(name: str, cls: type) -> None:
    """Extension point: add a :class:`SmoothingFilter` subclass under ``name``."""
    FILTERS[name.lower()] = cls


def create_filter(filter_type: str | SmoothingFilter, **params) -> SmoothingFilter:
    if isinstance(filter_type, SmoothingFilter):
        return filter_type
    cls = FILTERS.get(str(filter_type).lower())
    if cls is None:
        raise ValueError(f"no filter named {filter_type!r}; there are {', '.join(FILTERS)}")
    return cls(**params)


def select_filters(names) -> list[str]:
    """P9 (legacy runners): comma list or sequence of names, lower-cased; unknown
    names are dropped and an empty result falls back to every filter."""
    if isinstance(names, str):
        names = [n.strip() for n in names.split(",")]
    known = [n.lower() for n in (names or []) if n and n.lower() in FILTERS]
    return known or list(FILTERS)


def usable_filters(filters) -> tuple[list[tuple[str, SmoothingFilter]], list[tuple[str, str]]]:
    """``(label, filter)`` pairs of the filters that can be made, and ``(label, reason)``
    of those that cannot: one bad name or parameter does not stop the others."""
    good, bad = [], []
    for f in filters:
        label, what = f if isinstance(f, tuple) else (None, f)
        try:
            obj = create_filter(what)
            good.append((label or obj.name, obj))
        except Exception as exc:  # noqa: BLE001 - the reason is kept
            bad.append((str(label or what), f"{type(exc).__name__}: {exc}"))
    return good, bad


def filter_status(spark, filters=config.FILTERS_TO_COMPARE) -> DataFrame:
    """``filter_type, run_order, skipped_reason`` (null: it runs) for a list of filters."""
    good, bad = usable_filters(filters)
    rows = [(label, i, None) for i, (label, _) in enumerate(good)] + [(label, None, reason) for label, reason in bad]
    return spark.createDataFrame(rows, "filter_type string, run_order int, skipped_reason string")


def present_columns(df: DataFrame, columns) -> list[str]:
    """Keep the requested columns that exist (missing ones are skipped with a warning)."""
    have = set(df.columns)
    if missing := [c for c in columns if c not in have]:
        warnings.warn(f"columns not in the table: {', '.join(missing)}", stacklevel=3)
    return [c for c in columns if c in have]


def out_name(column: str, label: str) -> str:
    return f"{column}__{label}"


def apply_filters(
    df: DataFrame,
    spec: SeriesSpec,
    filters,
    columns,
    indexed: bool = False,
    keep_index: bool = False,
) -> DataFrame:
    """Wide form: one pass adds ``<column>__<filter>`` for every filter and column.

    ``filters`` is a list of names, filter objects or ``(label, filter)`` pairs.
    All window filters share one window node; Kalman runs as a block scan on the
    same index.
    """
    from tidemark.operators.kalman import kalman_columns

    pairs = []
    for f in filters:
        if isinstance(f, tuple):
            label, obj = f
            pairs.append((label, create_filter(obj)))
        else:
            obj = create_filter(f)
            pairs.append((obj.name, obj))
    cols = present_columns(df, columns)
    if not indexed:
        spec, _ = resolve(df, spec)
    known_len = spec.max_len
    if indexed:
        base = df
    else:
        base, known_len = with_index_info(df, spec)
    windowed = [(label, f) for label, f in pairs if not f.scan and not f.streamed]
    wide = {out_name(c, label): (c, f) for label, f in pairs if f.streamed for c in cols}
    scans = [(label, f) for label, f in pairs if f.scan]
    out = base
    if windowed:
        left = max(f.halo()[0] for _, f in windowed)
        right = max(f.halo()[1] for _, f in windowed)
        out = expand_halo(out, spec, left, right)
        w = spec.window_sql()
        xs = {f"_x{ci}": numeric(c) for ci, c in enumerate(cols)}
        out = out.withColumns(xs)
        exprs, helpers, finals = {}, {}, {}
        for ci, c in enumerate(cols):
            for fi, (label, f) in enumerate(windowed):
                res = f.sql(f"_x{ci}", w)
                if isinstance(res, tuple):
                    # staged filter: helper columns computed once, then the result
                    hsql, final = res
                    prefix = f"_h{ci}_{fi}_"
                    helpers.update({prefix + k: F.expr(v) for k, v in hsql.items()})
                    finals[out_name(c, label)] = F.expr(final(lambda k, p=prefix: p + k))
                else:
                    exprs[out_name(c, label)] = F.expr(res)
        out = out.withColumns({**exprs, **helpers})
        if finals:
            out = out.withColumns(finals)
        out = out.drop(*helpers, *xs)
        out = drop_halo(out, spec)
    # a scan's blocks lie within chunks of the spec's own size; a wider halo has made longer ones
    if scans and spec.chunked and (not windowed or max(left, right) > spec.rows_per_chunk):
        out = out.withColumn("_chunk", F.floor(F.col(IDX) / F.lit(spec.rows_per_chunk)).cast("long"))
    max_len = known_len
    if scans and max_len is None:
        max_len = max_series_length(df, spec)
    for label, f in scans:
        out = kalman_columns(out, spec, {out_name(c, label): c for c in cols}, f.process_variance, f.measurement_variance, max_len=max_len, base=base)
    if wide:
        out = streamed_columns(out, spec, wide)
    if spec.chunked:
        out = out.drop("_chunk")
    if not keep_index:
        out = out.drop(IDX, N)
    return out


def apply_filter(df: DataFrame, spec: SeriesSpec, filter_type="none", columns=None, **params) -> DataFrame:
    """Apply one filter to ``columns`` in place; other columns are untouched."""
    f = create_filter(filter_type, **params)
    cols = present_columns(df, columns or [])
    wide = apply_filters(df, spec, [("f", f)], cols)
    return wide.withColumns({c: qcol(out_name(c, "f")) for c in cols}).drop(*[out_name(c, "f") for c in cols])


def filters_long(
    df: DataFrame,
    spec: SeriesSpec,
    filters=config.FILTERS_TO_COMPARE,
    columns=(),
    carry=(),
    include_original: bool = False,
    keep_index: bool = False,
) -> DataFrame:
    """Long form (F8/F11): one row per input row and filter, columns keep their names.

    ``carry`` lists extra columns to keep (keys and order are always kept). With
    ``include_original`` each output row also holds ``<column>__original``, with
    ``keep_index`` its place in the series, for later steps that need not index again.
    """
    filters, _ = usable_filters(filters)  # the reasons of the others: filter_status
    names = [label for label, _ in filters]
    cols = present_columns(df, columns)
    keep = list(dict.fromkeys([*spec.keys, *spec.order, *carry]))
    # only the needed columns go through the index (and its checkpoint when chunked)
    df = df.select(*[qcol(c) for c in dict.fromkeys([*keep, *cols])])
    wide = apply_filters(df, spec, filters, cols, keep_index=keep_index)
    keep += [IDX, N] if keep_index else []
    run_order = {name: i for i, name in enumerate(names)}
    structs = [
        F.struct(
            F.lit(name).alias("filter_type"),
            F.lit(run_order[name]).alias("run_order"),
            *[qcol(out_name(c, name)).alias(c) for c in cols],
        )
        for name in names
    ]
    rows = wide.select(*[qcol(k) for k in keep], *([numeric(c).alias(out_name(c, "original")) for c in cols] if include_original else []), F.explode(F.array(*structs)).alias("_f"))
    return rows.select(*[qcol(k) for k in keep], "_f.*", *([qcol(out_name(c, "original")) for c in cols] if include_original else []))


def compare_filter_effects(
    df: DataFrame,
    spec: SeriesSpec,
    filters=config.FILTERS_TO_COMPARE,
    columns=(),
    metric: str = "mse",
    by_series: bool = False,
) -> DataFrame:
    """per filter and column, how much the filter changes the signal.

    ``mse`` = mean((o - f)^2), ``mae`` = mean |o - f|, ``var`` = var_pop(f) /
    var_pop(o) (0 when the original is constant); other metric names give NaN.
    Computed in one aggregation over the long form; ``by_series`` adds the keys.
    """
    cols = present_columns(df, columns)
    filters, _ = usable_filters(filters)
    names = [label for label, _ in filters]
    df = df.select(*[qcol(c) for c in dict.fromkeys([*spec.keys, *spec.order, *cols])])
    wide = apply_filters(df, spec, filters, cols)
    m = metric.lower()
    group = list(spec.keys) if by_series else []
    # Aggregate on the wide frame (no row explosion), then unpivot the small result.
    aggs = {}
    for i, name in enumerate(names):
        for j, c in enumerate(cols):
            o, f = numeric(c), qcol(out_name(c, name))
            if m == "mse":
                value = F.avg((o - f) * (o - f))
            elif m == "mae":
                value = F.avg(F.abs(o - f))
            elif m == "var":
                vo = F.var_pop(o)
                value = F.when(vo > 0, F.var_pop(f) / vo).otherwise(F.lit(0.0))
            else:
                value = F.lit(float("nan"))
            aggs[f"_m{i}_{j}"] = value
    grouped = wide.groupBy(*[qcol(k) for k in group]) if group else wide
    agg = grouped.agg(*[v.alias(k) for k, v in aggs.items()])
    rows = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("filter_type"),
                    F.lit(i).alias("run_order"),
                    F.lit(c).alias("column"),
                    F.col(f"_m{i}_{j}").cast("double").alias(m),
                )
                for i, name in enumerate(names)
                for j, c in enumerate(cols)
            ]
        )
    )
    return agg.select(*[qcol(k) for k in group], rows.alias("_p")).select(*[qcol(k) for k in group], "_p.*")


def pivot_comparison(comparison: DataFrame, metric: str = "mse", columns=None) -> DataFrame:
    """filter rows x column columns (pass ``columns`` to skip the distinct scan)."""
    g = comparison.groupBy("filter_type", "run_order")
    g = g.pivot("column", list(columns)) if columns is not None else g.pivot("column")
    return g.agg(F.first(metric))


def filter_params(filters=config.FILTERS_TO_COMPARE) -> DataFrame:
    """filter name -> parameter map (a tiny driver-built table)."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rows = []
    for i, f in enumerate(filters):
        obj = create_filter(f)
        rows.append((obj.name, i, {k: float(v) for k, v in obj.params().items()}))
    return spark.createDataFrame(rows, "filter_type string, run_order int, params map<string,double>")
