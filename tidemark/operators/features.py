"""Scaling, lag sequences and the chronological split.

All per-series steps reuse the series window (same keys and order), so on an
already-filtered frame they add sorts at most, never another shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import config
from tidemark.operators.filters import numeric, qcol
from tidemark.operators.index import IDX, N, SeriesSpec, drop_halo, expand_halo, resolve, with_index
from tidemark.session import written

_EPS64 = 2.220446049250313e-16


def _stats_exprs(columns, kind: str) -> dict[str, Column]:
    out = {}
    for c in columns:
        x = numeric(c)
        if kind == "standard":
            out[f"{c}__mean"] = F.avg(x)
            out[f"{c}__std"] = F.stddev_pop(x)
            out[f"{c}__cnt"] = F.count(x)
        elif kind == "minmax":
            out[f"{c}__min"] = F.min(x)
            out[f"{c}__max"] = F.max(x)
        else:
            raise ValueError("scaler kind must be 'standard' or 'minmax'")
    return out


def _scaled(c: str, kind: str) -> Column:
    x = numeric(c)
    if kind == "standard":
        mean, std, cnt = qcol(f"{c}__mean"), qcol(f"{c}__std"), qcol(f"{c}__cnt").cast("double")
        var = std * std
        # a feature is constant when its variance is within rounding of zero
        const = var <= cnt * F.lit(_EPS64) * var + (cnt * mean * F.lit(_EPS64)) * (cnt * mean * F.lit(_EPS64))
        scale = F.when(const | std.isNull(), F.lit(1.0)).otherwise(std)
        return (x - mean) / scale
    lo, hi = qcol(f"{c}__min"), qcol(f"{c}__max")
    rng = hi - lo
    return (x - lo) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)


def fit_scaler(df: DataFrame, columns, kind: str = "standard", group=(), where: Column | None = None) -> DataFrame:
    """Z3: fitted scaler parameters, one row per group (``group=()``: one row).

    Standard uses the population standard deviation; min-max maps constants to 0.
    ``where`` restricts the rows used for fitting (e.g. the training part).
    """
    src = df.where(where) if where is not None else df
    g = src.groupBy(*[qcol(k) for k in group]) if group else src
    return g.agg(*[v.alias(k) for k, v in _stats_exprs(columns, kind).items()])


def apply_scaler(df: DataFrame, params: DataFrame, columns, kind: str = "standard", group=()) -> DataFrame:
    """Scale ``columns`` in place with a parameter table from :func:`fit_scaler`.

    A null group key has parameters of its own. How to join is left to Spark, which
    knows the table's bytes.
    """
    params = written(params, "scaler")
    if group:
        names = [f"_sg{i}" for i in range(len(group))]
        params = params.select(*[qcol(c).alias(n) for c, n in zip(group, names)], *[qcol(c) for c in params.columns if c not in group])
        same = reduce(lambda a, b: a & b, [df[f"`{c}`"].eqNullSafe(F.col(n)) for c, n in zip(group, names)])
        joined = df.join(params, same, "left").drop(*names)
    else:
        joined = df.withColumn("_one", F.lit(1)).join(params.withColumn("_one", F.lit(1)), "_one", "left").drop("_one")
    helper = [c for c in params.columns if c not in group and c in joined.columns]
    return joined.withColumns({c: _scaled(c, kind) for c in columns}).drop(*helper)


def scale_series(df: DataFrame, spec: SeriesSpec, columns, kind: str = "standard", fit_rows: Column | None = None) -> DataFrame:
    """Z1/Z2 per series without a join: statistics as whole-series window aggregates.

    ``fit_rows`` (a boolean column) limits the rows the statistics are fitted on,
    e.g. ``F.col("_idx") < train_end`` for a leak-free fit. For chunked specs (a hot
    series under ``chunk_rows="auto"``, too) the statistics are aggregated per series and
    joined back instead.
    """
    spec, _ = resolve(df, spec)
    if spec.chunked:
        keys = list(spec.keys)
        if keys:
            params = fit_scaler(df.where(fit_rows) if fit_rows is not None else df, columns, kind, keys)
            return apply_scaler(df, params, columns, kind, keys)
        params = fit_scaler(df.where(fit_rows) if fit_rows is not None else df, columns, kind)
        return apply_scaler(df, params, columns, kind)
    w = Window.partitionBy(*[qcol(k) for k in spec.keys])
    stats = {}
    for name, agg in _stats_exprs(columns, kind).items():
        if fit_rows is not None:
            # re-target the aggregate to the fitting rows only
            c = name.rsplit("__", 1)[0]
            x = F.when(fit_rows, numeric(c))
            stat = name.rsplit("__", 1)[1]
            agg = {"mean": F.avg(x), "std": F.stddev_pop(x), "cnt": F.count(x), "min": F.min(x), "max": F.max(x)}[stat]
        stats[name] = agg.over(w)
    out = df.withColumns(stats)
    return out.withColumns({c: _scaled(c, kind) for c in columns}).drop(*stats.keys())


def sequences(
    df: DataFrame,
    spec: SeriesSpec,
    features,
    target: str,
    length: int = config.SEQUENCE_LENGTH,
    indexed: bool = False,
    flat: bool = True,
) -> DataFrame:
    """Q1/Q2: for row ``t >= length`` the previous ``length`` rows of ``features``
    (time-major) and the target of row ``t``.

    ``flat=True`` gives ``features`` as ``array<double>`` of ``length * len(features)``
    values (time step outer, feature inner); ``flat=False`` keeps
    ``array<struct>``. Series with ``n <= length`` give no rows.
    """
    if not indexed:
        spec, _ = resolve(df, spec)
    base = df if indexed else with_index(df, spec)
    base = expand_halo(base, spec, length, 0)
    w = spec.window().rowsBetween(-length, -1)
    hist = F.collect_list(F.struct(*[numeric(c).alias(f"f{i}") for i, c in enumerate(features)])).over(w)
    out = base.withColumn("_hist", hist)
    out = drop_halo(out, spec)
    out = out.where((F.col(IDX) >= length) & (F.size("_hist") == length))
    if flat:
        seq = F.flatten(F.transform("_hist", lambda s: F.array(*[s[f"f{i}"] for i in range(len(features))])))
    else:
        seq = F.col("_hist")
    out = out.withColumn("features", seq).withColumn("label", numeric(target)).drop("_hist")
    if spec.chunked:
        out = out.drop("_chunk")
    return out


def split_labels(n_samples: Column, position: Column, test_size: float = config.TEST_SIZE,
                 validation_split: float = config.VALIDATION_SPLIT) -> Column:
    """Q3: chronological train / val / test label from a sample's position and the sample count."""
    n_temp = F.ceil(n_samples.cast("double") * F.lit(float(test_size)))
    n_test = F.ceil(n_temp.cast("double") * F.lit(float(validation_split)))
    n_val = n_temp - n_test
    n_train = n_samples - n_temp
    return (
        F.when(position < n_train, F.lit("train"))
        .when(position < n_train + n_val, F.lit("val"))
        .otherwise(F.lit("test"))
    )


def split_sizes(n_samples: Column, test_size: float = config.TEST_SIZE, validation_split: float = config.VALIDATION_SPLIT):
    n_temp = F.ceil(n_samples.cast("double") * F.lit(float(test_size)))
    n_test = F.ceil(n_temp.cast("double") * F.lit(float(validation_split)))
    return n_samples - n_temp, n_temp - n_test, n_test


def chrono_split(df: DataFrame, length: int = 0, test_size: float = config.TEST_SIZE,
                 validation_split: float = config.VALIDATION_SPLIT) -> DataFrame:
    """Add ``split`` and ``usable`` to an indexed frame of samples.

    The sample position is ``_idx - length`` and the sample count ``_n - length``;
    series with fewer than 4 samples would leave a split empty and are marked
    ``usable = false`` (the reference skips them with an error).
    """
    n_s = F.col(N) - F.lit(length)
    pos = F.col(IDX) - F.lit(length)
    return df.withColumns({"split": split_labels(n_s, pos, test_size, validation_split), "usable": n_s >= 4})


def scaled_series(
    df: DataFrame, spec: SeriesSpec, features, target: str, length: int = config.SEQUENCE_LENGTH, scaler: str = "standard", fit_on: str = "all",
    test_size: float = config.TEST_SIZE, validation_split: float = config.VALIDATION_SPLIT, indexed: bool = False,
) -> DataFrame:
    """The first half of :func:`preprocess`, for a resolved spec: rows with their features
    scaled, the raw target as ``_target``, ``_idx`` and ``_n``."""
    base = df if indexed else with_index(df, spec)
    fit_rows = None
    if fit_on == "train":
        n_train, _, _ = split_sizes(F.col(N) - F.lit(length), test_size, validation_split)
        fit_rows = F.col(IDX) < F.lit(length) + n_train
    elif fit_on != "all":
        raise ValueError("fit_on must be 'all' or 'train'")
    # the target keeps its raw value; only the features are scaled
    return scale_series(base.withColumn("_target", numeric(target)), spec, features, scaler, fit_rows)


def mark_samples(df: DataFrame, spec: SeriesSpec, features, target: str = "_target", length: int = config.SEQUENCE_LENGTH) -> DataFrame:
    """The samples of an indexed frame, without their lag features: ``split``, ``usable`` and
    ``complete`` (all values of the ``length`` rows before and the target are numbers)."""
    finite = lambda c: numeric(c).isNotNull() & (F.abs(numeric(c)) < F.lit(float("inf")))
    whole = reduce(lambda a, b: a & b, [finite(c) for c in features])
    base = expand_halo(df.withColumn("_whole", whole), spec, length, 0)
    before = F.count_if("_whole").over(spec.window().rowsBetween(-length, -1))
    out = drop_halo(base.withColumn("complete", (before == length) & finite(target)), spec)
    out = chrono_split(out.where(F.col(IDX) >= length), length)
    return out.drop("_whole", *(["_chunk"] if spec.chunked else []))


def preprocess(
    df: DataFrame,
    spec: SeriesSpec,
    features,
    target: str,
    length: int = config.SEQUENCE_LENGTH,
    scaler: str = "standard",
    fit_on: str = "all",
    test_size: float = config.TEST_SIZE,
    validation_split: float = config.VALIDATION_SPLIT,
    indexed: bool = False,
    flat: bool = True,
    carry=(),
) -> DataFrame:
    """Q4: select -> scale -> sequences -> split, as one lazy plan.

    ``fit_on="all"`` fits the scaler on every row of the series (reference
    behaviour); ``"train"`` fits it only on rows up to the last training target.
    Output: keys, order, ``features``, ``label``, ``split``, ``usable``.
    """
    if not indexed:
        spec, _ = resolve(df, spec)
    scaled = scaled_series(df, spec, features, target, length, scaler, fit_on, test_size, validation_split, indexed)
    seq = sequences(scaled, spec, features, "_target", length, indexed=True, flat=flat).drop("_target")
    out = chrono_split(seq, length, test_size, validation_split)
    keep = list(dict.fromkeys([*spec.keys, *spec.order, *carry]))
    return out.select(*[qcol(k) for k in keep], IDX, N, "features", "label", "split", "usable")


def flatten_features(df: DataFrame, column: str = "features", out: str = "features_vec") -> DataFrame:
    """Q2: array<double> -> ML vector (for Spark ML estimators)."""
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(out, array_to_vector(F.col(column)))


def union_all(frames) -> DataFrame:
    """Row union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
