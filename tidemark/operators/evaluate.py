"""Grouped evaluation: metrics, error statistics and the nested evaluation report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.operators import quantiles as Q
from tidemark.operators.filters import qcol
from tidemark.operators.mergeable import fold
from tidemark.session import written

ERROR_STATS = (
    "error_mean",
    "error_std",
    "abs_error_mean",
    "abs_error_median",
    "error_max",
    "error_min",
    "error_q1",
    "error_q3",
    "samples_within_5percent",
    "samples_within_10percent",
)


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction", group=(), metrics=M.SUMMARY_METRICS) -> DataFrame:
    """One row per group with one DOUBLE column per metric (single aggregation; a second one for Python metrics,
    a third for mergeable ones, which are NaN where no row has a label and a prediction)."""
    y, p = qcol(label).cast("double"), qcol(prediction).cast("double")
    merged = {M.column_name(m): M.REGISTRY[m].merged for m in metrics if M.REGISTRY[m].merged}
    if merged:
        names = [M.column_name(m) for m in metrics]
        out = evaluate(df, label, prediction, group, [m for m in metrics if not M.REGISTRY[m].merged])
        more = fold(df, y, p, list(group), merged)
        joined = _join_groups(out, more, list(group))
        values = [F.coalesce(F.col(n), M.NAN()).alias(n) if n in merged else F.col(n) for n in names]
        return joined.select(*[qcol(c) for c in group], "sample_count", *values)
    own = [m for m in metrics if not M.REGISTRY[m].python]
    g = df.groupBy(*[qcol(c) for c in group]) if group else df
    out = g.agg(F.count_if(M.present(y, p)).alias("sample_count"), *M.metric_columns(y, p, own))
    if len(own) == len(metrics):
        return out
    # Python metrics aggregate by themselves and meet the others per group
    more = (df.groupBy(*[qcol(c) for c in group]) if group else df.groupBy()).agg(*M.metric_columns(y, p, [m for m in metrics if m not in own]))
    joined = _join_groups(out, more, list(group)) if group else out.join(more)
    return joined.select(*[qcol(c) for c in group], "sample_count", *[F.col(M.column_name(m)) for m in metrics])


QUANTILES = (0.25, 0.5, 0.75)
_QUANTILE_NAMES = ("error_q1", "abs_error_median", "error_q3")


def _join_groups(left: DataFrame, right: DataFrame, group: list[str]) -> DataFrame:
    """Left join of two tables with one row per group; a null group meets itself."""
    names = [f"_g{i}" for i in range(len(group))]
    right = right.select(*[qcol(c).alias(n) for c, n in zip(group, names)], *[qcol(c) for c in right.columns if c not in group])
    same = F.lit(True)
    for c, n in zip(group, names):
        same = same & left[f"`{c}`"].eqNullSafe(F.col(n))
    return left.join(right, same, "left").drop(*names)


def error_stats(df: DataFrame, label="label", prediction="prediction", group=(), quantiles: str = "rank") -> DataFrame:
    """Error distribution per group (population std, linear-interpolated quartiles).

    Rows whose label or prediction is missing do not count; a null group is a group.
    ``quantiles``: ``rank`` (exact by selection, any group size: two passes over the rows, see
    :mod:`.quantiles`), ``exact`` (Spark's percentile: the distinct errors of a group in one
    task's memory) or ``approx``; the first two agree.
    """
    if quantiles not in ("rank", "exact", "approx"):
        raise ValueError("quantiles must be 'rank', 'exact' or 'approx'")
    y, p = qcol(label).cast("double"), qcol(prediction).cast("double")
    e = y - p
    a = F.abs(e)
    aggs = {
        "error_mean": F.avg(e), "error_std": F.stddev_pop(e), "abs_error_mean": F.avg(a), "error_max": F.max(a), "error_min": F.min(a),
        "samples_within_5percent": M.within_ratio(0.05)(y, p), "samples_within_10percent": M.within_ratio(0.10)(y, p), "sample_count": F.count_if(M.present(y, p)),
    }
    if quantiles == "rank":
        aggs |= Q.bracket_columns(a, QUANTILES)
    else:
        pct = F.percentile(a, list(QUANTILES)) if quantiles == "exact" else F.percentile_approx(a, list(QUANTILES), 1_000_000)
        aggs |= {n: pct[i].cast("double") for i, n in enumerate(_QUANTILE_NAMES)}
    g = df.groupBy(*[qcol(c) for c in group]) if group else df
    out = g.agg(*[c.alias(n) for n, c in aggs.items()])
    if quantiles == "rank":
        out = written(out, "error-stats")  # one row per group: read by both passes
        keys = [f"k{i}" for i in range(len(group))]
        named = [qcol(c).alias(k) for c, k in zip(group, keys)]
        found = out.select(*named, "_rows", "_least", "_most", "_ends")
        picked = Q.exact_quantiles(df.select(*named, a.alias("_ae")), keys, "_ae", QUANTILES, found)
        picked = picked.select(*[F.col(k).alias(c) for k, c in zip(keys, group)], *[F.col(f"q{i}").alias(n) for i, n in enumerate(_QUANTILE_NAMES)])
        if group:
            out = _join_groups(out, picked, list(group))
        else:
            out = out.withColumn("_one", F.lit(1)).join(picked.withColumn("_one", F.lit(1)), "_one", "left")
    return out.select(*[qcol(c) for c in group], *ERROR_STATS, "sample_count")


def evaluation_report(df: DataFrame, label="label", prediction="prediction", group=("filter_type",),
                      metrics=M.SUMMARY_METRICS, quantiles: str = "rank") -> DataFrame:
    """Per group ``metrics`` and ``error_stats`` structs plus ``sample_count``."""
    met = evaluate(df, label, prediction, group, metrics).drop("sample_count")
    names = [M.column_name(m) for m in metrics]
    met = met.select(*[qcol(c) for c in group], *[F.col(n).alias(f"_m_{n}") for n in names])
    st = error_stats(df, label, prediction, group, quantiles)
    if group:
        joined = _join_groups(met, st, list(group))
    else:
        joined = met.withColumn("_one", F.lit(1)).join(st.withColumn("_one", F.lit(1)), "_one")
    return joined.select(
        *[qcol(c) for c in group],
        F.struct(*[F.col(f"_m_{n}").alias(n) for n in names]).alias("metrics"),
        F.struct(*[F.col(n) for n in ERROR_STATS]).alias("error_stats"),
        F.col("sample_count"),
    )


def calculate_metrics(df: DataFrame, label="label", prediction="prediction", group=()) -> DataFrame:
    """The (MAPE, R2) pair of the extended evaluator."""
    y, p = qcol(label).cast("double"), qcol(prediction).cast("double")
    g = df.groupBy(*[qcol(c) for c in group]) if group else df
    return g.agg(M.mape_unmasked(y, p).alias("mape"), M.r2(y, p).alias("r2"))
