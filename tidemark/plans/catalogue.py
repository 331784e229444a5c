"""The query catalogue: one Spark plan per operator, with its SQL oracle.

Every query reads the driver tables at ``sf_dir`` (whole tables, no sampling) and
returns a DataFrame whose column names match the oracle SQL. Doubles are rounded
to 6 decimals on both sides (window sums differ in the last bits).
"""

from __future__ import annotations

from typing import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import metrics as M
from tidemark.functions import rules
from tidemark.operators import evaluate as EV
from tidemark.operators import features as FE
from tidemark.operators import filters as FL
from tidemark.operators import profile as PR
from tidemark.operators import ranking as RK
from tidemark.operators.index import IDX, N, SeriesSpec
from tidemark.plans import oracle as O
from tidemark.sources.tables import events_signal, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

EV_SPEC = SeriesSpec(keys=("user_id",), order=("ts",))
LONG_SPEC = SeriesSpec(keys=(), order=("event_id",), chunk_rows=2048)
CONV_SPEC = SeriesSpec(keys=("conv_id",), order=("turn",))
SEQ_LEN = 10  # sequence length for the catalogue (events series hold 49-86 rows at sf 0.01)


def r6(c):
    return F.round(c, 6)


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def _ev(spark, sf):
    return events_signal(spark, sf)


def _filter_query(filter_name: str, **params):
    def run(spark, sf):
        ev = _ev(spark, sf)
        out = FL.apply_filter(ev, EV_SPEC, filter_name, ["value"], **params)
        return out.select("user_id", "event_id", r6(F.col("value")).alias("value_f"))

    return run


def _filter_sql(expr_or_cte: str, cte: bool = False) -> str:
    if cte:
        return O.with_recursive(O.EV, expr_or_cte[0]) + f"SELECT g AS user_id, id AS event_id, round(f, 6) AS value_f FROM {expr_or_cte[1]}"
    return f"WITH {O.EV}\nSELECT g AS user_id, id AS event_id, round({expr_or_cte}, 6) AS value_f FROM ev"


# ------------------------------------------------------------------ filters F1-F6

query("filter_none", _filter_sql(O.f_none()))(_filter_query("none"))
query("filter_moving_average", _filter_sql(O.f_moving_average()))(_filter_query("moving_average"))
query("filter_moving_average_reference_head", _filter_sql(O.f_moving_average_reference()))(
    _filter_query("moving_average", head="as_reference")
)
query("filter_savgol", _filter_sql(O.f_savgol()))(_filter_query("savitzky_golay"))
query("filter_median", _filter_sql(O.f_median()))(_filter_query("median"))
query("filter_gaussian", _filter_sql((O.gaussian_cte("fg"), "fg"), cte=True))(_filter_query("gaussian"))
query("filter_kalman", _filter_sql((O.kalman_cte("fk"), "fk"), cte=True))(_filter_query("kalman"))


query("filter_savgol_7_2", _filter_sql(O.f_savgol(window=7, polyorder=2)))(_filter_query("savitzky_golay", window=7, polyorder=2))
query("filter_median_shrink", _filter_sql(O.f_median_shrink()))(_filter_query("median", edge="shrink"))
query("filter_gaussian_sigma1", _filter_sql((O.gaussian_cte("fg", sigma=1.0), "fg"), cte=True))(_filter_query("gaussian", sigma=1.0))
query("filter_kalman_q1e-2_r1", _filter_sql((O.kalman_cte("fk", q=1e-2, r=1.0), "fk"), cte=True))(
    _filter_query("kalman", process_variance=1e-2, measurement_variance=1.0)
)

ORD_SPEC = SeriesSpec(keys=("o_custkey",), order=("o_orderdate", "o_orderkey"))


@query(
    "filter_orders_all",
    O.with_recursive(O.ORD, O.filter_ctes()[0])
    + f"SELECT g AS o_custkey, id AS o_orderkey, filter_type, round(f, 4) AS price_f FROM (\n{O.long_union(O.filter_ctes()[1])})",
)
def q_orders(spark, sf):
    """Orders per customer, ordered by date then key (a tie-broken multi-column order)."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    long = FL.filters_long(o, ORD_SPEC, config.FILTERS_TO_COMPARE, ["o_totalprice"])
    # values reach 10^5: 4 decimals (averages of cent prices are exact there, filter noise ~1e-10)
    return long.select("o_custkey", "o_orderkey", "filter_type", F.round(F.col("o_totalprice"), 4).alias("price_f"))


CHUNKED_EV_SPEC = SeriesSpec(keys=("user_id",), order=("ts",), chunk_rows=32)


@query(
    "filter_all_chunked_series",
    O.with_recursive(O.EV, O.filter_ctes()[0])
    + f"SELECT g AS user_id, id AS event_id, filter_type, run_order, round(f, 6) AS value_f FROM (\n{O.long_union(O.filter_ctes()[1])})",
)
def q_all_chunked(spark, sf):
    """Every filter per user with the skew-safe path: range index and 32-row halo chunks."""
    long = FL.filters_long(_ev(spark, sf), CHUNKED_EV_SPEC, config.FILTERS_TO_COMPARE, ["value"], carry=["event_id"])
    return long.select("user_id", "event_id", "filter_type", "run_order", r6(F.col("value")).alias("value_f"))


@query(
    "filter_short_series",
    O.with_recursive(O.CONV, O.gaussian_cte("fg"), O.kalman_cte("fk"),
                     f"w AS (SELECT g, id, {O.f_moving_average()} AS ma, {O.f_savgol()} AS sg, {O.f_median()} AS med FROM ev)")
    + """SELECT w.g AS conv_id, w.id AS turn, round(w.ma, 6) AS ma, round(w.sg, 6) AS sg, round(w.med, 6) AS med,
  round(fg.f, 6) AS gauss, round(fk.f, 6) AS kal
FROM w JOIN fg ON fg.g = w.g AND fg.id = w.id JOIN fk ON fk.g = w.g AND fk.id = w.id""",
)
def q_short_series(spark, sf):
    cv = table(spark, sf, "conversations").select("conv_id", "turn", F.length("text").cast("double").alias("len"))
    wide = FL.apply_filters(cv, CONV_SPEC, ["moving_average", "savitzky_golay", "median", "gaussian", "kalman"], ["len"])
    return wide.select(
        "conv_id",
        "turn",
        r6(F.col("len__moving_average")).alias("ma"),
        r6(F.col("len__savitzky_golay")).alias("sg"),
        r6(F.col("len__median")).alias("med"),
        r6(F.col("len__gaussian")).alias("gauss"),
        r6(F.col("len__kalman")).alias("kal"),
    )


@query(
    "filter_multi_column",
    f"WITH {O.EV}\nSELECT g AS user_id, id AS event_id, round({O.f_savgol('x')}, 6) AS value_f, round({O.f_savgol('k')}, 6) AS k_f FROM ev",
)
def q_multi_column(spark, sf):
    ev = _ev(spark, sf)
    out = FL.apply_filter(ev, EV_SPEC, "savitzky_golay", ["value", "k", "not_a_column"])
    return out.select("user_id", "event_id", r6(F.col("value")).alias("value_f"), r6(F.col("k")).alias("k_f"))


_CTES, _NAMES = O.filter_ctes()


@query(
    "filter_all_long",
    O.with_recursive(O.EV, _CTES)
    + f"SELECT g AS user_id, id AS event_id, filter_type, run_order, round(f, 6) AS value_f FROM (\n{O.long_union(_NAMES)})",
)
def q_all_long(spark, sf):
    long = FL.filters_long(_ev(spark, sf), EV_SPEC, config.FILTERS_TO_COMPARE, ["value"], carry=["event_id"])
    return long.select("user_id", "event_id", "filter_type", "run_order", r6(F.col("value")).alias("value_f"))


@query(
    "filter_overlay",
    O.with_recursive(O.EV, _CTES)
    + f"""SELECT u.g AS user_id, u.id AS event_id, u.filter_type, round(ev.x, 6) AS original, round(u.f, 6) AS value_f
FROM ({O.long_union(_NAMES)}) u JOIN ev ON ev.g = u.g AND ev.id = u.id""",
)
def q_overlay(spark, sf):
    long = FL.filters_long(_ev(spark, sf), EV_SPEC, config.FILTERS_TO_COMPARE, ["value"], carry=["event_id"], include_original=True)
    return long.select(
        "user_id", "event_id", "filter_type", r6(F.col("value__original")).alias("original"), r6(F.col("value")).alias("value_f")
    )


_LCTES, _LNAMES = O.filter_ctes()


@query(
    "filter_long_series",
    O.with_recursive(O.LONG_EV, _LCTES)
    + f"SELECT id AS event_id, filter_type, round(f, 6) AS value_f FROM (\n{O.long_union(_LNAMES)})",
)
def q_long_series(spark, sf):
    """One series of the whole table (no key), halo chunks of 2,048 rows."""
    ev = table(spark, sf, "events").select("event_id", "value")
    long = FL.filters_long(ev, LONG_SPEC, config.FILTERS_TO_COMPARE, ["value"])
    return long.select("event_id", "filter_type", r6(F.col("value")).alias("value_f"))


POOL = O.EV.replace("user_id AS g", "user_id % 6 AS g").replace("PARTITION BY user_id ORDER BY ts", "PARTITION BY user_id % 6 ORDER BY ts, event_id").replace("PARTITION BY user_id)", "PARTITION BY user_id % 6)").replace("ts AS ord", "row_number() OVER (PARTITION BY user_id % 6 ORDER BY ts, event_id) AS ord")


def _pooled_filter(name: str, chunk_rows=None, **params):
    def run(spark, sf):
        ev = table(spark, sf, "events").select((F.col("user_id") % 6).alias("pool"), "ts", "event_id", "value")
        out = FL.apply_filter(ev, SeriesSpec(keys=("pool",), order=("ts", "event_id"), chunk_rows=chunk_rows), name, ["value"], **params)
        return out.select("pool", "event_id", r6(F.col("value")).alias("value_f"))

    return run


# wide windows: six pooled series, whole and in chunks shorter than the window
_WIDE = "SELECT g AS pool, id AS event_id, round({}, 6) AS value_f FROM {}"
query("filter_savgol_101", f"WITH {POOL},\n{O.savgol_cte('fs', 101)}\n" + _WIDE.format("f", "fs"))(_pooled_filter("savitzky_golay", window=101))
query("filter_savgol_101_chunked", SQL["filter_savgol_101"])(_pooled_filter("savitzky_golay", 64, window=101))
query("filter_median_101", f"WITH {POOL}\n" + _WIDE.format(O.f_median(kernel=101), "ev"))(_pooled_filter("median", kernel_size=101))
query("filter_median_101_shrink", f"WITH {POOL}\n" + _WIDE.format(O.f_median_shrink(kernel=101), "ev"))(_pooled_filter("median", 300, kernel_size=101, edge="shrink"))


# ------------------------------------------------------------------ comparison F9/F10


def _compare_sql(metric: str) -> str:
    fx, fk = O.filter_ctes("ev", "x", "x_"), O.filter_ctes("ev", "k", "k_")
    if metric == "mse":
        agg = "avg((o - f) * (o - f))"
    elif metric == "mae":
        agg = "avg(abs(o - f))"
    else:
        agg = "CASE WHEN var_pop(o) > 0 THEN var_pop(f) / var_pop(o) ELSE 0.0 END"
    union = []
    for cols, (ctes, names) in (("x", fx), ("k", fk)):
        label = "value" if cols == "x" else "k"
        for i, (name, cte) in enumerate(names.items()):
            union.append(
                f"SELECT '{name}' AS filter_type, {i} AS run_order, '{label}' AS \"column\", ev.{cols} AS o, c.f AS f FROM {cte} c JOIN ev ON ev.g = c.g AND ev.id = c.id"
            )
    body = "\nUNION ALL\n".join(union)
    return O.with_recursive(O.EV, fx[0], fk[0]) + f"SELECT filter_type, run_order, \"column\", round({agg}, 6) AS {metric} FROM (\n{body}) GROUP BY 1, 2, 3"


def _compare_query(metric: str):
    def run(spark, sf):
        cmp = FL.compare_filter_effects(_ev(spark, sf), EV_SPEC, config.FILTERS_TO_COMPARE, ["value", "k"], metric=metric)
        return cmp.select("filter_type", "run_order", "column", r6(F.col(metric)).alias(metric))

    return run


for _m in ("mse", "mae", "var"):
    query(f"compare_effects_{_m}", _compare_sql(_m))(_compare_query(_m))


@query(
    "compare_effects_pivot",
    f"""SELECT filter_type, run_order, max(CASE WHEN "column" = 'value' THEN mse END) AS value,
  max(CASE WHEN "column" = 'k' THEN mse END) AS k FROM ({_compare_sql("mse")}) GROUP BY 1, 2""",
)
def q_pivot(spark, sf):
    cmp = FL.compare_filter_effects(_ev(spark, sf), EV_SPEC, config.FILTERS_TO_COMPARE, ["value", "k"], metric="mse")
    cmp = cmp.withColumn("mse", r6(F.col("mse")))
    return FL.pivot_comparison(cmp, "mse", ["value", "k"])


@query(
    "compare_effects_by_series",
    O.with_recursive(O.EV, _CTES)
    + f"""SELECT u.g AS user_id, u.filter_type, u.run_order, 'value' AS "column", round(avg((ev.x - u.f) * (ev.x - u.f)), 6) AS mse
FROM ({O.long_union(_NAMES)}) u JOIN ev ON ev.g = u.g AND ev.id = u.id GROUP BY 1, 2, 3""",
)
def q_by_series(spark, sf):
    cmp = FL.compare_filter_effects(_ev(spark, sf), EV_SPEC, config.FILTERS_TO_COMPARE, ["value"], metric="mse", by_series=True)
    return cmp.select("user_id", "filter_type", "run_order", "column", r6(F.col("mse")).alias("mse"))


# ------------------------------------------------------------------ scaling Z1-Z3

_STD = "(PARTITION BY g)"


def _std_sql(col):
    return f"({col} - avg({col}) OVER {_STD}) / CASE WHEN stddev_pop({col}) OVER {_STD} = 0 THEN 1 ELSE stddev_pop({col}) OVER {_STD} END"


def _mm_sql(col):
    return f"({col} - min({col}) OVER {_STD}) / CASE WHEN max({col}) OVER {_STD} = min({col}) OVER {_STD} THEN 1 ELSE max({col}) OVER {_STD} - min({col}) OVER {_STD} END"


@query("scale_standard", f"WITH {O.EV}\nSELECT g AS user_id, id AS event_id, round({_std_sql('x')}, 6) AS value_s, round({_std_sql('k')}, 6) AS k_s FROM ev")
def q_scale_standard(spark, sf):
    out = FE.scale_series(_ev(spark, sf), EV_SPEC, ["value", "k"], "standard")
    return out.select("user_id", "event_id", r6(F.col("value")).alias("value_s"), r6(F.col("k")).alias("k_s"))


@query("scale_minmax", f"WITH {O.EV}\nSELECT g AS user_id, id AS event_id, round({_mm_sql('x')}, 6) AS value_s, round({_mm_sql('k')}, 6) AS k_s FROM ev")
def q_scale_minmax(spark, sf):
    out = FE.scale_series(_ev(spark, sf), EV_SPEC, ["value", "k"], "minmax")
    return out.select("user_id", "event_id", r6(F.col("value")).alias("value_s"), r6(F.col("k")).alias("k_s"))


_TRAIN_END = f"({SEQ_LEN} + (n - {SEQ_LEN}) - CAST(ceil((n - {SEQ_LEN}) * CAST(0.3 AS DOUBLE)) AS BIGINT))"


@query(
    "scale_fit_on_train",
    f"""WITH {O.EV},
fit AS (SELECT g, avg(x) AS m, stddev_pop(x) AS s FROM ev WHERE idx < {_TRAIN_END} GROUP BY g)
SELECT ev.g AS user_id, ev.id AS event_id, round((ev.x - fit.m) / CASE WHEN fit.s = 0 THEN 1 ELSE fit.s END, 6) AS value_s
FROM ev JOIN fit ON fit.g = ev.g""",
)
def q_scale_train(spark, sf):
    from tidemark.operators.index import with_index

    base = with_index(_ev(spark, sf), EV_SPEC)
    n_train, _, _ = FE.split_sizes(F.col(N) - F.lit(SEQ_LEN))
    out = FE.scale_series(base, EV_SPEC, ["value"], "standard", fit_rows=F.col(IDX) < F.lit(SEQ_LEN) + n_train)
    return out.select("user_id", "event_id", r6(F.col("value")).alias("value_s"))


@query(
    "scale_global",
    """SELECT event_id, round((value - m) / CASE WHEN s = 0 THEN 1 ELSE s END, 6) AS value_s
FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events) p""",
)
def q_scale_global(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value")
    params = FE.fit_scaler(ev, ["value"], "standard")
    out = FE.apply_scaler(ev, params, ["value"], "standard")
    return out.select("event_id", r6(F.col("value")).alias("value_s"))


# ------------------------------------------------------------------ sequences and split Q1-Q4

_SEQ_SQL = f"""WITH {O.EV},
s AS (SELECT g, id, idx, n, x AS label,
        list(x) OVER {O.W} ROWS BETWEEN {SEQ_LEN} PRECEDING AND 1 PRECEDING) AS hx,
        list(k) OVER {O.W} ROWS BETWEEN {SEQ_LEN} PRECEDING AND 1 PRECEDING) AS hk
      FROM ev)"""


@query(
    "sequences",
    _SEQ_SQL + f"""
SELECT g AS user_id, id AS event_id, round(label, 6) AS label, CAST(len(hx) AS INTEGER) AS steps,
  round(hx[1], 6) AS first_value, round(hk[1], 6) AS first_k, round(hx[len(hx)], 6) AS last_value
FROM s WHERE idx >= {SEQ_LEN}""",
)
def q_sequences(spark, sf):
    out = FE.sequences(_ev(spark, sf), EV_SPEC, ["value", "k"], "value", SEQ_LEN, flat=False)
    return out.select(
        "user_id", "event_id", r6(F.col("label")).alias("label"), F.size("features").alias("steps"),
        r6(F.col("features")[0]["f0"]).alias("first_value"), r6(F.col("features")[0]["f1"]).alias("first_k"),
        r6(F.element_at("features", -1)["f0"]).alias("last_value"),
    )


@query(
    "sequences_flat",
    _SEQ_SQL + f"""
SELECT g AS user_id, id AS event_id, round(label, 6) AS label, CAST(2 * len(hx) AS INTEGER) AS n_values,
  round(hx[1], 6) AS first_value, round(hk[len(hk)], 6) AS last_value,
  round(list_sum(hx) + list_sum(hk), 6) AS total
FROM s WHERE idx >= {SEQ_LEN}""",
)
def q_sequences_flat(spark, sf):
    out = FE.sequences(_ev(spark, sf), EV_SPEC, ["value", "k"], "value", SEQ_LEN, flat=True)
    return out.select(
        "user_id", "event_id", r6(F.col("label")).alias("label"), F.size("features").alias("n_values"),
        r6(F.col("features")[0]).alias("first_value"), r6(F.element_at("features", -1)).alias("last_value"),
        r6(F.aggregate("features", F.lit(0.0), lambda a, b: a + b)).alias("total"),
    )


_SPLIT = f"""CASE WHEN idx - {SEQ_LEN} < (n - {SEQ_LEN}) - ceil((n - {SEQ_LEN}) * CAST(0.3 AS DOUBLE)) THEN 'train'
  WHEN idx - {SEQ_LEN} < (n - {SEQ_LEN}) - ceil((n - {SEQ_LEN}) * CAST(0.3 AS DOUBLE)) + (ceil((n - {SEQ_LEN}) * CAST(0.3 AS DOUBLE)) - ceil(ceil((n - {SEQ_LEN}) * CAST(0.3 AS DOUBLE)) * CAST(0.5 AS DOUBLE))) THEN 'val'
  ELSE 'test' END"""


@query(
    "chrono_split",
    f"""WITH {O.EV}
SELECT g AS user_id, id AS event_id, {_SPLIT} AS split, idx - {SEQ_LEN} AS sample_pos, n - {SEQ_LEN} AS n_samples
FROM ev WHERE idx >= {SEQ_LEN}""",
)
def q_split(spark, sf):
    from tidemark.operators.index import with_index

    base = with_index(_ev(spark, sf), EV_SPEC).where(F.col(IDX) >= SEQ_LEN)
    out = FE.chrono_split(base, SEQ_LEN)
    return out.select(
        "user_id", "event_id", "split", (F.col(IDX) - SEQ_LEN).alias("sample_pos"), (F.col(N) - SEQ_LEN).alias("n_samples")
    )


@query(
    "preprocess",
    f"""WITH {O.EV},
z AS (SELECT *, {_std_sql('x')} AS zx, {_std_sql('k')} AS zk FROM ev),
s AS (SELECT g, id, idx, n, x AS label,
        list(zx) OVER {O.W} ROWS BETWEEN {SEQ_LEN} PRECEDING AND 1 PRECEDING) AS hx,
        list(zk) OVER {O.W} ROWS BETWEEN {SEQ_LEN} PRECEDING AND 1 PRECEDING) AS hk
      FROM z)
SELECT g AS user_id, id AS event_id, round(label, 6) AS label, {_SPLIT} AS split, n - {SEQ_LEN} >= 4 AS usable,
  round(list_sum(hx) + list_sum(hk), 6) AS feat_sum, round(hx[1], 6) AS feat_first, round(hk[len(hk)], 6) AS feat_last
FROM s WHERE idx >= {SEQ_LEN}""",
)
def q_preprocess(spark, sf):
    out = FE.preprocess(_ev(spark, sf), EV_SPEC, ["value", "k"], "value", SEQ_LEN, carry=["event_id"])
    return out.select(
        "user_id", F.col("event_id"), r6(F.col("label")).alias("label"), "split", "usable",
        r6(F.aggregate("features", F.lit(0.0), lambda a, b: a + b)).alias("feat_sum"),
        r6(F.col("features")[0]).alias("feat_first"), r6(F.element_at("features", -1)).alias("feat_last"),
    )


# ------------------------------------------------------------------ profiling A1-A5, P4-P6


def _summary_sql(tbl: str, cols: list[tuple[str, str, bool]]) -> str:
    parts = []
    for i, (c, t, num) in enumerate(cols):
        isnan = f" OR isnan({c})" if t == "double" else ""
        stats = (
            f"round(avg({c}), 6), round(stddev_samp({c}), 6), round(CAST(min({c}) AS DOUBLE), 6), round(CAST(max({c}) AS DOUBLE), 6)"
            if num
            else "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)"
        )
        parts.append(
            f"SELECT count(*) AS rows, {len(cols)} AS n_columns, {i} AS position, '{c}' AS \"column\", '{t}' AS data_type, "
            f"CAST(sum(CASE WHEN {c} IS NULL{isnan} THEN 1 ELSE 0 END) AS BIGINT) AS missing, {stats} FROM {tbl}"
        )
    inner = "\nUNION ALL\n".join(parts)
    return f"SELECT rows, n_columns, position, \"column\", data_type, missing, mean, std, min, max FROM (\n{inner}) t(rows, n_columns, position, \"column\", data_type, missing, mean, std, min, max)"


_EVENTS_COLS = [("event_id", "bigint", True), ("ts", "timestamp_ntz", False), ("user_id", "bigint", True),
                ("event_type", "string", False), ("value", "double", True), ("props", "string", False)]


@query("data_summary", _summary_sql("events", _EVENTS_COLS))
def q_summary(spark, sf):
    s = PR.data_summary(table(spark, sf, "events"))
    return s.select("rows", "n_columns", "position", "column", "data_type", "missing",
                    *[r6(F.col(c)).alias(c) for c in ("mean", "std", "min", "max")])


_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@query(
    "missing_values",
    "\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NULL"
        + (f" OR isnan({c})" if c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") else "")
        + f" THEN 1 ELSE 0 END) AS BIGINT) AS missing FROM lineitem"
        for i, c in enumerate(_LINEITEM_COLS)
    ),
)
def q_missing(spark, sf):
    return PR.data_summary(table(spark, sf, "lineitem")).select("position", "column", "missing")


def _downcast_sql() -> str:
    cols = [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
            ("p_size", "int"), ("p_retailprice", "double")]
    parts = []
    for i, (c, t) in enumerate(cols):
        if t in ("bigint", "int"):
            w = 8 if t == "bigint" else 4
            tgt = (f"CASE WHEN min({c}) >= 0 THEN (CASE WHEN max({c}) < 256 THEN 'smallint' WHEN max({c}) < 65536 THEN 'int' "
                   f"WHEN max({c}) < 4294967296 THEN 'bigint' ELSE '{t}' END) "
                   f"WHEN min({c}) > -128 AND max({c}) < 128 THEN 'tinyint' WHEN min({c}) > -32768 AND max({c}) < 32768 THEN 'smallint' "
                   f"WHEN min({c}) > -2147483648 AND max({c}) < 2147483648 THEN 'int' ELSE '{t}' END")
            lab = (f"CASE WHEN min({c}) >= 0 THEN (CASE WHEN max({c}) < 256 THEN 'uint8' WHEN max({c}) < 65536 THEN 'uint16' "
                   f"WHEN max({c}) < 4294967296 THEN 'uint32' ELSE '{t}' END) "
                   f"WHEN min({c}) > -128 AND max({c}) < 128 THEN 'int8' WHEN min({c}) > -32768 AND max({c}) < 32768 THEN 'int16' "
                   f"WHEN min({c}) > -2147483648 AND max({c}) < 2147483648 THEN 'int32' ELSE '{t}' END")
            after = f"count(*) * (CASE {tgt} WHEN 'tinyint' THEN 1 WHEN 'smallint' THEN 2 WHEN 'int' THEN 4 ELSE 8 END)"
            parts.append(f"SELECT {i}, '{c}', '{t}', {tgt}, {lab}, CAST(min({c}) AS BIGINT), CAST(max({c}) AS BIGINT), CAST(NULL AS DOUBLE), "
                         f"CAST(count(*) * {w} AS BIGINT), CAST({after} AS BIGINT) FROM part")
        elif t == "double":
            parts.append(f"SELECT {i}, '{c}', 'double', 'float', 'float32', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE), "
                         f"CAST(count(*) * 8 AS BIGINT), CAST(count(*) * 4 AS BIGINT) FROM part")
        else:
            ratio = f"count(DISTINCT {c}) / count(*)"
            parts.append(
                f"SELECT {i}, '{c}', 'string', CASE WHEN {ratio} < 0.5 THEN 'int' ELSE 'string' END, "
                f"CASE WHEN {ratio} < 0.5 THEN 'category' ELSE 'object' END, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), round({ratio}, 6), "
                f"CAST(sum(strlen({c})) AS BIGINT), CAST(CASE WHEN {ratio} < 0.5 THEN count(*) * 4 + ceil(sum(strlen({c})) * ({ratio})) ELSE sum(strlen({c})) END AS BIGINT) FROM part"
            )
    inner = "\nUNION ALL\n".join(parts)
    return (f"SELECT * FROM (\n{inner}) t(position, \"column\", source_type, target_type, numpy_type, min, max, "
            f"distinct_ratio, bytes_before, bytes_after)")


@query("downcast_profile", _downcast_sql())
def q_downcast(spark, sf):
    prof = PR.downcast_profile(table(spark, sf, "part"))
    return prof.withColumn("distinct_ratio", r6(F.col("distinct_ratio")))


@query(
    "size_saving",
    f"""SELECT CAST(sum(bytes_before) AS BIGINT) AS bytes_before, CAST(sum(bytes_after) AS BIGINT) AS bytes_after,
  round((1 - sum(bytes_after) / sum(bytes_before)) * 100, 6) AS saved_pct FROM ({_downcast_sql()})""",
)
def q_size(spark, sf):
    s = PR.size_saving(PR.downcast_profile(table(spark, sf, "part")))
    return s.select("bytes_before", "bytes_after", r6(F.col("saved_pct")).alias("saved_pct"))


@query(
    "category_ratio",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", round(count(DISTINCT {c}) / count(*), 6) AS distinct_ratio FROM customer"
        for c in ("c_mktsegment", "c_name", "c_nationkey")
    ),
)
def q_category(spark, sf):
    r = PR.category_ratio(table(spark, sf, "customer"), ["c_mktsegment", "c_name", "c_nationkey"])
    return r.select("column", r6(F.col("distinct_ratio")).alias("distinct_ratio"))


@query(
    "optimize_types",
    """SELECT CAST(p_partkey AS INTEGER) AS p_partkey,
  CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS p_name,
  CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS p_brand,
  CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS INTEGER) AS p_type,
  CAST(p_size AS SMALLINT) AS p_size, CAST(p_retailprice AS FLOAT) AS p_retailprice FROM part""",
)
def q_optimize(spark, sf):
    return PR.optimize(table(spark, sf, "part"))


@query(
    "chunk_aggregate",
    """SELECT chunk_id, count(*) AS rows, round(sum(value), 6) AS value_sum, min(value) AS value_min, max(value) AS value_max
FROM (SELECT value, CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 1000) AS BIGINT) AS chunk_id FROM events)
GROUP BY chunk_id""",
)
def q_chunks(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value")
    ch = PR.with_chunks(ev, SeriesSpec(keys=(), order=("event_id",), chunk_rows=4096), chunk_size=1000)
    return ch.groupBy("chunk_id").agg(
        F.count(F.lit(1)).alias("rows"), r6(F.sum("value")).alias("value_sum"), F.min("value").alias("value_min"), F.max("value").alias("value_max")
    )


@query("head_rows", "SELECT user_id, event_id, value FROM events ORDER BY user_id, ts LIMIT 10")
def q_head(spark, sf):
    return PR.head(table(spark, sf, "events"), EV_SPEC, 10).select("user_id", "event_id", "value")


# ------------------------------------------------------------------ metrics M1-M18
# y = value, prediction = previous value of the same user (next-step persistence)

_PAIRS = """pairs AS (SELECT event_type, value AS y, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS p,
  lag(value, 2) OVER (PARTITION BY user_id ORDER BY ts) AS p2 FROM events)"""


def lagged(df: DataFrame, spec: SeriesSpec, columns: dict[str, tuple[str, int]]) -> DataFrame:
    """Earlier values ``{output: (column, rows back)}`` per series, by the path that
    splits a hot series into halo chunks."""
    from tidemark.operators.index import drop_halo, expand_halo, resolve, with_index

    spec, _ = resolve(df, spec)
    back = max(k for _, k in columns.values())
    base = expand_halo(with_index(df, spec), spec, back, 0)
    w = spec.window()
    out = drop_halo(base.withColumns({o: F.lag(c, k).over(w) for o, (c, k) in columns.items()}), spec)
    return out.drop(IDX, N, "_chunk")


def _pairs(spark, sf, chunk_rows="auto"):
    ev = table(spark, sf, "events").select("user_id", "ts", "event_type", F.col("value").alias("y"))
    spec = SeriesSpec(keys=("user_id",), order=("ts",), chunk_rows=chunk_rows)
    return lagged(ev, spec, {"p": ("y", 1), "p2": ("y", 2)}).select("event_type", "y", "p", "p2").where(F.col("p").isNotNull())


def _corr_sql(y, p):
    return f"CASE WHEN count(*) < 2 OR var_pop({y}) = 0 OR var_pop({p}) = 0 THEN 'NaN'::DOUBLE ELSE covar_pop({y}, {p}) / (sqrt(var_pop({y})) * sqrt(var_pop({p}))) END"


def _r2_sql(y, p):
    return (f"CASE WHEN count(*) < 2 THEN 'NaN'::DOUBLE WHEN var_pop({y}) * count(*) = 0 THEN (CASE WHEN sum(({y} - {p}) * ({y} - {p})) = 0 THEN 1.0 ELSE 0.0 END) "
            f"ELSE 1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count(*)) END")


def _within_sql(y, p, lim):
    return f"avg(CASE WHEN abs({y} - {p}) / greatest(1e-10, abs({y})) <= {lim} THEN 1.0 ELSE 0.0 END) * 100"


@query(
    "metrics_regression",
    f"""WITH {_PAIRS}
SELECT event_type, count(*) AS sample_count, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg((y - p) * (y - p)), 6) AS mse,
  round(avg(abs(y - p)), 6) AS mae, round({_r2_sql('y', 'p')}, 6) AS r2,
  round(coalesce(avg(CASE WHEN y <> 0 THEN abs(y - p) / greatest(abs(y), 2.220446049250313e-16) END) * 100, 'NaN'::DOUBLE), 6) AS mape,
  round({_corr_sql('y', 'p')}, 6) AS corr, round({_within_sql('y', 'p', 0.05)}, 6) AS samples_within_5percent,
  round({_within_sql('y', 'p', 0.1)}, 6) AS samples_within_10percent
FROM pairs WHERE p IS NOT NULL GROUP BY event_type""",
)
def q_metrics(spark, sf):
    out = EV.evaluate(_pairs(spark, sf), "y", "p", ["event_type"])
    return out.select("event_type", "sample_count", *[r6(F.col(M.column_name(m))).alias(M.column_name(m)) for m in M.SUMMARY_METRICS])


def _pinball(s, y, p):
    d = y - p
    return s + [np.where(d >= 0, 0.9 * d, -0.1 * d).sum(), len(d)]


def _worst(s, y, p):
    return np.maximum(s, np.abs(y - p).max())


@query(
    "custom_metric",
    f"""WITH {_PAIRS}
SELECT event_type, count(*) AS sample_count, round(avg(abs(y - p)), 6) AS mae,
  round(avg(CASE WHEN y >= p THEN 0.9 * (y - p) ELSE 0.1 * (p - y) END), 6) AS pinball_90, round(max(abs(y - p)), 6) AS worst_error
FROM pairs WHERE p IS NOT NULL GROUP BY event_type""",
)
def q_custom_metric(spark, sf):
    """Two metrics of Python functions over states that merge, beside a built-in one."""
    M.register_metric(M.mergeable_metric("pinball_90", lambda: np.zeros(2), _pinball, np.add, lambda s: s[0] / s[1]))
    M.register_metric(M.mergeable_metric("worst_error", lambda: np.zeros(1), _worst, np.maximum, lambda s: s[0]))
    out = EV.evaluate(_pairs(spark, sf), "y", "p", ["event_type"], ("MAE", "pinball_90", "worst_error"))
    return out.select("event_type", "sample_count", *[r6(F.col(c)).alias(c) for c in ("mae", "pinball_90", "worst_error")])


@query(
    "metrics_full",
    f"""WITH {_PAIRS}
SELECT event_type, count(*) AS sample_count,
  round(log10(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) * 100), 6) AS mape_unmasked_log10,
  round({_r2_sql('y', 'p')}, 6) AS r2, round(avg(abs(y - p)), 6) AS mae, round(avg((y - p) * (y - p)), 6) AS mse,
  round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
  round(avg((ln(1 + greatest(y, 0)) - ln(1 + greatest(p, 0))) * (ln(1 + greatest(y, 0)) - ln(1 + greatest(p, 0)))), 6) AS msle,
  round(sqrt(avg((ln(1 + greatest(y, 0)) - ln(1 + greatest(p, 0))) * (ln(1 + greatest(y, 0)) - ln(1 + greatest(p, 0))))), 6) AS rmsle,
  round(coalesce(avg(CASE WHEN y <> 0 THEN abs(y - p) / abs(y) END) * 100, 'Infinity'::DOUBLE), 6) AS relerr,
  round(CASE WHEN count(*) < 2 THEN 0.0 ELSE {_corr_sql('y', 'p')} END, 6) AS corr_or_zero
FROM pairs WHERE p IS NOT NULL GROUP BY event_type""",
)
def q_metrics_full(spark, sf):
    out = EV.evaluate(_pairs(spark, sf), "y", "p", ["event_type"], M.EXTENDED_METRICS)
    cols = [r6(F.log10(F.col("mape_unmasked"))).alias("mape_unmasked_log10")]
    cols += [r6(F.col(M.column_name(m))).alias(M.column_name(m)) for m in M.EXTENDED_METRICS if m != "MAPE_unmasked"]
    return out.select("event_type", "sample_count", *cols)


@query(
    "metrics_zero_targets",
    """SELECT l_returnflag, count(*) AS sample_count, CAST(sum(CASE WHEN l_discount = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_targets,
  round(coalesce(avg(CASE WHEN l_discount <> 0 THEN abs(l_discount - l_tax) / greatest(abs(l_discount), 2.220446049250313e-16) END) * 100, 'NaN'::DOUBLE), 6) AS mape,
  round(coalesce(avg(CASE WHEN l_discount <> 0 THEN abs(l_discount - l_tax) / abs(l_discount) END) * 100, 'Infinity'::DOUBLE), 6) AS relerr,
  round(log10(avg(abs(l_discount - l_tax) / greatest(abs(l_discount), 2.220446049250313e-16)) * 100), 6) AS mape_unmasked_log10
FROM lineitem GROUP BY l_returnflag""",
)
def q_zero_targets(spark, sf):
    li = table(spark, sf, "lineitem")
    y, p = F.col("l_discount"), F.col("l_tax")
    return li.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.sum((y == 0).cast("long")).alias("zero_targets"),
        r6(M.mape_masked(y, p)).alias("mape"),
        r6(M.relative_error(y, p)).alias("relerr"),
        r6(F.log10(M.mape_unmasked(y, p))).alias("mape_unmasked_log10"),
    )


_ERR_SQL = f"""WITH {_PAIRS}
SELECT event_type, round(avg(y - p), 6) AS error_mean, round(stddev_pop(y - p), 6) AS error_std, round(avg(abs(y - p)), 6) AS abs_error_mean,
  round(quantile_cont(abs(y - p), 0.5), 6) AS abs_error_median, round(max(abs(y - p)), 6) AS error_max, round(min(abs(y - p)), 6) AS error_min,
  round(quantile_cont(abs(y - p), 0.25), 6) AS error_q1, round(quantile_cont(abs(y - p), 0.75), 6) AS error_q3,
  round({_within_sql('y', 'p', 0.05)}, 6) AS samples_within_5percent, round({_within_sql('y', 'p', 0.1)}, 6) AS samples_within_10percent,
  count(*) AS sample_count
FROM pairs WHERE p IS NOT NULL GROUP BY event_type"""


@query("error_stats", _ERR_SQL)
def q_error_stats(spark, sf):
    st = EV.error_stats(_pairs(spark, sf), "y", "p", ["event_type"], quantiles="rank")
    return st.select("event_type", *[r6(F.col(c)).alias(c) for c in EV.ERROR_STATS], "sample_count")


@query(
    "error_stats_exact",
    _ERR_SQL,
)
def q_error_stats_exact(spark, sf):
    st = EV.error_stats(_pairs(spark, sf), "y", "p", ["event_type"], quantiles="exact")
    return st.select("event_type", *[r6(F.col(c)).alias(c) for c in EV.ERROR_STATS], "sample_count")


@query(
    "within_pct",
    f"""WITH {_PAIRS}
SELECT event_type, round({_within_sql('y', 'p', 0.05)}, 6) AS ratio_5, round({_within_sql('y', 'p', 0.1)}, 6) AS ratio_10,
  round(avg(CASE WHEN abs(y - p) <= 0.05 * abs(y) THEN 1.0 ELSE 0.0 END) * 100, 6) AS product_5,
  round(avg(CASE WHEN abs(y - p) <= 0.1 * abs(y) THEN 1.0 ELSE 0.0 END) * 100, 6) AS product_10
FROM pairs WHERE p IS NOT NULL GROUP BY event_type""",
)
def q_within(spark, sf):
    pr = _pairs(spark, sf)
    y, p = F.col("y"), F.col("p")
    return pr.groupBy("event_type").agg(
        r6(M.within_ratio(0.05)(y, p)).alias("ratio_5"), r6(M.within_ratio(0.10)(y, p)).alias("ratio_10"),
        r6(M.within_product(0.05)(y, p)).alias("product_5"), r6(M.within_product(0.10)(y, p)).alias("product_10"),
    )


@query(
    "quality_bands",
    f"""WITH {_PAIRS}, m AS (
SELECT event_type, coalesce(avg(CASE WHEN y <> 0 THEN abs(y - p) / greatest(abs(y), 2.220446049250313e-16) END) * 100, 'NaN'::DOUBLE) AS mape,
  {_r2_sql('y', 'p')} AS r2, {_corr_sql('y', 'p')} AS corr FROM pairs WHERE p IS NOT NULL GROUP BY event_type)
SELECT event_type, round(mape, 6) AS mape, CASE WHEN mape < 10 THEN 'good' ELSE 'bad' END AS mape_band,
  round(r2, 6) AS r2, CASE WHEN r2 > 0.9 THEN 'good' WHEN r2 < 0.5 THEN 'bad' ELSE 'ok' END AS r2_band,
  round(corr, 6) AS corr, CASE WHEN corr > 0.9 THEN 'good' WHEN corr < 0.7 THEN 'bad' ELSE 'ok' END AS corr_band FROM m""",
)
def q_bands(spark, sf):
    m = EV.evaluate(_pairs(spark, sf), "y", "p", ["event_type"], ("MAPE", "R2", "Corr"))
    return m.select(
        "event_type", r6(F.col("mape")).alias("mape"), M.quality_band("mape", F.col("mape")).alias("mape_band"),
        r6(F.col("r2")).alias("r2"), M.quality_band("r2", F.col("r2")).alias("r2_band"),
        r6(F.col("corr")).alias("corr"), M.quality_band("corr", F.col("corr")).alias("corr_band"),
    )


@query(
    "evaluation_report",
    f"""WITH e AS ({_ERR_SQL}), {_PAIRS.replace('pairs AS', 'pairs2 AS')},
m AS (SELECT event_type, round(sqrt(avg((y - p) * (y - p))), 6) AS m_rmse, round({_r2_sql('y', 'p')}, 6) AS m_r2,
  round(coalesce(avg(CASE WHEN y <> 0 THEN abs(y - p) / greatest(abs(y), 2.220446049250313e-16) END) * 100, 'NaN'::DOUBLE), 6) AS m_mape
  FROM pairs2 WHERE p IS NOT NULL GROUP BY event_type)
SELECT m.event_type, m.m_rmse, m.m_r2, m.m_mape, e.error_mean AS e_error_mean, e.abs_error_median AS e_abs_error_median,
  e.error_q1 AS e_error_q1, e.error_q3 AS e_error_q3, e.sample_count
FROM m JOIN e ON e.event_type = m.event_type""",
)
def q_report(spark, sf):
    rep = EV.evaluation_report(_pairs(spark, sf), "y", "p", ["event_type"], ("RMSE", "R2", "MAPE"))
    return rep.select(
        "event_type", r6(F.col("metrics.rmse")).alias("m_rmse"), r6(F.col("metrics.r2")).alias("m_r2"),
        r6(F.col("metrics.mape")).alias("m_mape"), r6(F.col("error_stats.error_mean")).alias("e_error_mean"),
        r6(F.col("error_stats.abs_error_median")).alias("e_abs_error_median"), r6(F.col("error_stats.error_q1")).alias("e_error_q1"),
        r6(F.col("error_stats.error_q3")).alias("e_error_q3"), "sample_count",
    )


@query(
    "calculate_metrics",
    f"""WITH {_PAIRS}
SELECT event_type, round(avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) * 100, 6) AS mape, round({_r2_sql('y', 'p')}, 6) AS r2
FROM pairs WHERE p IS NOT NULL GROUP BY event_type""",
)
def q_calc(spark, sf):
    c = EV.calculate_metrics(_pairs(spark, sf), "y", "p", ["event_type"])
    return c.select("event_type", r6(F.col("mape")).alias("mape"), r6(F.col("r2")).alias("r2"))


@query(
    "union_results",
    f"""WITH {_PAIRS}
SELECT 'lag1' AS predictor, event_type, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae
FROM pairs WHERE p IS NOT NULL GROUP BY event_type
UNION ALL
SELECT 'lag2' AS predictor, event_type, round(sqrt(avg((y - p2) * (y - p2))), 6) AS rmse, round(avg(abs(y - p2)), 6) AS mae
FROM pairs WHERE p2 IS NOT NULL GROUP BY event_type""",
)
def q_union(spark, sf):
    pr = _pairs(spark, sf)
    a = EV.evaluate(pr, "y", "p", ["event_type"], ("RMSE", "MAE")).withColumn("predictor", F.lit("lag1"))
    b = EV.evaluate(pr.where(F.col("p2").isNotNull()), "y", "p2", ["event_type"], ("RMSE", "MAE")).withColumn("predictor", F.lit("lag2"))
    u = FE.union_all([a, b])
    return u.select("predictor", "event_type", r6(F.col("rmse")).alias("rmse"), r6(F.col("mae")).alias("mae"))


# ------------------------------------------------------------------ ranking X1/X2


def _filter_rmse_sql(value: str = "sqrt(avg((y - p) * (y - p))) AS rmse") -> str:
    return (
        O.with_recursive(O.EV, _CTES)
        + f"""SELECT filter_type, run_order, {value} FROM (
  SELECT u.filter_type, u.run_order, ev.x AS y, lag(u.f) OVER (PARTITION BY u.filter_type, u.g ORDER BY ev.ord) AS p
  FROM ({O.long_union(_NAMES)}) u JOIN ev ON ev.g = u.g AND ev.id = u.id) WHERE p IS NOT NULL GROUP BY 1, 2"""
    )


def filter_rmse(spark, sf, metrics=("RMSE",)) -> DataFrame:
    """RMSE of predicting the next raw value by the previous filtered value, per filter."""
    long = FL.filters_long(_ev(spark, sf), EV_SPEC, config.FILTERS_TO_COMPARE, ["value"], carry=["event_id"], include_original=True)
    spec = SeriesSpec(keys=("filter_type", "user_id"), order=("ts",))
    pairs = lagged(long, spec, {"p": ("value", 1)}).withColumnRenamed("value__original", "y").where(F.col("p").isNotNull())
    return EV.evaluate(pairs, "y", "p", ["filter_type", "run_order"], metrics).drop("sample_count")


@query(
    "best_filter",
    f"SELECT filter_type, run_order, round(rmse, 6) AS rmse, CAST(1 AS INTEGER) AS rank FROM ({_filter_rmse_sql()}) ORDER BY rmse, run_order LIMIT 1",
)
def q_best(spark, sf):
    b = RK.best(filter_rmse(spark, sf), "rmse")
    return b.select("filter_type", "run_order", r6(F.col("rmse")).alias("rmse"), F.col("rank").cast("int").alias("rank"))


@query(
    "top3_filters",
    f"""SELECT filter_type, run_order, round(rmse, 6) AS rmse, CAST(row_number() OVER (ORDER BY rmse, run_order) AS INTEGER) AS rank
FROM ({_filter_rmse_sql()}) QUALIFY row_number() OVER (ORDER BY rmse, run_order) <= 3""",
)
def q_top3(spark, sf):
    t = RK.top_k(filter_rmse(spark, sf), 3, "rmse")
    return t.select("filter_type", "run_order", r6(F.col("rmse")).alias("rmse"), F.col("rank").cast("int").alias("rank"))


def _ranked_sql(value: str, column: str, most: int) -> str:
    return f"""SELECT filter_type, run_order, round({column}, 6) AS {column}, CAST(row_number() OVER (ORDER BY {column} DESC, run_order) AS INTEGER) AS rank
FROM ({_filter_rmse_sql(value)}) QUALIFY row_number() OVER (ORDER BY {column} DESC, run_order) <= {most}"""


def _ranked(out: DataFrame, column: str) -> DataFrame:
    return out.select("filter_type", "run_order", r6(F.col(column)).alias(column), F.col("rank").cast("int").alias("rank"))


@query("best_by_r2", _ranked_sql(f"{_r2_sql('y', 'p')} AS r2", "r2", 1))
def q_best_r2(spark, sf):
    """X1 by a metric whose larger values are better, under the summary's name for it."""
    return _ranked(RK.best(filter_rmse(spark, sf, ("R2",)), "r2_score"), "r2")


@query("best_by_corr", _ranked_sql(f"{_corr_sql('y', 'p')} AS corr", "corr", 1))
def q_best_corr(spark, sf):
    return _ranked(RK.best(filter_rmse(spark, sf, ("Corr",)), "correlation"), "corr")


@query("top3_by_within", _ranked_sql(f"{_within_sql('y', 'p', 0.1)} AS samples_within_10percent", "samples_within_10percent", 3))
def q_top3_within(spark, sf):
    return _ranked(RK.top_k(filter_rmse(spark, sf, ("samples_within_10percent",)), 3, "samples_within_10percent"), "samples_within_10percent")


# ------------------------------------------------------------------ nulls in keys, labels and predictions
# every seventh user has no id, every fifth label and every third prediction is missing


@query("filter_kalman_null_key", O.with_recursive(O.NULL_EV, O.kalman_cte("fk")) + "SELECT g AS user_id, id AS event_id, round(f, 6) AS value_f FROM fk".replace("g AS user_id", "CASE WHEN g = -1 THEN NULL ELSE g END AS user_id"))
def q_kalman_null_key(spark, sf):
    """All users whose number divides by seven form one series under a null key."""
    return _kalman_null_key(spark, sf, "auto")


def _kalman_null_key(spark, sf, chunk_rows):
    ev = _ev(spark, sf).withColumn("user_id", F.when(F.col("user_id") % 7 != 0, F.col("user_id")))
    spec = SeriesSpec(keys=("user_id",), order=("ts", "event_id"), chunk_rows=chunk_rows)
    out = FL.apply_filter(ev, spec, "kalman", ["value"])
    return out.select("user_id", "event_id", r6(F.col("value")).alias("value_f"))


query("filter_kalman_null_key_chunked", SQL["filter_kalman_null_key"])(lambda spark, sf: _kalman_null_key(spark, sf, 64))

_NULL_PAIRS = """pairs AS (SELECT CASE WHEN event_type <> 'click' THEN event_type END AS event_type, id,
    CASE WHEN id % 5 <> 0 THEN y END AS y, CASE WHEN id % 3 <> 0 THEN p END AS p FROM (
  SELECT event_type, event_id AS id, value AS y, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events) WHERE p IS NOT NULL),
whole AS (SELECT * FROM pairs WHERE y IS NOT NULL AND p IS NOT NULL)"""


def _null_pairs(spark, sf):
    ev = table(spark, sf, "events").select("user_id", "ts", "event_type", "event_id", F.col("value").alias("y"))
    pr = lagged(ev, SeriesSpec(keys=("user_id",), order=("ts",)), {"p": ("y", 1)}).where(F.col("p").isNotNull())
    return pr.select(
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 5 != 0, F.col("y")).alias("y"), F.when(F.col("event_id") % 3 != 0, F.col("p")).alias("p"),
    )


@query(
    "metrics_nulls",
    f"""WITH {_NULL_PAIRS}
SELECT event_type, count(*) AS sample_count, round(avg((y - p) * (y - p)), 6) AS mse, round({_r2_sql('y', 'p')}, 6) AS r2,
  round(avg((ln(1 + greatest(y, 0)) - ln(1 + greatest(p, 0))) * (ln(1 + greatest(y, 0)) - ln(1 + greatest(p, 0)))), 6) AS msle,
  round({_corr_sql('y', 'p')}, 6) AS corr, round({_within_sql('y', 'p', 0.1)}, 6) AS samples_within_10percent
FROM whole GROUP BY event_type""",
)
def q_metrics_nulls(spark, sf):
    """Rows without a label or a prediction count for no metric; a null group is a group."""
    names = ("MSE", "R2", "MSLE", "Corr", "samples_within_10percent")
    out = EV.evaluate(_null_pairs(spark, sf), "y", "p", ["event_type"], names)
    return out.select("event_type", "sample_count", *[r6(F.col(M.column_name(m))).alias(M.column_name(m)) for m in names])


_NULL_ERR_SQL = f"""WITH {_NULL_PAIRS}
SELECT event_type, round(avg(y - p), 6) AS error_mean, round(quantile_cont(abs(y - p), 0.25), 6) AS error_q1,
  round(quantile_cont(abs(y - p), 0.5), 6) AS abs_error_median, round(quantile_cont(abs(y - p), 0.75), 6) AS error_q3, count(*) AS sample_count
FROM whole GROUP BY event_type"""


def _null_errors(quantiles):
    def run(spark, sf):
        st = EV.error_stats(_null_pairs(spark, sf), "y", "p", ["event_type"], quantiles=quantiles)
        return st.select("event_type", *[r6(F.col(c)).alias(c) for c in ("error_mean", "error_q1", "abs_error_median", "error_q3")], "sample_count")

    return run


query("error_stats_null_rows", _NULL_ERR_SQL)(_null_errors("rank"))
query("error_stats_null_rows_exact", _NULL_ERR_SQL)(_null_errors("exact"))


@query(
    "evaluation_report_null_group",
    f"""WITH e AS ({_NULL_ERR_SQL}), {_NULL_PAIRS},
m AS (SELECT event_type, round(sqrt(avg((y - p) * (y - p))), 6) AS m_rmse FROM whole GROUP BY event_type)
SELECT m.event_type, m_rmse, abs_error_median, error_q1, error_q3, sample_count FROM m JOIN e ON m.event_type IS NOT DISTINCT FROM e.event_type""",
)
def q_report_null_group(spark, sf):
    rep = EV.evaluation_report(_null_pairs(spark, sf), "y", "p", ["event_type"], ("RMSE",))
    return rep.select("event_type", r6(F.col("metrics.rmse")).alias("m_rmse"),
                      *[r6(F.col(f"error_stats.{c}")).alias(c) for c in ("abs_error_median", "error_q1", "error_q3")], "sample_count")


@query(
    "quality_bands_constant",
    """SELECT l_returnflag, 'ok' AS corr_band, CASE WHEN r2 > 0.9 THEN 'good' WHEN r2 < 0.5 THEN 'bad' ELSE 'ok' END AS r2_band
FROM (SELECT l_returnflag, 1 - sum((l_quantity - 25) * (l_quantity - 25)) / (var_pop(l_quantity) * count(*)) AS r2 FROM lineitem GROUP BY 1)""",
)
def q_bands_constant(spark, sf):
    """A constant prediction has no correlation (NaN): neither good nor bad."""
    li = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_quantity").cast("double").alias("y"), F.lit(25.0).alias("p"))
    m = EV.evaluate(li, "y", "p", ["l_returnflag"], ("R2", "Corr"))
    return m.select("l_returnflag", M.quality_band("corr", F.col("corr")).alias("corr_band"), M.quality_band("r2", F.col("r2")).alias("r2_band"))


# ------------------------------------------------------------------ failure containment


@query(
    "filters_with_bad_name",
    f"WITH {O.EV},\nu AS (SELECT g, id, 'none' AS filter_type, 0 AS run_order, x AS f FROM ev UNION ALL SELECT g, id, 'median', 1, {O.f_median()} FROM ev)\n"
    "SELECT g AS user_id, id AS event_id, filter_type, run_order, round(f, 6) AS value_f FROM u",
)
def q_bad_name(spark, sf):
    """Unknown filters, named or labelled, do not stop the others."""
    filters = ["none", "no_such_filter", ("narrow", "gauss"), "median"]
    long = FL.filters_long(_ev(spark, sf), EV_SPEC, filters, ["value"], carry=["event_id"])
    return long.select("user_id", "event_id", "filter_type", "run_order", r6(F.col("value")).alias("value_f"))


@query(
    "experiment_skipped",
    f"""SELECT user_id, count(*) AS sample_count, 'too few rows for a train, validation and test part' AS skipped_reason
FROM events GROUP BY user_id HAVING count(*) < {config.SEQUENCE_LENGTH} + 4""",
)
def q_skipped(spark, sf):
    from tidemark.plans.experiment import skipped_series

    return skipped_series(_ev(spark, sf), EV_SPEC)


# ------------------------------------------------------------------ model rules R5/R9


@query(
    "model_choice_pooled",
    """WITH s AS (SELECT user_id % 40 AS pool, user_id % 40 * user_id % 9 AS part, count(*) AS n_train FROM events GROUP BY GROUPING SETS ((1), (1, 2), ()))
SELECT pool, part, n_train, CASE WHEN n_train > 5000 THEN 'linear_regression' WHEN n_train > 1000 THEN 'svr' ELSE 'random_forest' END AS model_type,
  CAST(least(64, pow(2, floor(log2(greatest(16, least(256, floor(n_train / 10))))))) AS INTEGER) AS batch_size FROM s""",
)
def q_model_choice_pooled(spark, sf):
    """R5 and R9 over pools of users from a handful of rows to the whole table."""
    ev = table(spark, sf, "events").select((F.col("user_id") % 40).alias("pool"), (F.col("user_id") % 40 * F.col("user_id") % 9).alias("part"))
    s = ev.groupingSets([["pool"], ["pool", "part"], []], "pool", "part").agg(F.count(F.lit(1)).alias("n_train"))
    return s.select("pool", "part", "n_train", rules.model_choice(F.col("n_train")).alias("model_type"), rules.batch_size(F.col("n_train")).alias("batch_size"))


@query(
    "model_choice",
    f"""WITH {O.EV}, s AS (SELECT g, max(n) - {SEQ_LEN} AS n_samples FROM ev GROUP BY g),
t AS (SELECT g, n_samples, CAST(n_samples - ceil(n_samples * CAST(0.3 AS DOUBLE)) AS BIGINT) AS n_train FROM s)
SELECT g AS user_id, n_samples, n_train,
  CASE WHEN n_train > 5000 THEN 'linear_regression' WHEN n_train > 1000 THEN 'svr' ELSE 'random_forest' END AS model_type,
  CAST(least(64, pow(2, floor(log2(greatest(16, least(256, floor(n_train / 10))))))) AS INTEGER) AS batch_size
FROM t""",
)
def q_model_choice(spark, sf):
    ev = table(spark, sf, "events")
    s = ev.groupBy("user_id").agg((F.count(F.lit(1)) - F.lit(SEQ_LEN)).alias("n_samples"))
    n_train, _, _ = FE.split_sizes(F.col("n_samples"))
    s = s.withColumn("n_train", n_train.cast("long"))
    return s.select("user_id", "n_samples", "n_train", rules.model_choice(F.col("n_train")).alias("model_type"),
                    rules.batch_size(F.col("n_train")).alias("batch_size"))


__all__ = ["QUERIES", "SQL"]


# ------------------------------------------------------------------ regressors R1-R4, experiment X3-X6

EXP_FEATURES = ["value", "k"]


@query(
    "linear_next_step",
    f"""WITH {_PAIRS}
SELECT round(regr_slope(y, p), 6) AS slope, round(regr_intercept(y, p), 6) AS intercept, count(*) AS train_rows
FROM pairs WHERE p IS NOT NULL""",
)
def q_linear(spark, sf):
    from tidemark.operators import models as MD

    pr = _pairs(spark, sf).select(F.array("p").alias("features"), F.col("y").alias("label"))
    model = MD.fit_linear(pr)
    m = model.model
    n = m.summary.numInstances
    return spark.range(1).select(
        r6(F.lit(float(m.coefficients[0]))).alias("slope"), r6(F.lit(float(m.intercept))).alias("intercept"),
        F.lit(int(n)).cast("long").alias("train_rows"),
    )


_LAG_SQL = """WITH w AS (SELECT user_id % 5 AS pool, value AS y, lag(value) OVER s AS p1, lag(value, 2) OVER s AS p2, row_number() OVER s AS r FROM events WINDOW s AS (PARTITION BY user_id ORDER BY ts)),
m AS (SELECT pool, count(*) AS n, avg(y) AS y0, avg(p1) AS a0, avg(p2) AS b0, covar_pop(p1, p1) AS aa, covar_pop(p2, p2) AS bb, covar_pop(p1, p2) AS ab, covar_pop(p1, y) AS ay, covar_pop(p2, y) AS byy
  FROM w WHERE r > 2 GROUP BY pool),
c AS (SELECT *, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS c1, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS c2 FROM m)
SELECT pool, CAST(1 AS INTEGER) AS lags, round(regr_slope(y, p1), 6) AS near, CAST(NULL AS DOUBLE) AS far, round(regr_intercept(y, p1), 6) AS intercept, count(*) AS samples FROM w WHERE r > 1 GROUP BY pool
UNION ALL SELECT pool, 2, round(c1, 6), round(c2, 6), round(y0 - c1 * a0 - c2 * b0, 6), n FROM c"""


@query("linear_lag_moments", _LAG_SQL)
def q_lag_moments(spark, sf):
    """R1 per pool of users, on one lag and on two, from lagged moments (no lag features)."""
    from tidemark.operators.index import resolve, with_index
    from tidemark.operators.lagfit import fit_linear_lags

    ev = _ev(spark, sf).withColumn("pool", F.col("user_id") % 5)
    spec, _ = resolve(ev, EV_SPEC)
    rows = with_index(ev, spec)
    one, two = (fit_linear_lags(rows, spec, ["value"], "value", k, "pool", "all").withColumn("lags", F.lit(k)) for k in (1, 2))
    far = F.when(F.col("lags") == 2, F.element_at("coef", 1))
    return one.unionByName(two).select("pool", "lags", r6(F.element_at("coef", -1)).alias("near"), r6(far).alias("far"), r6(F.col("intercept")).alias("intercept"), F.col("n").alias("samples"))


@query(
    "experiment_with_infinity",
    """WITH e AS (SELECT value AS y, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS p, row_number() OVER (PARTITION BY user_id ORDER BY ts) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events),
t AS (SELECT count(*) AS rows FROM e WHERE r > 1 AND n >= 5 AND r - 2 >= n - 1 - ceil((n - 1) * CAST(0.3 AS DOUBLE)) + (ceil((n - 1) * CAST(0.3 AS DOUBLE)) - ceil(ceil((n - 1) * CAST(0.3 AS DOUBLE)) * CAST(0.5 AS DOUBLE))))
SELECT f AS filter_type, CASE WHEN f = 'broken' THEN 'no samples to train or test on' END AS skipped_reason, CASE WHEN f <> 'broken' THEN rows END AS sample_count
FROM t, (VALUES ('none'), ('broken'), ('median')) v(f)""",
)
def q_experiment_with_infinity(spark, sf):
    """One filter turns every value into infinity; the others run, the reason is kept."""
    from tidemark.plans.experiment import run_experiment

    class Broken(FL.NoFilter):
        def sql(self, x, w):
            return f"{x} + CAST('Infinity' AS DOUBLE)"

    res = run_experiment(_ev(spark, sf), EV_SPEC, ["value"], "value", ["value"], filters=["none", ("broken", Broken()), "median"], length=1)
    reasons = {}
    for name, reason in res.skipped:  # the last one says why there is no model
        reasons[name] = reason
    status = spark.createDataFrame([(n, reasons.get(n)) for n in ("none", "broken", "median")], "filter_type string, skipped_reason string")
    return status.join(res.summary.select("filter_type", "sample_count"), "filter_type", "left")


_CLOCK = ("training_time_s", "inference_time_per_sample_s", "total_inference_time_s", "total_experiment_time_s")


def _experiment(model_type: str, filters=config.FILTERS_TO_COMPARE, **params):
    def run(spark, sf):
        from tidemark.plans.experiment import run_experiment

        res = run_experiment(_ev(spark, sf), EV_SPEC, EXP_FEATURES, "value", EXP_FEATURES, filters=filters,
                             model_type=model_type, model_params=params or None)
        return res.summary.drop(*_CLOCK)

    return run


_SPLIT1 = _SPLIT.replace(f"idx - {SEQ_LEN}", "idx - 1").replace(f"n - {SEQ_LEN}", "n - 1")
_EXP_SQL = (
    O.with_recursive(O.EV, _CTES)
    + f""", u AS (SELECT u.filter_type, u.run_order, ev.g, ev.id, ev.idx, ev.n, ev.x, u.f FROM ({O.long_union(_NAMES)}) u JOIN ev ON ev.g = u.g AND ev.id = u.id),
z AS (SELECT *, (f - avg(f) OVER o) / CASE WHEN stddev_pop(f) OVER o = 0 THEN 1 ELSE stddev_pop(f) OVER o END AS zf FROM u WINDOW o AS (PARTITION BY filter_type, g)),
s AS (SELECT *, lag(zf) OVER (PARTITION BY filter_type, g ORDER BY idx) AS p, {_SPLIT1} AS split FROM z),
fit AS (SELECT filter_type, regr_slope(x, p) AS a, regr_intercept(x, p) AS b FROM s WHERE idx >= 1 AND n - 1 >= 4 AND split = 'train' GROUP BY 1),
t AS (SELECT s.filter_type, s.run_order, s.g, s.id, s.x AS y, a * s.p + b AS pred FROM s JOIN fit USING (filter_type) WHERE s.idx >= 1 AND s.n - 1 >= 4 AND s.split = 'test')
"""
)


def _lag1_experiment(spark, sf, **more):
    from tidemark.plans.experiment import run_experiment

    return run_experiment(_ev(spark, sf), EV_SPEC, ["value"], "value", ["value"], length=1, **more)


@query(
    "experiment_linear_lag1",
    _EXP_SQL + f"""SELECT filter_type, run_order, 'linear_regression' AS model_type, count(*) AS sample_count, round(sqrt(avg((y - pred) * (y - pred))), 6) AS rmse,
  round(avg(abs(y - pred)), 6) AS mae, round({_r2_sql('y', 'pred')}, 6) AS r2_score FROM t GROUP BY 1, 2""",
)
def q_experiment_lag1(spark, sf):
    """X3/X4 with one lag: scale per series, split, fit and score every filter."""
    out = _lag1_experiment(spark, sf, filters=[*config.FILTERS_TO_COMPARE, "no_such_filter"]).summary
    return out.select("filter_type", "run_order", "model_type", "sample_count", *[r6(F.col(c)).alias(c) for c in ("rmse", "mae", "r2_score")])


@query("experiment_predictions_lag1", _EXP_SQL + "SELECT filter_type, round(y, 6) AS label, round(pred, 6) AS prediction FROM t")
def q_experiment_predictions(spark, sf):
    """Every test prediction of the linear experiment."""
    out = _lag1_experiment(spark, sf).predictions
    return out.select("filter_type", r6(F.col("label")).alias("label"), r6(F.col("prediction")).alias("prediction"))


@query("model_round_trip", _EXP_SQL + "SELECT filter_type, round(avg(pred), 6) AS mean_prediction, count(*) AS rows FROM t WHERE filter_type = 'median' GROUP BY 1")
def q_model_round_trip(spark, sf):
    """K3/K4: a model of the experiment is saved, loaded and predicts the test part again."""
    import uuid

    from tidemark.operators import models as MD
    from tidemark.plans.experiment import prepare
    from tidemark.session import checkpoint_dir

    folder = f"{checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex[:12]}"
    _lag1_experiment(spark, sf, filters=["median"], save_dir=folder)
    coefs = MD.load_linear(spark, f"{folder}/median_linear_regression_model")
    pre = prepare(_ev(spark, sf), EV_SPEC, ["value"], "value", ["value"], ["median"], 1)
    out = MD.predict_linear_grouped(pre.where((F.col("split") == "test") & F.col("complete")), coefs, "filter_type")
    return out.groupBy("filter_type").agg(r6(F.avg("prediction")).alias("mean_prediction"), F.count(F.lit(1)).alias("rows"))


@query(
    "source_to_results",
    _EXP_SQL + """SELECT filter_type, 'linear_regression' AS model_type, round(sqrt(avg((y - pred) * (y - pred))), 6) AS rmse, count(*) AS report_rows FROM t GROUP BY 1""",
)
def q_source_to_results(spark, sf):
    """K1/K2: one call from a parquet source to the CSV summary and JSON reports, read back."""
    import uuid

    from tidemark.plans.experiment import run_source
    from tidemark.session import checkpoint_dir

    out = f"{checkpoint_dir(spark).rstrip('/')}/results-{uuid.uuid4().hex[:12]}"
    run_source(spark, "parquet", f"{sf.rstrip('/')}/events.parquet", EV_SPEC, ["value"], "value", ["value"], out, length=1)
    summary = spark.read.option("header", True).option("inferSchema", True).csv(f"{out}/summary")
    reports = spark.read.json(f"{out}/reports").select("filter_type", F.col("sample_count").alias("report_rows"))
    return summary.select("filter_type", "model_type", r6(F.col("rmse").cast("double")).alias("rmse")).join(reports, "filter_type")


@query(
    "forest_stump",
    """WITH v AS (SELECT l_quantity AS q, count(*) AS n, sum(l_extendedprice) AS s, sum(l_extendedprice * l_extendedprice) AS s2 FROM lineitem GROUP BY 1),
c AS (SELECT q, sum(n) OVER l AS nl, sum(s) OVER l AS sl, sum(s2) OVER l AS s2l, sum(n) OVER () AS n, sum(s) OVER () AS s, sum(s2) OVER () AS s2 FROM v WINDOW l AS (ORDER BY q)),
best AS (SELECT q AS cut, sl / nl AS low, (s - sl) / (n - nl) AS high FROM c WHERE nl < n
  ORDER BY (s2l - sl * sl / nl) + ((s2 - s2l) - (s - sl) * (s - sl) / (n - nl)) LIMIT 1)
SELECT q AS l_quantity, round(CASE WHEN q <= cut THEN low ELSE high END, 4) AS prediction, n AS rows FROM v, best""",
)
def q_forest_stump(spark, sf):
    """R2: one tree of depth one over all rows is the split with the least squared error."""
    from tidemark.operators import models as MD

    li = table(spark, sf, "lineitem").select(F.array(F.col("l_quantity").cast("double")).alias("features"), F.col("l_extendedprice").cast("double").alias("label"))
    out = MD.fit_forest(li, n_estimators=1, max_depth=1, max_bins=64, bootstrap=False).transform(li)
    rows = out.groupBy(F.col("features")[0].alias("l_quantity")).agg(F.max("prediction").alias("prediction"), F.count(F.lit(1)).alias("rows"))
    return rows.select("l_quantity", F.round("prediction", 4).alias("prediction"), "rows")


@query(
    "training_controls",
    """WITH RECURSIVE l AS (SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts) AS INTEGER) AS epoch, value AS loss FROM events),
s(user_id, epoch, loss, lr, best, best_epoch, flat, lr_best, lr_flat, stopped) AS (
  SELECT DISTINCT user_id, 0, CAST(NULL AS DOUBLE), CAST(0.01 AS DOUBLE), 'Infinity'::DOUBLE, 0, 0, 'Infinity'::DOUBLE, 0, false FROM l
  UNION ALL SELECT s.user_id, l.epoch, l.loss,
    CASE WHEN l.loss < s.lr_best - 1e-4 OR s.lr_flat + 1 < 5 THEN s.lr WHEN s.lr > 1e-6 THEN greatest(s.lr * 0.5, 1e-6) ELSE s.lr END,
    least(s.best, l.loss), CASE WHEN l.loss < s.best THEN l.epoch ELSE s.best_epoch END, CASE WHEN l.loss < s.best THEN 0 ELSE s.flat + 1 END,
    CASE WHEN l.loss < s.lr_best - 1e-4 THEN l.loss ELSE s.lr_best END, CASE WHEN l.loss < s.lr_best - 1e-4 OR s.lr_flat + 1 >= 5 THEN 0 ELSE s.lr_flat + 1 END,
    l.loss >= s.best AND s.flat + 1 >= 10 AND l.epoch > 1
  FROM s JOIN l ON l.user_id = s.user_id AND l.epoch = s.epoch + 1 WHERE NOT s.stopped)
SELECT user_id, epoch, round(loss, 6) AS loss, round(lr, 9) AS lr, round(best, 6) AS best, best_epoch, stopped FROM s WHERE epoch > 0""",
)
def q_training_controls(spark, sf):
    """Every user's values taken as the losses of a training run, epoch by epoch."""
    from tidemark.operators.training import ControlState, training_controls

    ev = table(spark, sf, "events").select("user_id", "ts", "value")
    out = training_controls(ev, "user_id", "ts", "value", ControlState(lr=0.01))
    return out.select("user_id", "epoch", r6(F.col("loss")).alias("loss"), F.round("lr", 9).alias("lr"), r6(F.col("best")).alias("best"), "best_epoch", "stopped")


_NET = {"a1": 0.02, "a2": -0.03, "b1": -0.5, "b2": 1.25, "v1": 0.75, "v2": -1.5, "c": 10.0}  # 1-2-1 network


@query(
    "mlp_one_step",
    f"""WITH {_PAIRS},
f AS (SELECT event_type, p, y, greatest({_NET['a1']} * p + {_NET['b1']}, 0) AS h1, greatest({_NET['a2']} * p + {_NET['b2']}, 0) AS h2 FROM pairs WHERE p IS NOT NULL),
r AS (SELECT *, {_NET['v1']} * h1 + {_NET['v2']} * h2 + {_NET['c']} - y AS r FROM f),
g AS (SELECT event_type, avg(r * {_NET['v1']} * p * CAST(h1 > 0 AS INT)) AS a1, avg(r * {_NET['v2']} * p * CAST(h2 > 0 AS INT)) AS a2,
  avg(r * {_NET['v1']} * CAST(h1 > 0 AS INT)) AS b1, avg(r * {_NET['v2']} * CAST(h2 > 0 AS INT)) AS b2, avg(r * h1) AS v1, avg(r * h2) AS v2, avg(r) AS c FROM r GROUP BY event_type),
u AS (UNPIVOT g ON a1, a2, b1, b2, v1, v2, c INTO NAME parameter VALUE gradient),
w AS (SELECT * FROM (VALUES {', '.join(f"('{k}', {v})" for k, v in _NET.items())}) t(parameter, start))
SELECT event_type, parameter, round(gradient, 6) AS gradient, round(start - 0.01 * gradient / (abs(gradient) + 1e-8), 6) AS weight FROM u JOIN w USING (parameter)""",
)
def q_mlp_one_step(spark, sf):
    """Gradient and weights of one synchronous step of a 1-2-1 network per event type."""
    import numpy as np

    from tidemark.operators import models as MD
    from tidemark.operators import training as TR

    pr = _pairs(spark, sf).select("event_type", F.array("p").alias("features"), F.col("y").alias("label"))
    rows = TR.dealt(pr, None, "event_type", "features", "label")
    names, start = list(_NET), np.array(list(_NET.values()))
    loss = MD.mlp_loss([(1, 2), (2, 1)])
    types = [r[0] for r in rows.select("g").distinct().collect()]
    out = []
    for g, (grad, n, *_) in TR.gradient_sums(rows, dict.fromkeys(types, start), loss, ~F.col("_val")).items():
        stepped = TR.train_synchronous(rows.where(F.col("g") == g), {g: start}, loss, 0.01, 1, 1)[g].w
        out += [(g, name, float(d / n), float(w)) for name, d, w in zip(names, grad, stepped)]
    frame = spark.createDataFrame(out, "event_type string, parameter string, gradient double, weight double")
    return frame.select("event_type", "parameter", r6(F.col("gradient")).alias("gradient"), r6(F.col("weight")).alias("weight"))


@query(
    "svr_two_points",
    """WITH t AS (SELECT user_id, arg_min(k, ts) AS x1, arg_max(k, ts) AS x2, arg_min(value, ts) AS y1, arg_max(value, ts) AS y2
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) GROUP BY user_id HAVING count(*) > 1),
b AS (SELECT *, exp(-0.001 * (x1 - x2) * (x1 - x2)) AS k12, greatest(abs(y1 - y2) - 0.2, 0) AS room FROM t),
m AS (SELECT *, CASE WHEN room = 0 THEN 0 ELSE least(1.0, CASE WHEN k12 < 1 THEN room / (2 - 2 * k12) ELSE 1.0 END) * sign(y1 - y2) END AS beta FROM b)
SELECT user_id, round((y1 + y2) / 2, 4) AS intercept, round(beta * (1 - k12) + (y1 + y2) / 2, 4) AS first_prediction, round(-beta * (1 - k12) + (y1 + y2) / 2, 4) AS last_prediction FROM m""",
)
def q_svr_two_points(spark, sf):
    """R3 in closed form: a kernel machine per user on the first and the last event."""
    from tidemark.operators.kernel_svr import fit_kernel_svr

    ends = _ev(spark, sf).groupBy("user_id").agg(
        *[f("value", "ts").alias(f"y{i}") for i, f in ((1, F.min_by), (2, F.max_by))], *[f("k", "ts").alias(f"x{i}") for i, f in ((1, F.min_by), (2, F.max_by))], F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    two = ends.select("user_id", F.explode(F.array(*[F.struct(F.array(f"x{i}").alias("features"), F.col(f"y{i}").alias("label"), F.lit(i).alias("end")) for i in (1, 2)])).alias("s"))
    model = fit_kernel_svr(two.select("user_id", "s.*"), "user_id", gamma=0.001, tolerance=1e-7)
    at = ends.join(model, "user_id")
    value = lambda x: F.col("bias") + F.col("beta") * F.coalesce(F.exp(-F.col("gamma") * (F.try_element_at("x", F.lit(1)) - F.col(x)) ** 2), F.lit(0.0))
    sums = lambda x: F.sum(value(x) - F.col("bias")) + F.first("bias")
    return at.groupBy("user_id").agg(F.round(F.first("bias"), 4).alias("intercept"), F.round(sums("x1"), 4).alias("first_prediction"), F.round(sums("x2"), 4).alias("last_prediction"))


@query(
    "svr_optimal",
    f"WITH {_PAIRS} SELECT event_type, count(*) AS rows, true AS optimal FROM pairs WHERE p IS NOT NULL GROUP BY event_type",
)
def q_svr_optimal(spark, sf):
    """Next value from the last two, per event type; no row misses the optimum's conditions."""
    from tidemark.operators.kernel_svr import fit_kernel_svr

    pr = _pairs(spark, sf)
    model = fit_kernel_svr(pr.select("event_type", F.array("p", F.coalesce("p2", "p")).alias("features"), F.col("y").alias("label")), "event_type", max_support=1 << 17)
    worst = model.groupBy("event_type").agg(F.max("violation").alias("v"))
    return pr.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows")).join(worst, "event_type").select("event_type", "rows", (F.col("v") <= 1e-3).alias("optimal"))


query("experiment_linear")(_experiment("linear_regression"))
query("experiment_auto")(_experiment("auto"))
query("forest_next_step")(_experiment("random_forest", ("moving_average",)))
query("svr_next_step")(_experiment("svr", ("moving_average",)))
query("experiment_svr_all")(_experiment("svr"))
query("mlp_next_step")(_experiment("mlp", ("moving_average",)))


@query("training_history")
def q_history(spark, sf):
    from tidemark.plans.experiment import run_experiment

    res = run_experiment(_ev(spark, sf), EV_SPEC, EXP_FEATURES, "value", EXP_FEATURES, filters=("moving_average",),
                         model_type="mlp")
    hist = res.histories.get("moving_average", [])
    return spark.createDataFrame(hist, "epoch int, train_loss double, val_loss double, lr double")


# ------------------------------------------------------------------ streaming


@query("stream_kalman", _filter_sql((O.kalman_cte("fk"), "fk"), cte=True))
def q_stream_kalman(spark, sf):
    from tidemark.streaming.kalman_stream import stream_events_kalman

    out = stream_events_kalman(spark, sf)
    return out.select("user_id", "event_id", r6(F.col("value_f")).alias("value_f"))


# ------------------------------------------------------------------ user-function paths


@query(
    "chunk_user_function",
    """SELECT chunk_id, count(*) AS rows, round(sum(value), 6) AS value_sum, round(max(value) - min(value), 6) AS value_range
FROM (SELECT value, CAST(floor((row_number() OVER (ORDER BY event_id) - 1) / 1000) AS BIGINT) AS chunk_id FROM events)
GROUP BY chunk_id""",
)
def q_chunk_udf(spark, sf):
    """A5 with a user function: a pandas function per block of 1,000 consecutive rows."""
    import pandas as pd

    ev = table(spark, sf, "events").select("event_id", "value")

    def per_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf["value"]
        return pd.DataFrame({"chunk_id": [int(pdf["chunk_id"].iloc[0])], "rows": [len(pdf)],
                             "value_sum": [round(float(v.sum()), 6)], "value_range": [round(float(v.max() - v.min()), 6)]})

    spec = SeriesSpec(keys=(), order=("event_id",), chunk_rows=4096)
    return PR.process_in_chunks(ev, spec, per_chunk, "chunk_id long, rows long, value_sum double, value_range double", 1000)


@query(
    "batched_scoring",
    _SEQ_SQL + f"""
SELECT g AS user_id, id AS event_id, round(list_sum(hx) + list_sum(hk), 6) AS score
FROM s WHERE idx >= {SEQ_LEN}""",
)
def q_batched_scoring(spark, sf):
    """A user scoring function over Arrow batches of lag features (here the feature sum)."""
    from tidemark.operators import models as MD

    seq = FE.sequences(_ev(spark, sf), EV_SPEC, ["value", "k"], "value", SEQ_LEN).select("user_id", "event_id", "features")
    scored = MD.batched_predict(seq, lambda X: X.sum(axis=1, keepdims=True), batch_rows=None, output="score")
    return scored.select("user_id", "event_id", r6(F.col("score")).alias("score"))


# ------------------------------------------------------------------ CSV telemetry source


# A file per series: each task moves its own files into place, not the driver all of them.
_TASKS_COMMIT = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


@query("telemetry_csv_savgol", _filter_sql(O.f_savgol()))
def q_csv(spark, sf):
    """Events written as one CSV file per user in time order, loaded with the
    telemetry loader (series = file, order = file position) and smoothed."""
    import uuid

    from tidemark.session import checkpoint_dir, written
    from tidemark.sources.telemetry import load_telemetry_csv

    folder = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex[:12]}"
    ev = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    (ev.repartition("user_id").sortWithinPartitions("user_id", "ts").select("user_id", "event_id", "value")
       .write.partitionBy("user_id").options(header=True, **_TASKS_COMMIT).csv(folder))
    loaded = written(load_telemetry_csv(spark, folder, recursive=True), "csv-rows")  # the files are opened once
    loaded = loaded.withColumn("user_id", F.regexp_extract("source_file", r"user_id=(-?[0-9]+)", 1).cast("long"))
    loaded = loaded.withColumn("event_id", F.col("event_id").cast("long")).withColumn("value", F.col("value").cast("double"))
    spec = SeriesSpec(keys=("source_file",), order=("row_id",))
    out = FL.apply_filter(loaded, spec, "savitzky_golay", ["value"])
    return out.select("user_id", "event_id", r6(F.col("value")).alias("value_f"))


_NINE_SQL = f"""WITH {O.EV}
SELECT g AS user_id, id AS event_id, idx AS position, event_type, round(x, 6) AS pack_voltage, round(-x, 6) AS charge_current,
  round(k, 6) AS soc, round(CASE WHEN id % 7 <> 0 THEN x END, 6) AS max_cell_voltage, round(k, 6) AS min_cell_voltage,
  round(CASE WHEN id % 3 <> 0 THEN k END, 6) AS max_temperature, round(CASE WHEN id % 5 <> 0 THEN x END, 6) AS min_temperature,
  round(x * 1e-9, 15) AS available_capacity
FROM ev"""


@query("telemetry_csv_nine", _NINE_SQL)
def q_csv_nine(spark, sf):
    """Events as telemetry files with the nine named columns, among them missing-value words,
    empty fields, spaces, exponents and texts that are no numbers, loaded and typed.

    A file holds the series of a task, each in time order; ``telemetry_csv_savgol`` writes a file
    per series."""
    import uuid

    from tidemark.operators.index import with_index
    from tidemark.session import checkpoint_dir, written
    from tidemark.sources import telemetry as TM

    folder = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex[:12]}"
    text = lambda c: F.col(c).cast("string")
    every = lambda n: F.col("event_id") % n == 0
    values = (
        text("event_id"), text("k"), text("value"), (-F.col("value")).cast("string"), F.when(every(7), "NA").otherwise(text("value")),
        F.concat(F.lit("  "), text("k"), F.lit(" ")), F.when(~every(3), text("k")), F.when(every(5), "12,5 V").otherwise(text("value")),
        (F.col("value") * F.lit(1e-9)).cast("string"),
    )
    ev = _ev(spark, sf).repartition("user_id").sortWithinPartitions("user_id", "ts")
    files = ev.select("user_id", *[v.alias(c) for c, v in zip(TM.NUMERIC_COLUMNS, values)], "event_type")
    plain = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    files.write.options(**plain, **_TASKS_COMMIT).csv(folder)
    loaded = written(TM.load_telemetry_csv(spark, folder, bad_values="null", recursive=True), "csv-rows")
    loaded = loaded.withColumn("user_id", F.col("user_id").cast("long"))
    placed = with_index(loaded, SeriesSpec(keys=("source_file", "user_id"), order=("row_id",)))
    short = {c: c.split(" (")[0] for c in TM.NUMERIC_COLUMNS if c not in (TM.TIME_COLUMN, TM.TARGET_COLUMN)}
    return placed.select(
        "user_id", F.col(f"`{TM.TIME_COLUMN}`").cast("long").alias("event_id"), F.col(IDX).cast("long").alias("position"), "event_type",
        *[r6(F.col(f"`{c}`")).alias(n) for c, n in short.items()], F.round(f"`{TM.TARGET_COLUMN}`", 15).alias("available_capacity"),
    )
