import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests import refimpl
from tests.conftest import SF01
from tidemark.functions import kernels
from tidemark.operators import filters as FL
from tidemark.operators import kalman as KM
from tidemark.operators.index import SeriesSpec

ALL = list(FL.FILTERS)


def _check(pdf, key, order, col="value", tol=1e-9, names=ALL):
    for _, g in pdf.groupby(key) if key else [(None, pdf)]:
        g = g.sort_values(order)
        x = g[col].values
        for name in names:
            exp = refimpl.REF[name](x)
            got = g[f"{col}__{name}"].values.astype(float)
            np.testing.assert_allclose(got, exp, rtol=tol, atol=tol, err_msg=name)


def test_goldens_kernels():
    hat = kernels.savgol_hat(11, 3)
    assert [round(v * 429) for v in hat[5]] == [-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36]
    w = kernels.gaussian_weights(2.0)
    assert len(w) == 17 and abs(w[8] - 0.199474647864745) < 1e-12
    assert kernels.savgol_params(2, 3) == (5, 3)
    assert kernels.savgol_params(3, 4) == (5, 4)
    assert kernels.savgol_params(10, 3) == (11, 3)
    assert kernels.median_kernel(4) == 5


def _frame(spark, rows, keyed=True):
    pdf = pd.DataFrame(rows, columns=["s", "t", "v"])
    return spark.createDataFrame(pdf, "s long, t long, v double")


@pytest.mark.parametrize(
    "name,params,inp,exp",
    [
        ("moving_average", {}, [1, 2, 3, 4, 5, 6, 7], [2, 2.5, 3, 4, 5, 5.5, 6]),
        ("moving_average", {"head": "as_reference"}, [1, 2, 3, 4, 5, 6, 7], [2, 3.75, 3, 4, 5, 5.5, 6]),
        ("moving_average", {}, [1, 2, 3, 4], [1, 2, 3, 4]),
        ("median", {}, [5, 1, 4, 2, 3], [1, 2, 3, 2, 2]),
        ("median", {"kernel_size": 4}, [5, 1, 4, 2, 3], [1, 2, 3, 2, 2]),
        ("kalman", {}, [1, 2], [1, 1.9090917355]),
        ("gaussian", {}, [7, 7, 7], [7, 7, 7]),
    ],
)
def test_goldens(spark, name, params, inp, exp):
    df = _frame(spark, [(1, i, float(v)) for i, v in enumerate(inp)])
    out = FL.apply_filter(df, SeriesSpec(keys=("s",), order=("t",)), name, ["v"], **params).orderBy("t").toPandas()
    np.testing.assert_allclose(out["v"].values, exp, rtol=1e-9, atol=1e-9)


def test_events_all_filters_match_numpy(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    spec = SeriesSpec(keys=("user_id",), order=("ts",))
    pdf = FL.apply_filters(ev, spec, ALL, ["value"]).toPandas()
    assert len(pdf) == ev.count()
    _check(pdf, "user_id", "ts")


def test_short_series_conversations(spark):
    cv = spark.read.parquet(f"{SF01}/conversations.parquet").withColumn("len", F.length("text").cast("double"))
    spec = SeriesSpec(keys=("conv_id",), order=("turn",))
    pdf = FL.apply_filters(cv, spec, ALL, ["len"]).toPandas()
    _check(pdf, "conv_id", "turn", col="len")


def test_chunked_equals_numpy(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    spec = SeriesSpec(keys=("user_id",), order=("ts",), chunk_rows=16)
    pdf = FL.apply_filters(ev, spec, ALL, ["value"]).toPandas()
    assert len(pdf) == 10000
    _check(pdf, "user_id", "ts")


def test_one_long_series_chunked(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    spec = SeriesSpec(keys=(), order=("event_id",), chunk_rows=1024)
    pdf = FL.apply_filters(ev, spec, ALL, ["value"]).toPandas()
    assert len(pdf) == 10000
    _check(pdf, None, "event_id", tol=1e-8)


def test_kalman_super_blocks(spark, monkeypatch):
    monkeypatch.setattr(KM, "FOLD_ROWS", 4)
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    spec = SeriesSpec(keys=(), order=("event_id",), chunk_rows=512)
    pdf = FL.apply_filters(ev, spec, ["kalman"], ["value"]).toPandas()
    _check(pdf, None, "event_id", tol=1e-8, names=["kalman"])


def test_kalman_pandas_cross_check(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    spec = SeriesSpec(keys=("user_id",), order=("ts",))
    a = FL.apply_filters(ev, spec, ["kalman"], ["value"]).select("event_id", "value__kalman").toPandas()
    b = KM.kalman_pandas(ev, spec, "value", "k", 1e-5, 0.1).select("user_id", "ts", "k").join(
        ev.select("user_id", "ts", "event_id"), ["user_id", "ts"]).toPandas()
    m = a.merge(b, on="event_id")
    np.testing.assert_allclose(m["value__kalman"], m["k"], rtol=1e-9, atol=1e-9)


def test_nulls_and_nan(spark):
    rows = [(1, i, v) for i, v in enumerate([1.0, 2.0, None, 4.0, float("nan"), 6.0, 7.0, 8.0, 9.0, 10.0, 11.0, 12.0])]
    df = _frame(spark, rows)
    spec = SeriesSpec(keys=("s",), order=("t",))
    pdf = FL.apply_filters(df, spec, ALL, ["v"]).orderBy("t").toPandas()
    assert pdf["v__moving_average"].isna().sum() >= 2
    # kalman: missing measurements give null and keep the state
    k = pdf["v__kalman"].values
    assert np.isnan(k[2]) and np.isnan(k[4]) and not np.isnan(k[3])


def test_unknown_filter():
    with pytest.raises(ValueError):
        FL.create_filter("bogus")


def test_plan_single_exchange(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    spec = SeriesSpec(keys=("user_id",), order=("ts",), max_len=200)
    wide = FL.apply_filters(ev, spec, ALL, ["value"])
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_auto_chunking_switches_for_hot_series(spark, monkeypatch):
    from tidemark.operators import index as IX

    monkeypatch.setattr(IX, "AUTO_CHUNK_ABOVE", 50)
    monkeypatch.setattr(IX, "AUTO_CHUNK_ROWS", 64)
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    spec = SeriesSpec(keys=("user_id",), order=("ts",))
    resolved, longest = IX.resolve(ev, spec)
    assert resolved.chunked and resolved.rows_per_chunk == 64 and longest == 86
    pdf = FL.apply_filters(ev, spec, ALL, ["value"]).toPandas()
    _check(pdf, "user_id", "ts")


def test_edge_fixtures(spark):
    spec = SeriesSpec(keys=("s",), order=("t",))
    empty = spark.createDataFrame([], "s long, t long, v double")
    assert FL.apply_filters(empty, spec, ALL, ["v"]).count() == 0
    one = _frame(spark, [(1, 0, 5.0)])
    row = FL.apply_filters(one, spec, ALL, ["v"]).first()
    for name in ALL:
        assert row[f"v__{name}"] == pytest.approx(refimpl.REF[name]([5.0])[0]), name
    ints = spark.createDataFrame([(1, i, i * 3) for i in range(12)], "s long, t long, v int")
    pdf = FL.apply_filters(ints, spec, ALL, ["v"]).toPandas().sort_values("t")
    for name in ALL:
        np.testing.assert_allclose(pdf[f"v__{name}"].values, refimpl.REF[name](np.arange(12) * 3.0), rtol=1e-9, atol=1e-9)
    vals = [1e12, 3e11, 1e-9, 2e-9, 5e-10, 7.0, 1e12, 4e-12, 9e8, 1e-3, 2.0, 8e11, 6e-9]
    wide = FL.apply_filters(_frame(spark, [(1, i, v) for i, v in enumerate(vals)]), spec, ALL, ["v"]).toPandas().sort_values("t")
    for name in ALL:
        np.testing.assert_allclose(wide[f"v__{name}"].values, refimpl.REF[name](vals), rtol=1e-7, atol=1e-3)


def test_missing_column_is_skipped(spark):
    df = _frame(spark, [(1, i, float(i)) for i in range(6)])
    out = FL.apply_filter(df, SeriesSpec(keys=("s",), order=("t",)), "median", ["v", "absent"])
    assert out.columns == df.columns and out.count() == 6


def test_kalman_multi_block_plain_mode(spark):
    rng = np.random.default_rng(11)
    rows = [(s, i, float(v)) for s in range(3) for i, v in enumerate(np.cumsum(rng.normal(size=1500)) + 50)]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["s", "t", "v"]), "s long, t long, v double")
    spec = SeriesSpec(keys=("s",), order=("t",), chunk_rows=None)
    pdf = FL.apply_filters(df, spec, ["kalman"], ["v"]).toPandas()
    _check(pdf, "s", "t", col="v", tol=1e-9, names=["kalman"])
