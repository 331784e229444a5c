import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF01
from tidemark.functions import metrics as M
from tidemark.functions import rules
from tidemark.operators import evaluate as EV
from tidemark.operators import features as FE
from tidemark.operators import profile as PR
from tidemark.operators import ranking as RK
from tidemark.operators.index import IDX, N, SeriesSpec, with_index


def _pairs(spark, ys, ps):
    return spark.createDataFrame(pd.DataFrame({"label": ys, "prediction": ps}), "label double, prediction double")


def test_metric_goldens(spark):
    # percentiles of |e| = 1, 2, 4, 9: q1 1.75, median 3, q3 5.25
    df = _pairs(spark, [1.0, 2.0, 4.0, 9.0], [0.0, 0.0, 0.0, 0.0])
    for method in ("rank", "exact"):
        st = EV.error_stats(df, quantiles=method).first()
        assert st["error_q1"] == pytest.approx(1.75)
        assert st["abs_error_median"] == pytest.approx(3.0)
        assert st["error_q3"] == pytest.approx(5.25)
        assert st["error_std"] == pytest.approx(np.std([1, 2, 4, 9]))


def test_zero_and_constant_targets(spark):
    z = EV.evaluate(_pairs(spark, [0.0, 0.0], [1.0, 2.0]), metrics=("MAPE", "RelErr", "R2")).first()
    assert math.isnan(z["mape"]) and math.isinf(z["relerr"]) and z["r2"] == 0.0
    perfect = EV.evaluate(_pairs(spark, [2.0, 2.0], [2.0, 2.0]), metrics=("R2", "Corr")).first()
    assert perfect["r2"] == 1.0 and math.isnan(perfect["corr"])
    w = EV.evaluate(_pairs(spark, [100.0, 100.0], [104.0, 106.0]), metrics=("samples_within_5percent",)).first()
    assert w["samples_within_5percent"] == 50.0


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = np.linspace(0, 10, 100)
    y, p = 2 * x + 1 + rng.normal(0, 1, 100), 2 * x + 0.8 + rng.normal(0, 0.5, 100)
    r = EV.evaluate(_pairs(spark, y.tolist(), p.tolist()), metrics=M.SUMMARY_METRICS + ("MSLE", "RelErr")).first()
    e = y - p
    assert r["mse"] == pytest.approx(np.mean(e * e))
    assert r["mae"] == pytest.approx(np.mean(np.abs(e)))
    assert r["r2"] == pytest.approx(1 - np.sum(e * e) / np.sum((y - y.mean()) ** 2))
    assert r["corr"] == pytest.approx(np.corrcoef(y, p)[0, 1])
    assert r["mape"] == pytest.approx(np.mean(np.abs(e) / np.abs(y)) * 100)
    assert r["msle"] == pytest.approx(np.mean((np.log1p(np.maximum(y, 0)) - np.log1p(np.maximum(p, 0))) ** 2))


def test_rules():
    assert [rules.batch_size_value(n) for n in (100, 1000, 5000)] == [16, 64, 64]
    assert [rules.model_choice_value(n) for n in (1000, 1001, 5000, 5001)] == [
        "random_forest", "svr", "svr", "linear_regression"]


def test_rules_columns(spark):
    df = spark.createDataFrame([(100,), (1000,), (5000,), (5001,)], "n long")
    out = df.select(rules.batch_size(F.col("n")).alias("b"), rules.model_choice(F.col("n")).alias("m")).collect()
    assert [r["b"] for r in out] == [16, 64, 64, 64]
    assert [r["m"] for r in out] == ["random_forest", "random_forest", "svr", "linear_regression"]


def test_scalers(spark):
    df = spark.createDataFrame([(1, 0, 1.0, 4.0), (1, 1, 3.0, 4.0)], "s long, t long, a double, b double")
    spec = SeriesSpec(keys=("s",), order=("t",))
    st = FE.scale_series(df, spec, ["a", "b"], "standard").orderBy("t").collect()
    assert [r["a"] for r in st] == [-1.0, 1.0] and [r["b"] for r in st] == [0.0, 0.0]
    mm = FE.scale_series(df, spec, ["a", "b"], "minmax").orderBy("t").collect()
    assert [r["a"] for r in mm] == [0.0, 1.0] and [r["b"] for r in mm] == [0.0, 0.0]


def test_sequences_and_split(spark):
    df = spark.createDataFrame([(1, i, float(i + 1)) for i in range(4)], "s long, t long, v double")
    spec = SeriesSpec(keys=("s",), order=("t",))
    seq = FE.sequences(df, spec, ["v"], "v", 2).orderBy("t").collect()
    assert [(list(r["features"]), r["label"]) for r in seq] == [([1.0, 2.0], 3.0), ([2.0, 3.0], 4.0)]
    short = spark.createDataFrame([(1, 0, 1.0), (1, 1, 2.0)], "s long, t long, v double")
    assert FE.sequences(short, spec, ["v"], "v", 2).count() == 0
    for n, exp in ((10, (7, 1, 2)), (101, (70, 15, 16)), (9950, (6965, 1492, 1493))):
        rows = spark.range(n).select(F.lit(1).alias("s"), F.col("id").alias("t"))
        lab = FE.chrono_split(with_index(rows, SeriesSpec(keys=("s",), order=("t",))))
        got = {r["split"]: r["count"] for r in lab.groupBy("split").count().collect()}
        assert (got.get("train"), got.get("val"), got.get("test")) == exp


def test_preprocess_events(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    spec = SeriesSpec(keys=("user_id",), order=("ts",))
    pre = FE.preprocess(ev, spec, ["value"], "value", 10, carry=["event_id"])
    row = pre.where(F.col("usable")).first()
    assert len(row["features"]) == 10
    assert pre.count() == ev.count() - 150 * 10


def test_profile_and_downcast(spark):
    df = spark.createDataFrame([(-128, 0, "a", 1.5), (10, 255, "a", 2.5)], "a int, b int, c string, d double")
    prof = {r["column"]: r for r in PR.downcast_profile(df).collect()}
    assert prof["a"]["target_type"] == "smallint" and prof["a"]["numpy_type"] == "int16"
    assert prof["b"]["numpy_type"] == "uint8" and prof["b"]["target_type"] == "smallint"
    assert prof["c"]["numpy_type"] == "object"  # 1 distinct / 2 rows = 0.5, not < 0.5
    assert prof["d"]["target_type"] == "float"
    opt = PR.optimize(df)
    assert dict(opt.dtypes)["a"] == "smallint" and dict(opt.dtypes)["d"] == "float"
    summ = {r["column"]: r for r in PR.data_summary(df).collect()}
    assert summ["a"]["std"] == pytest.approx(np.std([-128, 10], ddof=1))
    assert summ["c"]["mean"] is None and summ["a"]["missing"] == 0


def test_ranking_ties_and_nan(spark):
    res = spark.createDataFrame(
        [("a", 0, 1.0), ("b", 1, 1.0), ("c", 2, float("nan")), ("d", 3, 0.5)], "filter_type string, run_order int, rmse double")
    assert RK.best(res, "rmse").first()["filter_type"] == "d"
    top = [r["filter_type"] for r in RK.top_k(res, 3, "rmse").orderBy("rank").collect()]
    assert top == ["d", "a", "b"]
    tie = res.where(F.col("filter_type").isin("a", "b"))
    assert RK.best(tie, "rmse").first()["filter_type"] == "a"
    r2 = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 0.9)], "filter_type string, run_order int, r2 double")
    assert RK.best(r2, "R2").first()["filter_type"] == "b"


def test_chunks_user_function(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet").select("event_id", "value")
    spec = SeriesSpec(keys=(), order=("event_id",), chunk_rows=4096)

    def fn(pdf):
        return pd.DataFrame({"chunk_id": [int(pdf["chunk_id"].iloc[0])], "rows": [len(pdf)]})

    out = PR.process_in_chunks(ev, spec, fn, "chunk_id long, rows long", chunk_size=3000).orderBy("chunk_id").collect()
    assert [r["rows"] for r in out] == [3000, 3000, 3000, 1000]


def test_median_shrink_and_params(spark):
    from tests import refimpl  # noqa: F401
    from tidemark.operators import filters as FL

    x = [5.0, 1.0, 4.0, 2.0, 3.0, 9.0]
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate(x)], "s long, t long, v double")
    out = FL.apply_filter(df, SeriesSpec(keys=("s",), order=("t",)), "median", ["v"], edge="shrink").orderBy("t").collect()
    exp = [np.median(x[max(0, i - 2): i + 3]) for i in range(len(x))]
    assert [r["v"] for r in out] == pytest.approx(exp)
    params = {r["filter_type"]: r["params"] for r in FL.filter_params().collect()}
    assert params["savitzky_golay"] == {"window": 11.0, "polyorder": 3.0}
    assert params["gaussian"] == {"sigma": 2.0} and params["none"] == {}


def test_custom_metric_and_guards(spark):
    M.register_metric(M.MetricSpec("max_abs", lambda y, p: F.max(F.abs(y - p))))
    M.register_metric(M.MetricSpec("broken", lambda y, p: 1 / 0))
    df = _pairs(spark, [1.0, 2.0, 3.0], [1.0, 2.5, 1.0])
    r = EV.evaluate(df, metrics=("max_abs", "broken", "RMSE")).first()
    assert r["max_abs"] == 2.0 and math.isnan(r["broken"]) and r["rmse"] > 0
    ins = {r["g"]: r["skipped_reason"] for r in PR.insufficient(
        spark.createDataFrame([("a",), ("a",), ("b",)], "g string"), ["g"], 2).collect()}
    assert ins == {"a": None, "b": "too few rows for a train, validation and test part"}


def test_order_uniqueness_check(spark):
    from tidemark.operators.index import check_unique_order

    df = spark.createDataFrame([(1, 0, 1.0), (1, 0, 2.0)], "s long, t long, v double")
    with pytest.raises(ValueError):
        check_unique_order(df, SeriesSpec(keys=("s",), order=("t",)))
    check_unique_order(df, SeriesSpec(keys=("s",), order=("t", "v")))


def test_chunked_preprocess_equals_plain(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet").select("user_id", "ts", "event_id", "value")
    plain = SeriesSpec(keys=("user_id",), order=("ts",), chunk_rows=None)
    chunked = SeriesSpec(keys=("user_id",), order=("ts",), chunk_rows=16)
    a = FE.preprocess(ev, plain, ["value"], "value", 10, carry=["event_id"]).toPandas().set_index("event_id").sort_index()
    b = FE.preprocess(ev, chunked, ["value"], "value", 10, carry=["event_id"]).toPandas().set_index("event_id").sort_index()
    assert len(a) == len(b) == 8500
    assert (a["split"] == b["split"]).all() and (a["label"] == b["label"]).all()
    np.testing.assert_allclose(np.stack(a["features"]), np.stack(b["features"]), rtol=1e-12, atol=1e-12)


def test_error_stats_rank_on_one_hot_group(spark):
    rng = np.random.default_rng(5)
    y = rng.normal(size=5000)
    p = y + rng.normal(size=5000)
    df = spark.createDataFrame(pd.DataFrame({"g": ["hot"] * 4990 + ["cold"] * 10, "label": y, "prediction": p}))
    st = {r["g"]: r for r in EV.error_stats(df, group=["g"], quantiles="rank").collect()}
    ae = np.abs(y - p)
    for g, sl in (("hot", slice(0, 4990)), ("cold", slice(4990, 5000))):
        q1, med, q3 = np.percentile(ae[sl], [25, 50, 75])
        assert st[g]["error_q1"] == pytest.approx(q1) and st[g]["abs_error_median"] == pytest.approx(med)
        assert st[g]["error_q3"] == pytest.approx(q3)
