"""One answer at any size: null keys, rewritten files, extreme variances, partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import refimpl
from tidemark.functions import kernels
from tidemark.operators import features as FE
from tidemark.operators import filters as FL
from tidemark.operators import models as MD
from tidemark.operators.index import SeriesSpec
from tidemark.plans.catalogue import lagged


def series(spark, n, key=None):
    rng = np.random.default_rng(n)
    rows = [(key, i, float(v)) for i, v in enumerate(rng.normal(size=n))] + [(1, i, float(i % 7)) for i in range(30)]
    return spark.createDataFrame(rows, "g int, i long, v double").repartition(5)


@pytest.mark.parametrize("n", [200, 2000])
@pytest.mark.parametrize("chunk", [None, 64])
def test_null_key_is_a_series(spark, n, chunk):
    df = series(spark, n)
    spec = SeriesSpec(keys=("g",), order=("i",), chunk_rows=chunk)
    got = [r["v"] for r in FL.apply_filter(df, spec, "kalman", ["v"]).where("g IS NULL").orderBy("i").collect()]
    raw = [r["v"] for r in df.where("g IS NULL").orderBy("i").collect()]
    np.testing.assert_allclose(got, refimpl.kalman(raw), rtol=1e-9, atol=1e-9)
    scaled = [r["v"] for r in FE.scale_series(df, spec, ["v"]).where("g IS NULL").orderBy("i").collect()]
    np.testing.assert_allclose(scaled, (np.array(raw) - np.mean(raw)) / np.std(raw), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("q,r", [(1e-5, 0.1), (0.0, 0.1), (1e-2, 1.0), (5.0, 0.1), (1e-20, 0.3), (1e-5, 1e-20), (0.0, 1e-20), (1e-3, 0.0), (0.0, 0.0)])
def test_kalman_for_any_variances(spark, q, r):
    rng = np.random.default_rng(8)
    z = rng.normal(size=900).cumsum()
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(z)], "i long, v double")
    for chunk in (None, 128):
        spec = SeriesSpec(keys=("g",), order=("i",), chunk_rows=chunk)
        out = FL.apply_filter(df.withColumn("g", F.lit(1)), spec, "kalman", ["v"], process_variance=q, measurement_variance=r)
        got = [x["v"] for x in out.orderBy("i").collect()]
        x, p, want = z[0], 1.0, [z[0]]
        for v in z[1:]:
            pm = p + q
            k = pm / (pm + r) if r > 0 else 1.0
            x, p = x + k * (v - x), (r * pm / (pm + r) if r > 0 else 0.0)
            want.append(x)
        np.testing.assert_allclose(got, want, rtol=1e-7, atol=1e-9)


def test_closed_form_gain_equals_the_recursion():
    for q, r in [(1e-5, 0.1), (0.0, 0.1), (3.0, 0.2), (1e-12, 1e-3)]:
        p = 1.0
        for i in range(1, 3000):
            pm = p + q
            k = pm / (pm + r)
            p = (1 - k) * pm
            assert kernels.kalman_gain(i, q, r) == pytest.approx(k, rel=1e-8)


def test_file_rewritten_in_place(spark, tmp_path):
    """Lengths are measured on every call: a file that grows is filtered as it is."""
    path = str(tmp_path / "t.parquet")
    spec = SeriesSpec(keys=("g",), order=("i",))
    for n in (50, 3000):
        series(spark, n, key=2).write.mode("overwrite").parquet(path)
        out = FL.apply_filter(spark.read.parquet(path), spec, "kalman", ["v"]).where("g = 2").orderBy("i").collect()
        raw = [r["v"] for r in spark.read.parquet(path).where("g = 2").orderBy("i").collect()]
        np.testing.assert_allclose([r["v"] for r in out], refimpl.kalman(raw), rtol=1e-9, atol=1e-9)


def test_lagged_in_chunks(spark):
    df = series(spark, 500).withColumn("g", F.coalesce("g", F.lit(0)))
    want = sorted(map(str, lagged(df, SeriesSpec(keys=("g",), order=("i",), chunk_rows=None), {"a": ("v", 1), "b": ("v", 3)}).collect()))
    got = sorted(map(str, lagged(df, SeriesSpec(keys=("g",), order=("i",), chunk_rows=32), {"a": ("v", 1), "b": ("v", 3)}).collect()))
    assert got == want


def frame(spark, n, parts):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, 4))
    y = np.sin(x[:, 0]) + 0.3 * x[:, 1]
    return spark.createDataFrame([(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))], "i long, features array<double>, label double").repartition(parts)


def test_training_does_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(MD, "SHARD_ROWS", 100)
    weights = []
    for parts in (1, 8):
        model = MD.fit_mlp(frame(spark, 700, parts), frame(spark, 60, parts), hidden=(8,), max_iter=50)
        weights.append(model.params["w"])
    np.testing.assert_array_equal(*weights)


def test_partials_keep_the_input_partitions(spark):
    """Only the partial sums are dealt anew: the scan side keeps its partitions."""
    df = frame(spark, 400, 8).withColumn("g", F.lit("a"))
    a = MD.fit_linear_grouped(df, "g").first()
    x = np.array([r["features"] for r in df.orderBy("i").collect()])
    y = np.array([r["label"] for r in df.orderBy("i").collect()])
    want = np.linalg.lstsq(np.hstack([x, np.ones((400, 1))]), y, rcond=None)[0]
    np.testing.assert_allclose([*a["coef"], a["intercept"]], want, rtol=1e-8, atol=1e-10)
    missing = df.unionByName(spark.createDataFrame([(-1, [1.0, None, 0.0, 0.0], 3.0, "a"), (-2, [1.0] * 4, None, "a")], "i long, features array<double>, label double, g string"))
    assert MD.fit_linear_grouped(missing, "g").first()["n"] == 400


def test_unknown_metric_and_direction(spark):
    from tidemark.operators import ranking as RK

    df = spark.createDataFrame([("a", 0, 0.2, 5.0), ("b", 1, 0.9, float("nan")), ("c", 2, 0.5, 1.0)], "filter_type string, run_order int, r2_score double, rmse double")
    assert RK.best(df, "R2").first()["filter_type"] == "b" and RK.best(df, "r2_score").first()["filter_type"] == "b"
    assert RK.best(df, "RMSE").first()["filter_type"] == "c"
    for metric in ("nonsense", "correlation"):
        with pytest.raises(ValueError):
            RK.best(df, metric)


def test_python_metric_beside_the_others(spark):
    from tidemark.functions import metrics as M
    from tidemark.operators import evaluate as EV

    M.register_metric(M.python_metric("p90_error", lambda y, p: np.quantile(np.abs(y - p), 0.9)))
    rows = [("a", float(i), float(i % 3)) for i in range(20)] + [(None, 1.0, 2.0), (None, None, 3.0), ("a", 5.0, None)]
    got = {r["g"]: r for r in EV.evaluate(spark.createDataFrame(rows, "g string, label double, prediction double"), group=["g"], metrics=("MAE", "p90_error")).collect()}
    err = [abs(i - i % 3) for i in range(20)]
    assert got["a"]["p90_error"] == pytest.approx(np.quantile(err, 0.9)) and got["a"]["mae"] == pytest.approx(np.mean(err))
    assert got[None]["p90_error"] == 1.0 and got[None]["sample_count"] == 1


def test_repeated_order_values_raise_when_asked(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 1, 3.0)], "g int, i long, v double")
    with pytest.raises(ValueError):
        FL.apply_filter(df, SeriesSpec(keys=("g",), order=("i",), check_order=True), "median", ["v"])
    with pytest.warns(UserWarning, match="nothere"):
        FL.apply_filter(df, SeriesSpec(keys=("g",), order=("i",)), "none", ["v", "nothere"])


def test_experiment_in_chunks_equals_windows(spark):
    from tidemark.plans.experiment import prepare

    df = series(spark, 300, key=2)
    got = []
    for chunk in (None, 64):
        pre = prepare(df, SeriesSpec(keys=("g",), order=("i",), chunk_rows=chunk), ["v"], "v", ["v"], ["none", "median", "kalman"], length=5)
        got.append({(r["filter_type"], r["g"], r["i"]): (r["split"], r["label"], *r["features"]) for r in pre.collect()})
    assert got[0].keys() == got[1].keys() and len(got[0]) == 3 * (295 + 25)
    for k, v in got[0].items():
        assert v[0] == got[1][k][0] and np.allclose(v[1:], got[1][k][1:], rtol=1e-9, atol=1e-9)
