"""Exact quantiles by selection against NumPy, in every path."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import evaluate as EV
from tidemark.operators import quantiles as Q

QS = (0.0, 0.25, 0.5, 0.9, 1.0)


@pytest.fixture(scope="module")
def groups():
    rng = np.random.default_rng(8)
    return {
        "wide": np.abs(rng.normal(size=3000) * 10.0 ** rng.integers(-300, 300, 3000)),
        "tied": np.where(rng.random(4000) < 0.9, 1.5, rng.random(4000)),
        "one": np.array([7.25]), "two": np.array([1.0, 2.0]), "same": np.full(50, 3.0), None: rng.random(101), "signed": rng.normal(size=500),
        "close": 1.0 + np.arange(200) * 2.0**-52,
    }


@pytest.mark.parametrize("path", ["sketch", "narrowed", "missed"])
def test_equal_to_numpy(spark, groups, monkeypatch, path):
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("one", None), ("none", None), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    if path != "sketch":  # every bracket is narrowed first
        monkeypatch.setattr(Q, "INSIDE", 60 if path == "narrowed" else 2000)
        monkeypatch.setattr(Q, "ACCURACY", 10)
        monkeypatch.setattr(Q, "BINS", 256)
    if path == "missed":  # a sketch so coarse that ranks escape its brackets
        real = Q.bracket_columns
        monkeypatch.setattr(Q, "bracket_columns", lambda v, qs: {**real(v, qs), "_ends": F.array(*[F.lit(0.1)] * (2 * len(qs)))})
    got = {r["g"]: [r[f"q{i}"] for i in range(len(QS))] for r in Q.exact_quantiles(df, ["g"], "v", QS).collect()}
    assert set(got) == {*groups, "none"} and got["none"] == [None] * len(QS)
    for g, values in groups.items():
        np.testing.assert_allclose(got[g], np.quantile(values, QS), rtol=1e-12, err_msg=str(g))
    if path == "sketch":
        whole = np.concatenate(list(groups.values()))
        np.testing.assert_allclose(list(Q.exact_quantiles(df, [], "v", QS).first()), np.quantile(whole, QS), rtol=1e-12)


def test_hot_value_is_one_row_per_task_and_nothing_is_sorted_by_range(spark):
    df = spark.range(200_000).select(F.lit("g").alias("g"), F.when(F.col("id") % 10 > 0, 1.0).otherwise(F.rand(3)).alias("y"), F.lit(0.0).alias("p")).repartition(8)
    stats = EV.error_stats(df, "y", "p", ["g"])
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    r = stats.first()
    assert (r["abs_error_median"], r["error_q1"], r["error_q3"], r["sample_count"]) == (1.0, 1.0, 1.0, 200_000)
    with pytest.raises(ValueError):
        EV.error_stats(df, "y", "p", ["g"], quantiles="auto")
