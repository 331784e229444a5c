"""Property checks from the survey's test strategy."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.functions import kernels
from tidemark.operators import features as FE
from tidemark.operators import filters as FL
from tidemark.operators.index import SeriesSpec

SPEC = SeriesSpec(keys=("s",), order=("t",), chunk_rows=None)


def _df(spark, series):
    rows = [(sid, i, float(v)) for sid, vals in enumerate(series) for i, v in enumerate(vals)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["s", "t", "v"]), "s long, t long, v double")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(-1e3, 1e3, allow_nan=False), st.integers(1, 30)), min_size=1, max_size=4))
def test_constant_series_are_fixed_points(spark, cases):
    series = [[c] * n for c, n in cases]
    pdf = FL.apply_filters(_df(spark, series), SPEC, ["none", "moving_average", "savitzky_golay", "gaussian", "kalman"],
                           ["v"]).toPandas()
    for name in ["none", "moving_average", "savitzky_golay", "gaussian", "kalman"]:
        np.testing.assert_allclose(pdf[f"v__{name}"], pdf["v"], rtol=1e-9, atol=1e-9, err_msg=name)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-5, 5, allow_nan=False), min_size=4, max_size=4), st.integers(11, 40))
def test_savgol_reproduces_cubics(spark, coef, n):
    t = np.arange(n, dtype=float)
    y = coef[0] + coef[1] * t + coef[2] * t**2 / 10 + coef[3] * t**3 / 100
    pdf = FL.apply_filters(_df(spark, [y]), SPEC, ["savitzky_golay"], ["v"]).toPandas().sort_values("t")
    np.testing.assert_allclose(pdf["v__savitzky_golay"].values, y, rtol=1e-8, atol=1e-7)


def test_gaussian_weights_sum_to_one():
    for sigma in (0.5, 1.0, 2.0, 3.7):
        assert sum(kernels.gaussian_weights(sigma)) == pytest.approx(1.0)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.floats(-1e4, 1e4, allow_nan=False), min_size=2, max_size=20), min_size=1, max_size=4))
def test_standard_scaling_moments(spark, series):
    pdf = FE.scale_series(_df(spark, series), SPEC, ["v"], "standard").toPandas()
    for sid, g in pdf.groupby("s"):
        raw = np.asarray(series[sid])
        if raw.std() > 1e-6 * max(1.0, np.abs(raw).max()):
            assert g["v"].mean() == pytest.approx(0.0, abs=1e-9)
            assert g["v"].std(ddof=0) == pytest.approx(1.0, rel=1e-9)
