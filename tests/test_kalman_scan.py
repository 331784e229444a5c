"""The Kalman filter as one scan: doubling steps, carries between chunks, one shuffle."""

import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark import SeriesSpec
from tidemark.operators import filters as FL
from tidemark.operators import kalman as KM


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0.0, 0.3, 1.0, 1e-200]), st.floats(-5, 5), st.booleans(), st.booleans(), st.sampled_from([np.nan, 2.0])), min_size=1, max_size=40))
def test_scan_equals_the_loop(rows):
    a, b, missing, begins, entries = (np.array(x) for x in zip(*rows))
    z = np.where(missing, np.nan, b + 1.0)
    a, b = np.where(missing, 1.0, a), np.where(missing, 0.0, b)
    begins[0] = True
    starts = np.flatnonzero(begins)
    entering, after = KM.scan_maps(a, b, z, starts, entries[starts])
    x = np.nan
    for i in range(len(a)):
        if begins[i]:
            x = entries[i]
        if np.isnan(x):
            x = z[i]
        assert entering[i] == pytest.approx(x, nan_ok=True, abs=1e-12)
        x = a[i] * x + b[i]
        assert after[i] == pytest.approx(x, nan_ok=True, abs=1e-12)


def _loop(values, q=1e-5, r=0.1):
    """The textbook filter; a missing measurement gives nothing and leaves the state."""
    x, p, out = np.nan, 1.0, []
    for i, v in enumerate(values):
        k = (p + q) / (p + q + r) if i else 0.0
        p = (1 - k) * (p + q) if i else p
        if not np.isnan(v):
            x = v if np.isnan(x) else x + k * (v - x)
        out.append(np.nan if np.isnan(v) else x)
    return np.array(out)


def _rows(spark, n=3000):
    rng = np.random.default_rng(3)
    v = np.cumsum(rng.normal(size=2 * n)) + 20
    v[rng.random(2 * n) < 0.1] = np.nan
    v[:700] = np.nan  # the first series starts within a later chunk
    pdf = pd.DataFrame({"s": np.repeat([0, 1], n), "t": np.tile(np.arange(n), 2), "v": v, "a.b": v * 2})
    return spark.createDataFrame(pdf, "s long, t long, v double, `a.b` double").repartition(7), pdf


@pytest.mark.parametrize("chunk_rows, fold", [(None, 4096), (600, 4096), (64, 5), (64, 2)])
def test_missing_head_small_batches(spark, monkeypatch, chunk_rows, fold):
    """States cross Arrow batches, chunks and levels of carries; the null key is a series."""
    monkeypatch.setattr(KM, "FOLD_ROWS", fold)
    df, pdf = _rows(spark)
    df = df.selectExpr("nullif(s, 1) AS s", "t", "v")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = FL.apply_filters(df, SeriesSpec(keys=("s",), order=("t",), chunk_rows=chunk_rows), ["kalman"], ["v"]).toPandas()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    got["s"] = got["s"].fillna(1).astype(int)
    got = got.sort_values(["s", "t"])
    assert len(got) == len(pdf)
    for s, part in got.groupby("s"):
        raw = pdf[pdf["s"] == s]["v"].values
        np.testing.assert_allclose(part["v__kalman"].values, _loop(raw), rtol=1e-9, atol=1e-9, equal_nan=True)


def test_one_upstream_pass(spark):
    """Long series take the shuffle and sort of the other filters; nothing is grouped by key in Python."""
    df, _ = _rows(spark)
    spec = SeriesSpec(keys=("s",), order=("t",), chunk_rows=None, max_len=3000)
    plan = FL.apply_filters(df, spec, ["moving_average", "kalman"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan and "Join" not in plan


def test_chunked_maps_do_not_run_other_filters(spark, monkeypatch):
    """The maps of chunks come from the indexed rows: no window, no halo, no shuffle of rows."""
    seen = []
    real = KM.written

    def spy(frame, tag, by=None):
        seen.append((tag, frame._jdf.queryExecution().executedPlan().toString()))
        return real(frame, tag, by)

    monkeypatch.setattr(KM, "written", spy)
    df, _ = _rows(spark)
    out = FL.apply_filters(df, SeriesSpec(keys=("s",), order=("t",), chunk_rows=600), ["median", "kalman"], ["v"])
    maps = dict(seen)["kalman-maps"]
    assert "Window" not in maps and "Generate" not in maps and "Exchange hashpartitioning" not in maps
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_column_names_with_dots(spark):
    df, pdf = _rows(spark, 400)
    spec = SeriesSpec(keys=("s",), order=("t",), chunk_rows=64)
    got = FL.apply_filters(df, spec, ["kalman", ("wide", FL.MedianFilter(31))], ["v"]).orderBy("s", "t").toPandas()
    assert got.columns.tolist() == ["s", "t", "v", "a.b", "v__kalman", "v__wide"]
    np.testing.assert_allclose(got["a.b"].values, pdf["a.b"].values)
    np.testing.assert_allclose(got["v__kalman"].values[:400], _loop(pdf["v"].values[:400]), rtol=1e-9, equal_nan=True)
