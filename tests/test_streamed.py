"""Wide windows on streamed rows: equal to the window expressions, whatever the pieces."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import filters as FL
from tidemark.operators import streamed as S
from tidemark.operators.index import SeriesSpec


@pytest.mark.parametrize("chunk", [None, 16])
def test_equal_to_the_window_expressions(spark, monkeypatch, chunk):
    rng = np.random.default_rng(2)
    rows = [(s if s else None, t, None if (s, t % 41) == (2, 7) else float(rng.normal()), f"r{s}-{t}") for s in range(4) for t in range((5, 30, 200, 29)[s])]
    df = spark.createDataFrame(rows, "s int, t int, v double, tag string").repartition(3)
    spec = SeriesSpec(keys=("s",), order=("t",), chunk_rows=chunk)
    filters = [("sg", FL.SavitzkyGolayFilter(29, 3)), ("zero", FL.MedianFilter(27)), ("shrink", FL.MedianFilter(27, "shrink")), ("ma", FL.MovingAverageFilter(5)), "kalman"]

    def values():
        out = FL.apply_filters(df, spec, filters, ["v"])
        cols = ["v__sg", "v__zero", "v__shrink", "v__ma", "v__kalman"]
        got = {r["tag"]: [r[c] for c in cols] for r in out.collect()}
        return {k: [np.nan if x is None else x for x in v] for k, v in got.items()}

    streamed = values()
    monkeypatch.setattr(FL, "WIDE", 1000)
    windows = values()
    assert set(streamed) == set(windows) and len(streamed) == len(rows)
    for tag in windows:
        np.testing.assert_allclose(streamed[tag], windows[tag], rtol=1e-9, atol=1e-9, err_msg=tag)


def test_pieces_give_every_row_once_with_its_context():
    import pyarrow as pa

    batches = [pa.record_batch({"i": list(range(a, min(a + 3, 50)))}) for a in range(0, 50, 3)]
    for reach, rows in ((4, 1), (0, 5), (7, 100), (60, 2)):
        done = []
        for table, first, end in S.pieces(iter(batches), reach, rows):
            i = table["i"].to_pylist()
            done += i[first:end]
            assert i == list(range(i[0], i[-1] + 1)) and (i[0] == 0 or first >= reach) and (i[-1] == 49 or len(i) - end >= reach)
        assert done == list(range(50))


def test_wide_filter_plan_has_no_shifts(spark):
    df = spark.range(10).select(F.lit(1).alias("s"), F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    plan = FL.apply_filter(df, SeriesSpec(keys=("s",), order=("t",), chunk_rows=None), "savitzky_golay", ["v"], window=101)._jdf.queryExecution().executedPlan().toString()
    assert "lag(" not in plan and "MapInArrow" in plan
