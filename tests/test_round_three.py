"""Hot series outside the experiment, one dictionary for all columns, mergeable metrics, CSV numbers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import metrics as M
from tidemark.operators import evaluate as EV
from tidemark.operators import features as FE
from tidemark.operators import index as IX
from tidemark.operators import mergeable as MG
from tidemark.operators import profile as PR
from tidemark.operators.index import SeriesSpec, with_index
from tidemark.sources.telemetry import load_telemetry_csv


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_series_are_split_in_scalers_and_index(spark, monkeypatch):
    """One key holds half of all rows: the same rows as without the split, and no window by series."""
    df = spark.range(900).select(F.when(F.col("id") < 450, 0).otherwise(F.col("id") % 9 + 1).alias("g"), "id", (F.col("id") * 37 % 101).cast("double").alias("v"))
    spec = SeriesSpec(keys=("g",), order=("id",))

    def run():
        indexed = with_index(df, spec)
        fit = F.col(IX.IDX) < 20
        return [FE.scale_series(df, spec, ["v"], "standard"), FE.scale_series(df, spec, ["v"], "minmax"),
                FE.scale_series(indexed, spec, ["v"], "standard", fit), FE.chrono_split(indexed, 5)]

    whole = run()
    assert all("Window" in plan(d) for d in whole)
    monkeypatch.setattr(IX, "AUTO_CHUNK_ABOVE", 200)
    split = run()
    for a, b in zip(whole, split):
        assert "Window " not in plan(b)
        a, b = (sorted(map(tuple, d.select(*whole[0].columns[:2], *[c for c in a.columns if c not in ("g", "id")]).collect())) for d in (a, b))
        assert len(a) == 900
        assert all(x[:2] == y[:2] and all(p == q or p == pytest.approx(q, abs=1e-12) for p, q in zip(x[2:], y[2:])) for x, y in zip(a, b))


def test_one_dictionary_for_all_columns(spark, tmp_path):
    names = [f"s{i}" for i in range(5)]
    rows = [tuple(None if i % 11 == j else f"v{(i * (j + 3)) % (j + 4)}" for j in range(5)) for i in range(60)]
    spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert plan(PR.column_values(df, names)).count("FileScan") == 1
    assert PR.distinct_counts(df, names) == {n: len({r[j] for r in rows} - {None}) for j, n in enumerate(names)}
    codes = [{v: k for k, v in enumerate(sorted({r[j] for r in rows} - {None}))} for j in range(5)]
    want = sorted((tuple(codes[j].get(v) for j, v in enumerate(r)) for r in rows), key=str)
    assert sorted((tuple(r) for r in PR.optimize(df).collect()), key=str) == want
    assert PR.distinct_counts(df.limit(0), names) == dict.fromkeys(names, 0)
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (None,)], "x double")
    assert PR.distinct_counts(zeros, ["x"]) == {"x": 1}


def pinball(s, y, p):
    d = y - p
    return s + [np.where(d >= 0, 0.9 * d, -0.1 * d).sum(), len(d)]


def broken(s, y, p):
    raise ValueError("no")


def register():
    M.register_metric(M.mergeable_metric("pin", lambda: np.zeros(2), pinball, np.add, lambda s: s[0] / s[1]))
    M.register_metric(M.mergeable_metric("seen", lambda: np.empty(0), lambda s, y, p: np.union1d(s, y), np.union1d, len))
    M.register_metric(M.mergeable_metric("sunk", lambda: np.zeros(1), broken, np.add, lambda s: s[0]))


@pytest.mark.parametrize("held", [1, 4096])
def test_mergeable_metrics(spark, monkeypatch, held):
    """A hot group over many tasks, null and NaN groups, a metric that fails, any partition count."""
    monkeypatch.setattr(MG, "HELD_GROUPS", held)
    register()
    rows = [("hot", 1.0, float(i % 50), float(i % 7)) for i in range(500)]
    rows += [(None, float("nan"), 1.0, 2.0), (None, float("nan"), 3.0, 2.0), ("x", 0.0, 1.0, 1.0), ("x", -0.0, 2.0, 1.0), ("x", None, 5.0, 4.0)]
    rows += [("empty", 1.0, None, 1.0), ("hot", 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "g string, h double, label double, prediction double")
    names = ("MAE", "pin", "sunk", "seen")
    for parts in (1, 8):
        out = EV.evaluate(df.repartition(parts), group=["g", "h"], metrics=names)
        assert out.columns == ["g", "h", "sample_count", "mae", "pin", "sunk", "seen"]
        got = {(r["g"], str(r["h"])): r for r in out.collect()}
        assert len(got) == 5
        hot = got["hot", "1.0"]
        d = np.array([i % 50 - i % 7 for i in range(500)], float)
        assert hot["sample_count"] == 500 and hot["seen"] == 50 and math.isnan(hot["sunk"])
        assert hot["pin"] == pytest.approx(np.where(d >= 0, 0.9 * d, -0.1 * d).mean()) and hot["mae"] == pytest.approx(np.abs(d).mean())
        assert got[None, "nan"]["seen"] == 2 and got["x", "0.0"]["seen"] == 2 and got["x", "None"]["seen"] == 1
        assert math.isnan(got["empty", "1.0"]["pin"]) and got["empty", "1.0"]["sample_count"] == 0
    one = EV.evaluate(df, metrics=("seen", "MAE")).first()
    assert one["seen"] == 50 and one["sample_count"] == 505
    assert math.isnan(EV.evaluate(df.limit(0), metrics=("pin",)).first()["pin"])
    # rows are folded where they lie: no exchange between them and the fold
    steps = plan(MG.fold(df, F.col("label"), F.col("prediction"), ["g"], {"pin": M.REGISTRY["pin"].merged}))
    assert steps.count("MapInArrow") == 3 and steps.rindex("MapInArrow") > steps.rindex("Exchange")


def test_csv_numbers(spark, tmp_path):
    text = "soc,note\n 1.5 ,NA\nNA,x\n,y\n1e-3,z\nNaN,w\n"
    (tmp_path / "a.csv").write_text(text)
    got = load_telemetry_csv(spark, f"{tmp_path}/a.csv").orderBy("row_id").collect()
    assert [r["soc"] for r in got] == [1.5, None, None, 0.001, None] and got[0]["note"] == "NA"
    (tmp_path / "b.csv").write_text(text + "bad,v\n")
    with pytest.raises(Exception, match="not a number in column soc: bad"):
        load_telemetry_csv(spark, f"{tmp_path}/b.csv").collect()
    assert [r["soc"] for r in load_telemetry_csv(spark, f"{tmp_path}/b.csv", bad_values="null").orderBy("row_id").collect()][-1] is None
    with pytest.raises(ValueError):
        load_telemetry_csv(spark, f"{tmp_path}/b.csv", bad_values="skip")
