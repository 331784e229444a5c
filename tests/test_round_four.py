"""Findings of round three: steps of training as small jobs, forests from one part a core, files of series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import models as MD
from tidemark.operators import training as TR


@pytest.fixture(scope="module")
def curve(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 3))
    y = np.sin(x[:, 0]) + 0.3 * x[:, 1]
    return spark.createDataFrame([(i, f"g{i % 2}", a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))], "i long, grp string, features array<double>, label double")


def test_steps_shuffle_nothing(curve, monkeypatch):
    """a step adds up its partial sums without a shuffle of its own."""
    def refused(*_):
        raise AssertionError("a step plans a query")

    monkeypatch.setattr(TR, "add_up", refused)
    models = MD.fit_mlp_grouped(curve.where("i % 5 > 0"), curve.where("i % 5 = 0"), "grp", hidden=(4,), max_iter=3)
    assert sorted(models) == ["g0", "g1"] and all(len(m.history) == 3 for m in models.values())


def test_history_is_that_of_plain_steps(spark, curve):
    """batches are those of Spark's hash, and the history is that of the steps by hand."""
    rows = TR.dealt(curve.where("i % 5 > 0"), curve.where("i % 5 = 0"), None, "features", "label")
    table = rows.select("x", "y", "_val", F.xxhash64("_place").alias("h"), *[F.pmod(F.xxhash64("_place", F.lit(e)), F.lit(4)).alias(f"b{e}") for e in (1, 2, 3)]).toPandas()
    for e in (1, 2, 3):
        np.testing.assert_array_equal(TR._batch_of(table["h"].to_numpy(), e, 4), table[f"b{e}"])
    loss, start = MD.mlp_loss([(3, 4), (4, 1)]), MD._mlp_start([(3, 4), (4, 1)], 1)
    run = TR.train_synchronous(rows, {0: start}, loss, 0.02, 3, 4)[0]
    x, y, val = np.stack(table["x"]), table["y"].to_numpy(), table["_val"].to_numpy()
    w, adam = start, TR.Adam(np.zeros(len(start)), np.zeros(len(start)))
    for e, *seen in run.history:
        lost = 0.0
        for step in range(4):
            on = ~val & (table[f"b{e}"] == step).to_numpy()
            one, grad = loss(w, x[on], y[on], True)
            w, lost = adam.update(w, grad / on.sum(), 0.02), lost + one
        np.testing.assert_allclose(seen, [lost / (~val).sum(), loss(w, x[val], y[val], False)[0] / val.sum(), 0.02], rtol=1e-9)
    np.testing.assert_allclose(run.w, w, rtol=1e-9, atol=1e-12)


def test_forest_is_fitted_on_a_part_a_core(curve, monkeypatch):
    """statistics of open nodes are summed once a core, however many parts the rows have."""
    from pyspark.ml.regression import RandomForestRegressor

    seen, fit = [], RandomForestRegressor.fit
    monkeypatch.setattr(RandomForestRegressor, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    MD.fit_forest(curve.repartition(40), n_estimators=2, max_depth=2)
    monkeypatch.setattr(MD, "FOREST_PART_ROWS", 20)
    MD.fit_forest(curve.repartition(40), n_estimators=2, max_depth=2)
    assert seen == [curve.sparkSession.sparkContext.defaultParallelism, 30]


def test_many_small_files_are_few_parts(spark, tmp_path):
    """files of series in folders are found by a folder, read in parts by their bytes, in file order."""
    from tidemark.sources.telemetry import load_telemetry_csv

    for i in range(300):
        (tmp_path / f"user_id={i}").mkdir()
        (tmp_path / f"user_id={i}" / "a.csv").write_text("soc,note\n" + "".join(f"{i}.{j},{j}\n" for j in range(3)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a file a part
    try:
        got = load_telemetry_csv(spark, str(tmp_path), recursive=True)
        assert got.columns == ["soc", "note", "source_file", "row_id"] and got.rdd.getNumPartitions() <= 8
        rows = got.orderBy("source_file", "row_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 900 and [r["note"] for r in rows] == ["0", "1", "2"] * 300
    with pytest.raises(FileNotFoundError):
        load_telemetry_csv(spark, str(tmp_path / "none"), recursive=True)


def test_nine_columns_open_each_file_once(spark, tmp_path, monkeypatch):
    """F8: the files are read by one job; length and index come from the typed rows."""
    import tidemark.session as S
    from tidemark.plans.catalogue import QUERIES

    tags, plain = [], S.written
    monkeypatch.setattr(S, "written", lambda df, tag, by=None: tags.append(tag) or plain(df, tag, by))
    rows = [(i, f"2024-01-01 00:00:{i % 60:02d}", i // 20, "click", float(i), '{"k": 1}') for i in range(60)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "events.parquet"))
    out = QUERIES["telemetry_csv_nine"](spark, str(tmp_path)).orderBy("event_id").collect()
    assert tags == ["csv-rows"] and [r["position"] for r in out] == [i % 20 for i in range(60)]
    assert [r["min_temperature"] for r in out] == [None if i % 5 == 0 else float(i) for i in range(60)]
