"""Queries whose files or solvers must not grow faster than the rows."""

import glob

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import kernel_svr as K
from tidemark.operators import lowrank_svr as LR


def test_nine_columns_files_do_not_grow_with_series(spark, tmp_path, monkeypatch):
    """F8: 200 series, one of them without a key, are a file a task; the rows are those of the SQL."""
    from tidemark.plans.catalogue import QUERIES, SQL
    from tidemark.sources import telemetry as TM

    folders, plain = [], TM.load_telemetry_csv
    monkeypatch.setattr(TM, "load_telemetry_csv", lambda spark, path, **kw: folders.append(path) or plain(spark, path, **kw))
    rows = [(i, f"2024-01-01 00:0{i % 5}:00", i // 5 or None, "a,\"b\"", i / 8, '{"k": %d}' % i) for i in range(1000)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "events.parquet"))
    got = QUERIES["telemetry_csv_nine"](spark, str(tmp_path))
    rows = sorted(map(tuple, got.collect()), key=lambda r: r[1])
    files = glob.glob(f"{folders[0].removeprefix('file:')}/**/*.csv", recursive=True)
    assert 1 <= len(files) <= 8 and sum(len(open(f).readlines()) - 1 for f in files) == 1000
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({SQL['telemetry_csv_nine']}) ORDER BY event_id").fetchall()
    assert got.columns[0] == "user_id" and rows[0][0] is None and rows[3][3] == 'a,"b"'
    for a, b in zip(rows, want, strict=True):
        assert a == pytest.approx(b, abs=1e-9)


@pytest.fixture(scope="module")
def curves(spark):
    """Noisy curves of three groups, one without a name; one all within the tube, and repeated samples."""
    rng = np.random.default_rng(3)
    x = rng.exponential(1.0, size=(900, 2))
    y = np.sin(2 * x[:, 0]) + 0.5 * x[:, 1] + 0.4 * rng.normal(size=900)
    rows = [(("a", None, "flat")[i % 3], i, x[i].tolist(), 2.0 if i % 3 == 2 else float(y[i])) for i in range(900)]
    return spark.createDataFrame(rows + rows[:90], "grp string, i int, features array<double>, label double").repartition(5)


def test_low_rank_machine_is_the_optimum(spark, curves, monkeypatch):
    """more supports than a task may hold are no refusal; the optimum is that of the dual."""
    monkeypatch.setattr(K, "LOW_RANK_ABOVE", 200)
    table = K.fit_kernel_svr(curves.drop("i"), "grp", tolerance=1e-4, max_support=100)
    models = K.load_supports(table, "grp")
    assert set(models) == {"a", None, "flat"} and table.agg(F.max("violation")).first()[0] <= 1e-4
    assert len(models["flat"].beta) == 0 and abs(models["flat"].bias - 2.0) <= 0.1 and table.where("grp = 'flat'").count() == 1
    for g in ("a", None):
        rows = curves.where(F.col("grp").eqNullSafe(F.lit(g))).collect()
        x, y = np.array([r["features"] for r in rows]), np.array([r["label"] for r in rows])
        m = models[g]
        beta, bias = K.solve_dual(x, y, m.gamma, 1.0, 0.1, tolerance=1e-7)
        np.testing.assert_allclose(m.predict(x), K.kernel(x, x, m.gamma) @ beta + bias, atol=1e-3)
        assert len(m.beta) > 100 and abs(m.beta.sum()) < 1e-5 and np.abs(m.beta).max() <= 1.0
        assert m.gamma == pytest.approx(1 / (2 * x.var()))
        # the conditions of the optimum, by the kernel itself
        held = {(*r["x"], r["y"]): r["beta"] for r in table.where(F.col("grp").eqNullSafe(F.lit(g)) & (F.col("beta") != 0)).collect()}
        over, b = y - m.predict(x), np.array([held.get((*u, v), 0.0) for u, v in zip(x.tolist(), y)])
        gap = np.where(b == 0, np.abs(over) - 0.1, np.abs(over * np.sign(b) - 0.1))
        assert np.where(np.abs(b) >= 1.0, 0.1 - over * np.sign(b), gap).max() <= 1e-4


def test_kernels_of_large_rank_go_to_the_cascade(curves, monkeypatch):
    """a basis that grows too large is given up, and the cascade solves the group."""
    want = K.load_supports(K.fit_kernel_svr(curves.drop("i"), "grp"), "grp")
    monkeypatch.setattr(K, "LOW_RANK_ABOVE", 200)
    plain = LR.fit_low_rank
    monkeypatch.setattr(LR, "fit_low_rank", lambda *args: {g: m for g, m in plain(*args, most=12).items()})
    got = K.load_supports(K.fit_kernel_svr(curves.drop("i"), "grp"), "grp")
    grid = np.random.default_rng(1).exponential(size=(20, 2))
    for g in ("a", None, "flat"):
        np.testing.assert_allclose(got[g].predict(grid), want[g].predict(grid), atol=1e-2)
