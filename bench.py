"""Benchmark of the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line. Every query is forced with the ``noop`` sink (full
computation, nothing collected), except the experiment, whose result is a few
rows per filter.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    t0 = time.perf_counter()
    from pyspark.sql import functions as F

    from tidemark import config
    from tidemark.operators import features as FE
    from tidemark.operators import filters as FL
    from tidemark.operators import kalman as KM
    from tidemark.operators import models as MD
    from tidemark.operators.index import SeriesSpec
    from tidemark.plans import catalogue as C
    from tidemark.plans.experiment import run_experiment
    from tidemark.session import local_session, ship_package
    from tidemark.sources.tables import events_signal, table

    spark = local_session(cpus, shuffle_partitions=int(cpus), app="tidemark-bench")
    ship_package(spark)
    session_s = time.perf_counter() - t0
    ev = events_signal(spark, sf_dir)
    spec = SeriesSpec(keys=("user_id",), order=("ts",))
    n_rows = table(spark, sf_dir, "events").count()

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    warm: dict[str, float] = {}

    def timed(name, fn):
        # cold: first build and run of the query (includes code generation and JIT);
        # warm: the same query built and run again (steady-state engine cost)
        t = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - t, 3)
        if name != "experiment_linear":
            t = time.perf_counter()
            fn()
            warm[name] = round(time.perf_counter() - t, 3)

    # warm-up (JVM / codegen caches), not reported as a query
    noop(ev.select("user_id", "value"))

    for name in config.FILTERS_TO_COMPARE:
        timed(f"filter_{name}", lambda n=name: noop(FL.apply_filter(ev, spec, n, ["value"])))
    timed("filters_all_wide", lambda: noop(FL.apply_filters(ev, spec, config.FILTERS_TO_COMPARE, ["value", "k"])))
    timed("compare_effects", lambda: C.QUERIES["compare_effects_mse"](spark, sf_dir).collect())
    long_spec = SeriesSpec(keys=(), order=("event_id",), chunk_rows=16384)
    timed("long_series_chunked", lambda: noop(FL.apply_filters(table(spark, sf_dir, "events").select("event_id", "value"),
                                                                  long_spec, config.FILTERS_TO_COMPARE, ["value"])))
    # ten series of a tenth of the table each: many Kalman blocks and a carry between them
    pooled = ev.withColumn("pool", F.col("user_id") % 10)
    pool_spec = SeriesSpec(keys=("pool",), order=("ts", "event_id"))
    timed("kalman_multi_block", lambda: noop(FL.apply_filter(pooled, pool_spec, "kalman", ["value"])))
    timed("kalman_applyinpandas", lambda: noop(KM.kalman_pandas(ev, spec, "value", "value_f", 1e-5, 0.1)))
    timed("preprocess", lambda: noop(FE.preprocess(ev, spec, ["value", "k"], "value", config.SEQUENCE_LENGTH)))
    timed("metrics", lambda: C.QUERIES["metrics_regression"](spark, sf_dir).collect())
    timed("error_stats", lambda: C.QUERIES["error_stats"](spark, sf_dir).collect())
    timed("savgol_101", lambda: noop(FL.apply_filter(pooled, pool_spec, "savitzky_golay", ["value"], window=101)))
    timed("median_101", lambda: noop(FL.apply_filter(pooled, pool_spec, "median", ["value"], kernel_size=101)))
    timed("linear_lag_moments", lambda: C.QUERIES["linear_lag_moments"](spark, sf_dir).collect())
    timed("data_summary", lambda: C.QUERIES["data_summary"](spark, sf_dir).collect())

    def linear_fit():
        pre = FE.preprocess(FL.apply_filter(ev, spec, "moving_average", ["value", "k"]), spec, ["value", "k"], "value",
                            config.SEQUENCE_LENGTH)
        train = pre.where((F.col("split") == "train") & F.col("usable")).select("features", "label")
        MD.fit_linear(train)

    timed("linear_fit", linear_fit)

    def prepared():
        pre = FE.preprocess(FL.apply_filter(ev, spec, "moving_average", ["value", "k"]), spec, ["value", "k"], "value", 10)
        pre = pre.where("usable").select("user_id", "ts", "features", "label", "split")
        return pre.where("split = 'train'").drop("split"), pre.where("split = 'val'").drop("split")

    def fit(kind, **params):
        train, val = prepared()
        MD.create_and_fit(kind, train, val, **params)

    timed("forest_fit_20x6", lambda: fit("random_forest", n_estimators=20, max_depth=6))
    timed("svr_fit_50_epochs", lambda: fit("svr", kernel="fourier", controls=MD.TrainControls(max_iter=50, local_epochs=25)))
    timed("mlp_fit_50_epochs", lambda: fit("mlp", hidden=(32,), max_iter=50, trainer="averaged"))
    # the defaults: 100 trees of depth 10; layers of 100 and 50, synchronous steps (2 epochs)
    timed("forest_fit_default", lambda: fit("random_forest"))
    timed("mlp_sync_2_epochs_default", lambda: fit("mlp", max_iter=2))
    timed("stream_kalman", lambda: noop(C.QUERIES["stream_kalman"](spark, sf_dir)))

    def experiment():
        res = run_experiment(ev, spec, ["value", "k"], "value", ["value", "k"], model_type="linear_regression")
        res.summary.collect()

    timed("experiment_linear", experiment)
    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "total_query_wall_time",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "warm_queries": warm,
        "warm_total": round(sum(warm.values()), 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "events_rows": n_rows,
        "rows_per_sec_filter": {k: round(n_rows / v, 1) for k, v in timings.items() if k.startswith("filter_") and v > 0},
        "rows_per_sec_filter_warm": {k: round(n_rows / v, 1) for k, v in warm.items() if k.startswith("filter_") and v > 0},
        "session_start_s": round(session_s, 3),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
