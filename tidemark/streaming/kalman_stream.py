"""Streaming Kalman filter: the recursion state ``(x, p, step)`` per series.

The filter is causal, so a stream can be filtered incrementally: each
micro-batch sorts a series' new rows by time and continues the recursion from the
state kept by ``applyInPandasWithState``. Rows older than the series' last processed
time are late: the state has moved past them, so they come out unfiltered, marked
``late``, and can be counted; none is lost. Rows *at* that time go on from the state.
Output equals the batch filter on in-order data. A series keeps its few numbers of state
as long as the query runs: there is no timeout, as a series may always go on.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from tidemark import config
from tidemark.session import checkpoint_dir

STATE_SCHEMA = T.StructType(
    [
        T.StructField("x", T.DoubleType()),
        T.StructField("p", T.DoubleType()),
        T.StructField("step", T.LongType()),
        T.StructField("started", T.BooleanType()),
        T.StructField("last_ts", T.TimestampType()),
    ]
)


def kalman_stream(
    stream: DataFrame,
    key: str,
    ts: str,
    value: str,
    carry=(),
    output: str = "value_f",
    process_variance: float = config.KALMAN_PROCESS_VARIANCE,
    measurement_variance: float = config.KALMAN_MEASUREMENT_VARIANCE,
    watermark: str = "1 hour",
) -> DataFrame:
    """Filter ``value`` per ``key`` in ``ts`` order on a streaming DataFrame.

    ``ts`` must be a TIMESTAMP column (cast ``timestamp_ntz`` first). Output: ``key``,
    ``ts``, the ``carry`` columns, ``output`` (null for late rows) and ``late``.
    """
    q, r = float(process_variance), float(measurement_variance)
    cols = [key, ts, *carry, value]
    src = stream.select(*cols).withWatermark(ts, watermark)
    in_fields = {f.name: f for f in src.schema.fields}
    out_schema = T.StructType(
        [in_fields[key], in_fields[ts], *[in_fields[c] for c in carry], T.StructField(output, T.DoubleType()), T.StructField("late", T.BooleanType())]
    )

    def step_fn(keys, batches, state):
        frames = [b for b in batches if len(b)]
        if not frames:
            return
        pdf = pd.concat(frames, ignore_index=True)
        if state.exists:
            x, p, step, started, last_ts = state.get
        else:
            x, p, step, started, last_ts = np.nan, 1.0, 0, False, None
        pdf = pdf.sort_values(ts, kind="stable")
        if last_ts is not None:
            behind = pdf[ts] < pd.Timestamp(last_ts)
            if behind.any():
                late = pdf.loc[behind, [key, ts, *carry]].copy()
                late[output], late["late"] = np.nan, True
                yield late
            pdf = pdf[~behind]
        z = pdf[value].astype("float64").values
        out = np.full(len(z), np.nan)
        for i, v in enumerate(z):
            if step >= 1:
                pm = p + q
                k = pm / (pm + r) if r > 0 else 1.0
                p = (1.0 - k) * pm
            if not np.isnan(v):
                if not started:
                    x, started = float(v), True
                elif step >= 1:
                    x = x + k * (v - x)
                out[i] = x
            step += 1
        if len(pdf):
            last_ts = pdf[ts].iloc[-1].to_pydatetime()
        state.update((float(x) if started else None, float(p), int(step), bool(started), last_ts))
        res = pdf[[key, ts, *carry]].copy()
        res[output], res["late"] = out, False
        yield res

    return src.groupBy(key).applyInPandasWithState(
        step_fn, out_schema, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


def run_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Drive a streaming query to completion (``availableNow``) into a parquet folder
    under the shared checkpoint directory and read the result back."""
    base = checkpoint_dir(spark)
    run = f"{base.rstrip('/')}/stream-{name}-{uuid.uuid4().hex[:12]}"
    out_dir, ckpt = f"{run}/out", f"{run}/checkpoint"
    query = (
        stream.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", ckpt)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.parquet(out_dir)


def split_by_time(spark: SparkSession, df: DataFrame, ts: str, pieces: int, name: str, files_per_piece: int = 4) -> str:
    """Write ``df`` as ``pieces`` consecutive time slices, one append per slice, so the
    file source (oldest files first) replays them in time order. Slice bounds come
    from the time range; no row is dropped. Returns the folder."""
    base = checkpoint_dir(spark)
    folder = f"{base.rstrip('/')}/source-{name}-{uuid.uuid4().hex[:12]}"
    bounds = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    lo_us = F.unix_micros(F.lit(bounds["lo"]).cast("timestamp"))
    span = (F.unix_micros(F.lit(bounds["hi"]).cast("timestamp")) - lo_us + 1).cast("double")
    piece = F.floor((F.unix_micros(F.col(ts).cast("timestamp")) - lo_us) / span * pieces).cast("int")
    tagged = df.withColumn("_piece", piece)
    for pc in range(pieces):  # a fixed, small number of sequential appends
        (tagged.where(F.col("_piece") == pc).drop("_piece").repartition(files_per_piece)
         .write.mode("append").parquet(folder))
    return folder


def stream_events_kalman(spark: SparkSession, sf_dir: str, pieces: int = 4, files_per_piece: int = 4) -> DataFrame:
    """The whole ``events`` table replayed as a stream in time order, Kalman per user."""
    # timestamp_ntz -> TIMESTAMP through epoch microseconds, independent of the
    # session time zone (a DST shift must not merge or reorder readings)
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    ev = spark.read.parquet(os.path.join(sf_dir, "events.parquet")).select(
        "user_id", F.timestamp_micros(micros).alias("ts"), "event_id", "value"
    )
    folder = split_by_time(spark, ev, "ts", pieces, "events", files_per_piece)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", files_per_piece).parquet(folder)
    filtered = kalman_stream(stream, "user_id", "ts", "value", carry=("event_id",))
    return run_to_table(spark, filtered, "kalman")
