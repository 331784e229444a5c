"""Series model: key columns, an order, a 0-based row index and the series length.

Two ways to number the rows of every series:

* ``window`` (default when the spec has keys and no ``chunk_rows``): one
  ``row_number``/``count`` window per series. One shuffle on the keys; every later
  filter window with the same keys and order reuses it. A single series is held
  by one task, so this is for many bounded series.
* ``range`` (used when ``chunk_rows`` is set, or the spec has no keys): the data is
  range-partitioned on ``(keys, order)`` so that a hot or endless series is spread
  over many partitions, numbered inside each partition, and a small per-partition
  offset table (one row per partition and key present in it) turns local numbers
  into series positions. Filter windows then run on ``(keys, chunk)`` with halo
  copies, so no task ever holds more than ``chunk_rows`` plus two halos.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage, written

IDX = "_idx"
N = "_n"
CHUNK = "_chunk"
OWNER = "_owner"

# chunk_rows="auto": a series longer than this is processed in halo chunks.
AUTO_CHUNK_ABOVE = 4_000_000
AUTO_CHUNK_ROWS = 1 << 20
_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


@dataclass(frozen=True)
class SeriesSpec:
    """How rows form series: ``keys`` identify a series, ``order`` sorts it.

    ``order`` may list several columns (tie-breakers); the order must be unique
    within a series. ``chunk_rows`` switches to the skew-safe range index with halo
    chunks of that many rows; ``"auto"`` (default) measures the longest series
    once and chunks only when one exceeds ``AUTO_CHUNK_ABOVE`` rows (a hot key);
    ``None`` always uses one window per series. ``check_order`` raises if an order
    value repeats within a series (one more aggregate); without it rows that tie have
    arbitrary positions among themselves.
    """

    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ("ts",)
    chunk_rows: int | str | None = "auto"
    index_partitions: int | None = None
    max_len: int | None = None
    check_order: bool = False

    def __post_init__(self):
        keys = (self.keys,) if isinstance(self.keys, str) else tuple(self.keys)
        order = (self.order,) if isinstance(self.order, str) else tuple(self.order)
        object.__setattr__(self, "keys", keys)
        object.__setattr__(self, "order", order)
        if not order:
            raise ValueError("a series needs an order column")
        if self.chunk_rows not in (None, "auto") and int(self.chunk_rows) < 1:
            raise ValueError("chunk_rows must be positive")

    @property
    def chunked(self) -> bool:
        return isinstance(self.chunk_rows, int) or not self.keys

    @property
    def rows_per_chunk(self) -> int:
        return int(self.chunk_rows) if isinstance(self.chunk_rows, int) else AUTO_CHUNK_ROWS

    def window_keys(self) -> list[str]:
        return list(self.keys) + ([CHUNK] if self.chunked else [])

    def window_sql(self) -> str:
        """``PARTITION BY ... ORDER BY ...`` text of :meth:`window` for SQL expressions."""
        q = lambda c: "`" + c.replace("`", "``") + "`"
        return f"PARTITION BY {', '.join(q(c) for c in self.window_keys())} ORDER BY {', '.join(q(c) for c in self.order)}"

    def window(self) -> Window:
        """Ordered window over one series (or one chunk of it, with halo rows)."""
        return Window.partitionBy(*self.window_keys()).orderBy(*[F.col(c) for c in self.order])


def resolve(df: DataFrame, spec: SeriesSpec) -> tuple[SeriesSpec, int | None]:
    """Settle ``chunk_rows="auto"``: one key-only aggregate finds the longest series;
    a hot series (over ``AUTO_CHUNK_ABOVE`` rows) switches to halo chunks."""
    from dataclasses import replace

    if spec.chunk_rows != "auto" or not spec.keys:
        return spec, spec.max_len
    longest = spec.max_len if spec.max_len is not None else max_series_length(df, spec)
    chunk = AUTO_CHUNK_ROWS if longest > AUTO_CHUNK_ABOVE else None
    return replace(spec, chunk_rows=chunk, max_len=longest), longest


def with_index(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Add ``_idx`` (0-based position in the series) and ``_n`` (series length)."""
    return with_index_info(df, spec)[0]


def with_index_info(df: DataFrame, spec: SeriesSpec) -> tuple[DataFrame, int | None]:
    """:func:`with_index` plus the longest series length when it is known without
    an extra job (the range index measures it while sizing its offset table). An
    unsettled ``chunk_rows="auto"`` is settled first (:func:`resolve`)."""
    spec, _ = resolve(df, spec)
    if spec.check_order:
        check_unique_order(df, spec)
    if spec.chunked:
        return _range_index(df, spec)
    w = Window.partitionBy(*spec.keys).orderBy(*[F.col(c) for c in spec.order])
    out = df.withColumns(
        {
            IDX: F.row_number().over(w) - F.lit(1),
            N: F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    )
    return out, spec.max_len


def _bytes(conf_value: str) -> int:
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    v = conf_value.strip().lower()
    for suffix in sorted(units, key=len, reverse=True):
        if v.endswith(suffix):
            return int(float(v[: -len(suffix)]) * units[suffix])
    return int(v)


def range_partitions(df: DataFrame) -> int:
    """Partitions for an explicit range repartition (AQE does not resize those):
    the optimizer's size estimate of the input over the advisory partition size,
    at least the cluster's parallelism and the configured shuffle partitions."""
    spark = df.sparkSession
    floor = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size >= 1 << 60:  # no estimate (local rows, checkpoints): the configured count
            return floor
        target = _bytes(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))
        return int(max(floor, -(-size // max(target, 1))))
    except Exception:  # noqa: BLE001 - no estimate: fall back to the configured count
        return floor


def _range_index(df: DataFrame, spec: SeriesSpec) -> tuple[DataFrame, int]:
    spark = df.sparkSession
    keys, order = list(spec.keys), list(spec.order)
    parts_n = spec.index_partitions or range_partitions(df)
    ranged = (
        df.repartitionByRange(parts_n, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # Partition-local numbers are only stable once written: a reliable checkpoint
    # fixes them and survives executor loss.
    ranged = cut_lineage(ranged)
    ranged = ranged.withColumns(
        {
            "_pid": F.shiftright("_mid", _LOCAL_BITS),
            "_pos": F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)),
        }
    ).drop("_mid")
    kalias = [f"_k{i}" for i in range(len(keys))]
    parts = ranged.groupBy("_pid", *[F.col(k).alias(a) for k, a in zip(keys, kalias)]).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_pos").alias("_p0")
    )
    w = Window.partitionBy(*kalias).orderBy("_pid")
    parts = parts.select(
        F.col("_pid").alias("_qpid"),
        *kalias,
        "_p0",
        (F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_c")).alias("_off"),
        F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(N),
    )
    # One row per (partition, key present in it): written, so that the length below and
    # the join share one computation. The join's strategy is left to Spark, which
    # knows the bytes: it broadcasts a small table and shuffles (and splits) a large one.
    parts = written(parts, "offsets")
    size = parts.agg(F.max(N).alias("longest")).first()
    cond = [F.col("_pid") == F.col("_qpid")] + [F.col(k).eqNullSafe(F.col(a)) for k, a in zip(keys, kalias)]
    out = ranged.join(parts, on=cond, how="inner")
    out = out.withColumn(IDX, F.col("_off") + F.col("_pos") - F.col("_p0"))
    return out.drop("_pid", "_pos", "_qpid", "_p0", "_off", *kalias), int(size["longest"] or 0)


def expand_halo(df: DataFrame, spec: SeriesSpec, left: int, right: int) -> DataFrame:
    """Copy the rows a chunk's neighbours need (``left``/``right`` rows of context).

    No-op for per-series windows. Each row keeps ``_owner`` = its own chunk so the
    copies can be dropped after the window by :func:`drop_halo`.
    """
    if not spec.chunked:
        return df
    size = max(spec.rows_per_chunk, left, right, 1)
    own = F.floor(F.col(IDX) / F.lit(size)).cast("long")
    off = F.col(IDX) - own * F.lit(size)
    copies = F.array(
        own,
        F.when((off < F.lit(right)) & (own > 0), own - 1),
        F.when((off >= F.lit(size - left)) & ((own + 1) * F.lit(size) < F.col(N)), own + 1),
    )
    return (
        df.withColumn(OWNER, own)
        .withColumn(CHUNK, F.explode(copies))
        .where(F.col(CHUNK).isNotNull())
    )


def drop_halo(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    if not spec.chunked:
        return df
    return df.where(F.col(CHUNK) == F.col(OWNER)).drop(OWNER)


def shift(x: Column, offset: int, spec: SeriesSpec, default=None) -> Column:
    """Value ``offset`` rows later (negative: earlier) in the series window."""
    w = spec.window()
    if offset == 0:
        return x
    if offset > 0:
        return F.lead(x, offset, default).over(w)
    return F.lag(x, -offset, default).over(w)


def max_series_length(df: DataFrame, spec: SeriesSpec) -> int:
    """Longest series (one small aggregate job, partial aggregation first). Measured on
    every call: give ``max_len`` in the spec to save it."""
    if not spec.keys:
        return int(df.count())
    row = df.groupBy(*spec.keys).count().agg(F.max("count")).first()
    return int(row[0] or 0)


def check_unique_order(df: DataFrame, spec: SeriesSpec) -> None:
    """Raise if an order value repeats inside a series (ties make positions ambiguous)."""
    dup = df.groupBy(*spec.keys, *spec.order).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"order {spec.order} is not unique within series {spec.keys}: {dup[0]}")
