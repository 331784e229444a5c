"""Telemetry sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.index import range_partitions

# Fixed column names of the telemetry CSV (reference schema).
TIME_COLUMN = "Time Elapsed (s)"
TARGET_COLUMN = "available_capacity (Ah)"
FEATURE_COLUMNS = (
    "Time Elapsed (s)", "soc", "pack_voltage (V)", "charge_current (A)", "max_cell_voltage (V)",
    "min_cell_voltage (V)", "max_temperature (℃)", "min_temperature (℃)",
)
FILTER_TARGET_COLUMNS = (
    "pack_voltage (V)", "charge_current (A)", "max_cell_voltage (V)", "min_cell_voltage (V)",
    "max_temperature (℃)", "min_temperature (℃)",
)
NUMERIC_COLUMNS = FEATURE_COLUMNS + (TARGET_COLUMN,)
# What the usual CSV readers take for a missing number.
MISSING_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _number(c: str, bad_values: str):
    """A CSV field as double; missing values are null."""
    text = F.trim(F.col("`" + c.replace("`", "``") + "`"))
    number = text.try_cast("double")
    if bad_values == "raise":
        message = F.concat(F.lit(f"not a number in column {c}: "), text)
        number = F.when(number.isNull(), F.raise_error(message).cast("double")).otherwise(number)
    return F.when(text.isNotNull() & ~text.isin(*MISSING_VALUES), number).alias(c)


def _folder(spark: SparkSession, reader, path: str) -> DataFrame:
    """All ``*.csv`` files below a folder, as strings. The names come from one file's header (Spark
    would list all files once more to infer them); a few tasks a core list the folders."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = files.listFiles(top, True) if files.exists(top) else None
    first = None
    while found is not None and first is None and found.hasNext():
        one = found.next().getPath()
        first = one.toString() if one.getName().endswith(".csv") and one.getName()[0] not in "._" else None
    if first is None:
        raise FileNotFoundError(f"no file at {path}")
    names = T.StructType([T.StructField(c, T.StringType()) for c in reader.csv(first).columns])
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        return reader.schema(names).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(path)
    finally:
        spark.conf.set(setting, before)


def load_telemetry_csv(spark: SparkSession, path: str, series_from_file: bool = True, bad_values: str = "raise", recursive: bool = False) -> DataFrame:
    """Header CSV(s); the nine named columns as double, others as string.

    Missing numbers (:data:`MISSING_VALUES`, spaces around them or not) are null. Any other
    text in a named column stops the load (``bad_values="raise"``) or is null (``"null"``),
    whatever the session's ANSI mode.

    ``path`` may be a glob of many files (the reference reads one), or with ``recursive`` a
    folder whose ``*.csv`` files are found at any depth, listed by Spark's tasks and not one
    by one in the driver. Small files are put together to parts by their bytes. With
    ``series_from_file`` each file becomes one series keyed by ``source_file``;
    rows keep their file order in ``row_id`` (the reference's time order): the place of
    the split in the file, then the row in the split, whatever the file's size.
    """
    if bad_values not in ("raise", "null"):
        raise ValueError("bad_values must be 'raise' or 'null'")
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("inferSchema", False)
    try:
        raw = _folder(spark, reader, path) if recursive else reader.csv(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no file at {path}") from exc
        raise
    cols = []
    for c in raw.columns:
        col = F.col("`" + c.replace("`", "``") + "`")
        cols.append(_number(c, bad_values) if c in NUMERIC_COLUMNS else col)
    out = raw.select(*cols)
    if series_from_file:
        # a split lies in one task: its start in the file, then the row's number in the task
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        out = raw.select(*cols, F.col("_metadata.file_path").alias("source_file"),
                         F.struct(F.col("_metadata.file_block_start").alias("block"), row.alias("row")).alias("row_id"))
    return out.coalesce(range_partitions(raw))


def load(spark: SparkSession, fmt: str, path: str, **options) -> DataFrame:
    """S3: any Spark source (``parquet``, ``csv``, ``json``, ``orc`` ...)."""
    return spark.read.format(fmt).options(**options).load(path)


def synthetic_telemetry(spark: SparkSession, rows: int = 500, seed: int = 42) -> DataFrame:
    """sin(x) + 0.05x plus N(0, 0.2) noise on x in [0, 10], five columns."""
    x = F.col("id").cast("double") * F.lit(10.0 / max(rows - 1, 1))
    noisy = F.sin(x) + F.lit(0.05) * x + F.randn(seed) * F.lit(0.2)
    return spark.range(rows).select(
        F.col("id").alias("row_id"),
        x.alias(TIME_COLUMN),
        (F.lit(4.2) + noisy * F.lit(0.1)).alias("pack_voltage (V)"),
        (F.lit(-2.0) + F.randn(seed + 1) * F.lit(0.05) + F.cos(x / F.lit(5.0)) * F.lit(0.1)).alias("charge_current (A)"),
        (F.lit(40.0) + F.randn(seed + 2) * F.lit(0.5)).alias("max_temperature (℃)"),
        (F.lit(1200.0) - x * F.lit(0.1)).alias(TARGET_COLUMN),
    )


def synthetic_pairs(spark: SparkSession, rows: int = 100, seed: int = 42) -> DataFrame:
    """y = 2x + 1 + N(0, 1), prediction = 2x + 0.8 + N(0, 0.5) on x in [0, 10]."""
    x = F.col("id").cast("double") * F.lit(10.0 / max(rows - 1, 1))
    return spark.range(rows).select(
        (F.lit(2.0) * x + F.lit(1.0) + F.randn(seed)).alias("label"),
        (F.lit(2.0) * x + F.lit(0.8) + F.randn(seed + 1) * F.lit(0.5)).alias("prediction"),
    )


__all__ = ["load_telemetry_csv", "load", "synthetic_telemetry", "synthetic_pairs", "T"]
