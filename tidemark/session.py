"""Session helpers: a local session for tests and the checkpoint folder rule."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """Session for tests and local benchmarks (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # window stages are CPU-heavy for their shuffle size: keep one partition per
        # core instead of merging small shuffles into a single task
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only in local mode.

    On a cluster the folder must come from ``spark.checkpoint.dir``; a
    machine-local temporary folder is only used when the master is local and
    nothing is configured (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder on the cluster")
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never a local one): survives executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, tag: str, by: str | None = None) -> DataFrame:
    """Write a (small) table to the shared folder and read it back: lineage is cut, and
    Spark knows its bytes when it picks a join. ``by``: a column whose values get folders
    of their own, so that a filter on it reads only its files."""
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"
    schema = df.schema
    df.write.parquet(path, partitionBy=by)
    return spark.read.schema(schema).parquet(path)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidemark`` importable on executors (pandas UDF workers) via ``addPyFile``."""
    import io
    import zipfile

    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-pkg-"), "tidemark.zip")
    with open(path, "wb") as fh:
        fh.write(buf.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(id(sc))
