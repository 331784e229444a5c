"""Helpers shared by the pipeline operators: shared storage and text columns."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir

# Words of the contracts: runs of anything but space and tab..carriage return.
# ``bytes.split()`` cuts at exactly these six bytes, so Python tasks use that.
WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts lineage: the files outlive any executor, and later reads prune columns.
    """
    spark = df.sparkSession
    path = shared_path(spark, tag)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_of_id(doc_id: Column) -> Column:
    """CRC-32 of the id written as text (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))


def publish(spark: SparkSession, data: bytes, tag: str) -> str:
    """Put a bounded block of bytes into the shared folder and have every executor fetch
    it; tasks find it as ``SparkFiles.get(name)`` and can map it into memory."""
    path = shared_path(spark, tag)
    jvm = spark.sparkContext._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    out = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(to)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]
