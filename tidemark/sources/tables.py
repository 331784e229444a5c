"""Driver tables (parquet) and the signal views built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; column pruning and filters reach the parquet scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as sensor series: ``value`` and a second channel ``k`` per ``user_id`` by ``ts``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "user_id", "event_id", "ts", "event_type", "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )


def conversation_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as short series: text length per ``conv_id`` by ``turn``."""
    cv = table(spark, sf_dir, "conversations")
    return cv.select("conv_id", "turn", F.length("text").cast("double").alias("len"))


def orders_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as one series per customer: total price by date then key."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
