"""Result sinks (K1, K2) with the reference file layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.experiment import SUMMARY_RENAMES


def write_summary_csv(summary: DataFrame, path: str) -> None:
    """K1: one small CSV (one row per filter), overwritten, reference column names."""
    out = summary
    for src, dst in SUMMARY_RENAMES.items():
        if src in out.columns:
            out = out.withColumnRenamed(src, dst)
    # one row per filter: a single output file is safe
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_reports_json(reports: DataFrame, path: str, run_id: str | None = None) -> None:
    """K2: nested reports as JSON lines, partitioned by a run id (yyyyMMdd_HHmmss)."""
    rid = F.lit(run_id) if run_id else F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss")
    reports.withColumn("run_id", rid).write.mode("append").partitionBy("run_id").json(path)
