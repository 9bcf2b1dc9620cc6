"""Evaluation reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from toolloom.operators.metrics import eval_errors, eval_metrics, metrics_report


def write_eval_report(results: DataFrame, path: str, index: str = "sample_id") -> DataFrame:
    """Write ``path/results``, ``path/metrics`` and ``path/errors``; return the metrics.

    Results are written first and the rest is computed from what was written:
    predictions run once, and nothing has to be kept in memory.
    """
    spark = results.sparkSession
    results.write.mode("overwrite").parquet(f"{path}/results")
    stored = spark.read.parquet(f"{path}/results")
    metrics = eval_metrics(stored)
    metrics_report(metrics).write.mode("overwrite").json(f"{path}/metrics")
    eval_errors(stored, index).write.mode("overwrite").json(f"{path}/errors")
    return metrics
