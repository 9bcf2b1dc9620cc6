"""Intermediate tables and folders in the place that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A folder not yet made, below ``spark.checkpoint.dir``; a local session without the setting gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="toolloom-")
    return f"{base.rstrip('/')}/toolloom-{uuid.uuid4().hex}"


def written(frame: DataFrame) -> DataFrame:
    """The frame as a table written once: the same rows for every reader, and a lost executor costs its tasks only."""
    path, schema = scratch_folder(frame.sparkSession), frame.schema
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(schema).parquet(path)
