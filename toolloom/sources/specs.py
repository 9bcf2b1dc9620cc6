"""Spec documents from files."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolloom.functions.jsonx import is_valid_json
from toolloom.functions.text import strip

_NOT_A_MAPPING = "root is not a mapping"


def read_specs(spark: SparkSession, path: str | list[str], fmt: str = "json", on_error: str = "raise") -> DataFrame:
    """One row per file: ``(spec_id, content)``, the content as JSON text.

    A document whose root is not a mapping stops the query, or with
    ``on_error="keep"`` stays as a row whose ``error`` says so.
    """
    if on_error not in ("raise", "keep"):
        raise ValueError(f"unknown on_error: {on_error}")
    if fmt == "json":
        specs = _read_json(spark, path)
    elif fmt == "yaml":
        specs = _read_yaml(spark, path)
    else:
        raise ValueError(f"unknown format: {fmt}")
    if on_error == "keep":
        return specs
    failed = F.raise_error(F.concat(F.col("error"), F.lit(": "), F.col("spec_id"))).cast("string")
    return specs.select("spec_id", F.when(F.col("error").isNull(), F.col("content")).otherwise(failed).alias("content"))


def rejected_specs(specs: DataFrame) -> DataFrame:
    """The documents that could not be used, of a read with ``on_error="keep"``."""
    return specs.where(F.col("error").isNotNull()).select("spec_id", "error")


def _read_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("spec_id"), F.col("value").alias("content")
    )
    is_object = is_valid_json(F.col("content")) & strip(F.col("content")).startswith("{")
    return files.select(
        "spec_id",
        F.when(is_object, F.col("content")).alias("content"),
        F.when(~is_object, F.lit(_NOT_A_MAPPING)).alias("error"),
    )


def _read_yaml(spark: SparkSession, path: str | list[str]) -> DataFrame:
    try:
        import yaml  # noqa: F401
    except ImportError as missing:
        raise ImportError("reading YAML specs needs PyYAML") from missing
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(_yaml_to_json, "spec_id STRING, content STRING, error STRING")


def _yaml_to_json(batches: Iterator) -> Iterator:
    import pandas as pd
    import yaml

    loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
    for batch in batches:
        rows = []
        for name, data in zip(batch["path"], batch["content"]):
            try:
                root = yaml.load(data, Loader=loader)
            except yaml.YAMLError as failure:
                rows.append((name, None, f"not YAML: {failure}"))
                continue
            if isinstance(root, dict):
                rows.append((name, json.dumps(root, default=str), None))
            else:
                rows.append((name, None, _NOT_A_MAPPING))
        yield pd.DataFrame(rows, columns=["spec_id", "content", "error"])
