"""The tool catalogue: ``(tool_key, name, definition)``."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from toolloom import fixed_values as fixed

SCHEMA = "tool_key STRING, name STRING, definition STRING"


def default_catalogue(spark: SparkSession, product: str = fixed.DEFAULT_PRODUCT) -> DataFrame:
    """The ten built-in tools, as a local relation: Spark knows it is small enough to broadcast."""
    rows = []
    for key, (name, description, parameters, required) in fixed.TOOLS.items():
        schema = {
            "type": "object",
            "properties": {p: {"type": kind, "description": text} for p, kind, text in parameters},
        }
        if required is not None:
            schema["required"] = required
        function = {"name": name, "description": description.format(product=product), "parameters": schema}
        rows.append((key, name, json.dumps({"type": "function", "function": function})))
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    return spark.createDataFrame(pa.table([list(c) for c in zip(*rows)], names=names))


def write_tool_catalogue(catalogue: DataFrame, path: str) -> str:
    catalogue.select("tool_key", "name", "definition").write.mode("overwrite").parquet(path)
    return path


def read_tool_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)
