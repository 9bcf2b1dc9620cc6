"""Requests in natural language: clean, route, look up, prompt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom import fixed_values as fixed
from toolloom.functions import chat
from toolloom.functions.routing import route_tool
from toolloom.functions.text import strip
from toolloom.operators.chat import inference_prompts


def filter_requests(df: DataFrame, col: str = "request", stop_words: Sequence[str] = fixed.STOP_WORDS) -> DataFrame:
    """Strip the request; drop blank ones and stop words."""
    stripped = df.withColumn(col, strip(F.col(col)))
    return stripped.where((F.col(col) != "") & ~F.lower(F.col(col)).isin(*stop_words))


def lookup_tool(df: DataFrame, catalogue: DataFrame, key: str = "tool_key", request: str = "request") -> DataFrame:
    """Add ``definition`` and ``status``: ok, blank_request or unknown_tool.

    The default catalogue is ten rows and Spark broadcasts it by its size; one
    too large for that is joined by shuffle.
    """
    found = df.join(
        catalogue.select(F.col("tool_key").alias("_key"), "definition"), F.col(key) == F.col("_key"), "left"
    ).drop("_key")
    blank = F.coalesce(strip(F.col(request)), F.lit("")) == ""
    status = F.when(blank, "blank_request").when(F.col("definition").isNull(), "unknown_tool").otherwise("ok")
    return found.withColumn("status", status).withColumn(
        "definition", F.when(F.col("status") == "ok", F.col("definition"))
    )


def route_requests(
    df: DataFrame,
    catalogue: DataFrame,
    col: str = "request",
    system: str | None = None,
    style: chat.ChatStyle = chat.CHATML,
) -> DataFrame:
    """Filter, route, look up and render: adds ``tool_key``, ``definition``, ``status``, ``prompt``."""
    routed = filter_requests(df, col).withColumn("tool_key", route_tool(F.col(col)))
    found = lookup_tool(routed, catalogue, request=col).drop("status")
    return inference_prompts(found, col, "definition", system=system, style=style).drop("tool_text")
