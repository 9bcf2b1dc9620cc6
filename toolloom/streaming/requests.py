"""The request loop as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from toolloom.operators.inference import generate_tool_calls
from toolloom.operators.requests import route_requests


def route_stream(requests: DataFrame, catalogue: DataFrame, make_predictor: Callable | None = None, **options) -> DataFrame:
    """Requests as they arrive, routed and, with a predictor, answered.

    Stateless, so it is the batch operator on a streaming DataFrame; the
    catalogue is the static side of the join.
    """
    routed = route_requests(requests, catalogue)
    return routed if make_predictor is None else generate_tool_calls(routed, make_predictor, **options)


def write_stream(answers: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append answers to parquet; with its checkpoint a restart loses and repeats nothing."""
    writer = answers.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).outputMode("append").start()
