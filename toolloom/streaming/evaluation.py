"""Evaluation of tool calls on streams: windowed metrics, and samples paired with predictions as both arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from toolloom.operators.evaluate import ranked_predictions, with_missing
from toolloom.operators.metrics import metrics_by_window


def stream_metrics(
    results: DataFrame,
    time: str,
    length: str,
    late: str,
    slide: str | None = None,
    by: Sequence[str] = (),
    key: str | None = "sample_id",
) -> DataFrame:
    """All measures for each window and value of ``by``, as :func:`metrics_by_window` has them for a table.

    A row is late when its time is before the watermark, the latest time seen less
    ``late``. With a ``key`` a result that comes again within that span counts once,
    and late rows are taken out there one by one, so that :func:`late_rows` counts rows, not groups.
    State holds the keys and windows that the watermark has not passed. Rows come in append mode,
    each window once, when the watermark has passed its end.
    """
    timed = results.where(F.col(time).isNotNull()).withWatermark(time, late)
    once = timed.dropDuplicatesWithinWatermark([key]) if key else timed
    return metrics_by_window(once, time, length, slide, by)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's first stateful step has left out as too late, over its recent progress."""
    steps = [p["stateOperators"] for p in query.recentProgress]
    return sum(s[-1]["numRowsDroppedByWatermark"] for s in steps if s)


def state_rows(query: StreamingQuery) -> int:
    """Rows that all of the query's stateful steps hold after its last batch."""
    last = query.lastProgress
    return sum(s["numRowsTotal"] for s in last["stateOperators"]) if last else 0


def pair_stream(
    samples: DataFrame,
    predictions: DataFrame,
    sample_time: str,
    prediction_time: str,
    within: str,
    late: str,
    key: str = "sample_id",
) -> DataFrame:
    """:func:`pair_predictions` for streams: each sample once, with its best prediction or as ``missing_prediction``.

    A prediction counts if its time is not before its sample's and at most ``within``
    after it. Both sides may come out of order by ``late``. The join keeps a row until the watermark
    rules out a partner; then the best of a sample's predictions is chosen as in the batch. A
    sample's row comes when the watermark has passed its time by ``within``. Repeated samples
    (all columns equal) are one. The columns are those of the batch and ``sample_time``.
    """
    wanted, rank = ranked_predictions(predictions)
    rows = samples.withColumnRenamed("output", "expected").where(F.col(sample_time).isNotNull()).withWatermark(sample_time, late)
    answers = predictions.select(F.col(key).alias("_key"), F.col(prediction_time).alias("_at"), rank.alias("_one")).withWatermark("_at", late)
    near = (F.col("_at") >= F.col(sample_time)) & (F.col("_at") <= F.col(sample_time) + F.expr(f"INTERVAL {within}"))
    joined = rows.join(answers, (F.col(key) == F.col("_key")) & near, "leftOuter")
    best = joined.groupBy(*rows.columns).agg(F.min("_one").alias("_one"))
    found = F.when(F.col("_one").isNotNull(), F.lit(True)).alias("_found")
    taken = [c for c in wanted if c not in rows.columns]
    return with_missing(best.select(*rows.columns, found, *[F.col(f"_one.{c}") for c in taken]), "error" in wanted)
