"""Metrics over evaluation results: one partial and one final aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolloom import fixed_values as fixed
from toolloom.functions.numbers import round_half_even

RATES = {
    "json_validity_rate": "valid_json_count",
    "tool_name_accuracy": "correct_tool_name_count",
    "argument_accuracy": "correct_arguments_count",
    "overall_accuracy": "correct_arguments_count",
}
COUNTS = [
    "total_samples",
    "valid_json_count",
    "correct_tool_name_count",
    "correct_arguments_count",
]

# Registers of a sketch of distinct names, as a power of two.
SKETCH_BITS = 14


def _is_error() -> Column:
    return F.coalesce(F.col("error") != "", F.lit(False))


def _totals() -> list[Column]:
    """What all measures are made of. Seconds are summed as decimals, so the sum does not depend on task order."""
    seconds = F.coalesce(F.sum(F.col("inference_time").cast("decimal(18,6)")), F.lit(0)).cast("double")
    return [
        F.count("*").alias("total_samples"),
        F.count_if("is_valid_json").alias("valid_json_count"),
        F.count_if("name_correct").alias("correct_tool_name_count"),
        F.count_if("arguments_correct").alias("correct_arguments_count"),
        F.count_if(_is_error()).alias("error_count"),
        seconds.alias("total_inference_time"),
        F.coalesce(F.sum("num_tokens"), F.lit(0)).alias("total_tokens"),
    ]


def _measures() -> list[Column]:
    """Counts, rates over all rows and timing, from the totals."""
    total, time = F.col("total_samples"), F.col("total_inference_time")
    return [
        *[F.col(count) for count in COUNTS],
        *[_ratio(F.col(count), total, total > 0).alias(rate) for rate, count in RATES.items()],
        time,
        _ratio(time, total, (total > 0) & (time > 0)).alias("avg_inference_time"),
        _ratio(F.col("total_tokens"), time, time > 0).alias("tokens_per_second"),
        F.col("error_count"),
    ]


def eval_metrics(results: DataFrame) -> DataFrame:
    """One row: counts, rates over all rows, and timing; all zero without rows."""
    return results.agg(*_totals()).select(*_measures())


def metrics_by(results: DataFrame, *by: str) -> DataFrame:
    """All measures for each value of the columns, rolled up to one total row, which equals :func:`eval_metrics`.

    ``is_total`` marks the row over everything; null in a column of any other row
    is a subtotal or a null value, told apart by ``level``, Spark's grouping id.
    """
    totals = results.rollup(*by).agg(F.grouping_id().alias("level"), *_totals())
    return totals.select(*by, "level", (F.col("level") == (1 << len(by)) - 1).alias("is_total"), *_measures())


def metrics_by_window(results: DataFrame, time: str, length: str, slide: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """All measures for each window of event time and value of the columns: ``window_start``, ``window_end``, ``by``, measures.

    The same aggregation serves a table and a stream; on a stream with a watermark
    a window's row comes once the watermark has passed its end. Rows without a time
    belong to no window. With ``slide`` shorter than ``length`` a row counts in several windows.
    """
    spans = F.window(F.col(time), length, slide) if slide else F.window(F.col(time), length)
    totals = results.groupBy(spans.alias("_span"), *by).agg(*_totals())
    return totals.select(F.col("_span.start").alias("window_start"), F.col("_span.end").alias("window_end"), *by, *_measures())


def _ratio(part: Column, whole: Column, defined: Column) -> Column:
    return F.when(defined, part / whole).otherwise(0.0)


def eval_errors(results: DataFrame, index: str = "sample_id") -> DataFrame:
    """The rows with an error: ``index``, ``instruction``, ``error``."""
    return results.where(_is_error()).select(F.col(index).alias("index"), "instruction", "error")


def metrics_report(metrics: DataFrame) -> DataFrame:
    """Metrics rounded for a report; the unrounded ones stay authoritative."""
    rounded = lambda name, places: round_half_even(F.col(name), places)
    return metrics.select(
        *COUNTS,
        *[rounded(rate, 4).alias(rate) for rate in RATES],
        rounded("total_inference_time", 2).alias("total_inference_time_seconds"),
        rounded("avg_inference_time", 4).alias("avg_inference_time_seconds"),
        rounded("tokens_per_second", 2).alias("tokens_per_second"),
        "error_count",
    )


def metrics_text(metrics: DataFrame) -> DataFrame:
    """Add ``text``, the readable block."""

    def percent(rate: str) -> Column:
        return F.format_string("%.2f%%", F.col(rate) * 100)

    total = F.col("total_samples")
    block = F.format_string(
        fixed.METRICS_BLOCK,
        total,
        *[
            part
            for rate in ("json_validity_rate", "tool_name_accuracy", "argument_accuracy")
            for part in (percent(rate), F.col(RATES[rate]), total)
        ],
        percent("overall_accuracy"),
        F.format_string("%.3f", F.col("avg_inference_time")),
        F.format_string("%.1f", F.col("tokens_per_second")),
        F.col("error_count"),
    )
    return metrics.withColumn("text", block)


def card_metrics(metrics: DataFrame) -> DataFrame:
    """The three percentages of a model card."""
    shown = ("json_validity_rate", "tool_name_accuracy", "argument_accuracy")
    return metrics.select(*[(F.col(rate) * 100).alias(rate) for rate in shown])


def dataset_profile(samples: DataFrame) -> DataFrame:
    """What a dataset card states: number of samples, of distinct tools, and size category."""
    tool = F.get_json_object("input", "$.function.name")
    counted = samples.agg(F.count("*").alias("num_samples"), F.count_distinct(tool).alias("num_tools"))
    return counted.withColumn("size_category", size_category(F.col("num_samples")))


def profile_parts(samples: DataFrame, *by: str) -> DataFrame:
    """A profile of each part of a dataset, such as a file, that can be merged: ``by``, ``num_samples``, ``tools``.

    ``tools`` is a sketch of the distinct tool names of a few KB whatever the part's size,
    so a dataset that grows by a file needs the profile of that file alone.
    """
    tool = F.get_json_object("input", "$.function.name")
    return samples.groupBy(*by).agg(F.count("*").alias("num_samples"), F.hll_sketch_agg(tool, F.lit(SKETCH_BITS)).alias("tools"))


def merge_profiles(parts: DataFrame, *by: str) -> DataFrame:
    """Profiles of parts, such as those of files, as coarser ones; again profiles that can be merged."""
    return parts.groupBy(*by).agg(F.sum("num_samples").alias("num_samples"), F.hll_union_agg("tools").alias("tools"))


def profile_of_parts(parts: DataFrame) -> DataFrame:
    """:func:`dataset_profile` from the profiles of its parts; ``num_tools`` is an estimate.

    Its relative standard error is 1.04 / 2^(SKETCH_BITS / 2), 0.8 percent; small numbers are exact.
    """
    whole = merge_profiles(parts).select(F.coalesce("num_samples", F.lit(0)).alias("num_samples"), F.coalesce(F.hll_sketch_estimate("tools"), F.lit(0)).alias("num_tools"))
    return whole.withColumn("size_category", size_category(F.col("num_samples")))


def size_category(n: Column) -> Column:
    """Size bucket in the notation of dataset cards; a power of ten opens its bucket."""
    steps = ["1K", "10K", "100K", "1M", "10M", "100M", "1B", "10B", "100B", "1T"]
    bucket = F.when(n < 1000, f"n<{steps[0]}")
    for i in range(1, len(steps)):
        bucket = bucket.when(n < 10 ** (3 + i), f"{steps[i - 1]}<n<{steps[i]}")
    return bucket.otherwise(f"n>{steps[-1]}")
