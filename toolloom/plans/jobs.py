"""The stages end to end, from files to files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolloom import fixed_values as fixed
from toolloom.functions import chat
from toolloom.operators.chat import flag_overlength, prompt_column, training_text
from toolloom.operators.evaluate import evaluate_samples
from toolloom.operators.inference import batch_generate
from toolloom.operators.samples import generate_samples
from toolloom.operators.split import train_test_split
from toolloom.sources.reports import write_eval_report
from toolloom.sources.samples import read_samples, write_samples
from toolloom.sources.specs import read_specs


def harvest(
    spark: SparkSession,
    spec_path: str | list[str],
    out_path: str,
    fmt: str = "json",
    templates: Sequence[str] = fixed.PROMPT_TEMPLATES,
    namespaces: Sequence[str] | None = None,
    seed: int = 42,
) -> str:
    """Spec files to samples as JSON lines; returns where they are."""
    specs = read_specs(spark, spec_path, fmt)
    return write_samples(generate_samples(specs, templates, namespaces, seed), out_path)


def prepare_training(
    spark: SparkSession,
    sample_path: str,
    out_path: str,
    test_size: float = fixed.TEST_SIZE,
    seed: int = fixed.SPLIT_SEED,
    mode: str = "hash",
    system: str | None = None,
    style: chat.ChatStyle = chat.CHATML,
    max_tokens: int = fixed.MAX_SEQ_LENGTH,
) -> str:
    """Samples to chat texts with their split, as parquet partitioned by ``split``."""
    split = train_test_split(read_samples(spark, sample_path), "sample_id", test_size, seed, mode)
    texts = flag_overlength(training_text(split, system, style), max_tokens=max_tokens)
    texts.select("sample_id", "text", "n_tokens", "over_length", "split").write.mode("overwrite").partitionBy(
        "split"
    ).parquet(out_path)
    return out_path


def evaluate_file(
    spark: SparkSession,
    sample_path: str,
    make_predictor: Callable,
    report_path: str,
    max_samples: int | None = None,
    system: str | None = None,
    style: chat.ChatStyle = chat.CHATML,
    **options,
) -> DataFrame:
    """Samples through the predictor to a report; returns the metrics row."""
    samples = read_samples(spark, sample_path, first=max_samples)
    prompted = samples.withColumn("prompt", prompt_column(F.col("instruction"), F.col("input"), system, style))
    answered = batch_generate(prompted, make_predictor, **options)
    results = evaluate_samples(answered.withColumnRenamed("output", "expected").drop("prompt", "input"))
    return write_eval_report(results, report_path)
