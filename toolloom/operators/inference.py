"""Batch inference with a predictor the caller brings."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toolloom import fixed_values as fixed
from toolloom import schemas
from toolloom.functions import jsonx

# predict(prompts, max_new_tokens, temperature) -> [(text, number of new tokens)]
Predictor = Callable[[list[str], int, float], list[tuple[str, int]]]


def batch_generate(
    df: DataFrame,
    make_predictor: Callable[[], Predictor],
    prompt: str = "prompt",
    max_new_tokens: int = fixed.MAX_NEW_TOKENS,
    temperature: float = fixed.TEMPERATURE,
    batch_size: int = 64,
    spread: int | None = None,
) -> DataFrame:
    """Add ``generated``, ``inference_time``, ``num_tokens``, ``error`` and ``error_message``.

    ``make_predictor`` runs once per task, in the Python worker. When a batch
    fails its prompts are tried one by one, so an exception costs only its own
    row. A row's time is that of its batch divided by the rows of the batch.
    ``spread`` deals rows out to that many tasks first. Predictions cost a lot
    and may differ between runs: write them before using them twice.
    """
    added = T._parse_datatype_string(schemas.GENERATED)
    output = T.StructType([*[f for f in df.schema if f.name not in added.names], *added.fields])
    kept = [c for c in df.columns if c not in added.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = make_predictor()
        for whole in batches:
            for start in range(0, whole.num_rows, batch_size):
                part = whole.slice(start, batch_size)
                prompts = part.column(part.schema.get_field_index(prompt)).to_pylist()
                rows = _predict(predict, prompts, max_new_tokens, temperature)
                columns = [part.column(part.schema.get_field_index(c)) for c in kept]
                text, seconds, tokens, errors, messages = zip(*rows)
                columns += [
                    pa.array(text, pa.string()),
                    pa.array(seconds, pa.float64()),
                    pa.array(tokens, pa.int64()),
                    pa.array(errors, pa.string()),
                    pa.array(messages, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=output.names)

    source = df.repartition(spread) if spread else df
    return source.mapInArrow(run, output)


def _predict(predict: Predictor, prompts: list, max_new_tokens: int, temperature: float) -> list[tuple]:
    given = [p for p in prompts if p is not None]
    started = time.perf_counter()
    try:
        answers = iter([(t, n, None) for t, n in predict(given, max_new_tokens, temperature)] if given else [])
        done = [next(answers) if p is not None else (None, 0, "missing_prompt") for p in prompts]
        each = (time.perf_counter() - started) / max(len(given), 1)
        return [
            (None, 0.0, 0, error, None) if error else (text.strip(), each, int(n), None, None) for text, n, error in done
        ]
    except Exception as failure:  # noqa: BLE001 - a failing model is a result here
        if len(prompts) > 1:
            return [r for p in prompts for r in _predict(predict, [p], max_new_tokens, temperature)]
        return [(None, 0.0, 0, "generation_failed", str(failure))]


def read_ledger(spark: SparkSession, path: str, key: str = "sample_id") -> DataFrame:
    """One row for each key of a ledger, the one written last, without ``turn``."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c not in (key, "turn")]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*columns), "turn").alias("_last"))
    return last.select(key, *[F.col(f"_last.{c}") for c in columns])


def generate_resumable(
    df: DataFrame,
    make_predictor: Callable[[], Predictor],
    path: str,
    key: str = "sample_id",
    rounds: int = 16,
    retry_errors: bool = False,
    **options,
) -> DataFrame:
    """:func:`batch_generate` with a ledger at ``path``: a run that is stopped goes on where it was.

    The rows are dealt into ``rounds`` by a hash of their key, and what a round has
    predicted is appended when it ends. A later run leaves out the keys of the ledger
    (an anti join) and so repeats the unfinished round at most; with ``retry_errors``
    keys that have only errors are tried again. New rows in ``df`` are predicted, rows no longer in it stay in
    the ledger but are not returned. Returns :func:`read_ledger` for the keys of ``df``; rows without a key are left out.
    """
    spark, turn, ledger = df.sparkSession, 0, None
    keyed = df.where(F.col(key).isNotNull())
    try:
        ledger = spark.read.parquet(path)
        turn = 1 + (ledger.agg(F.max("turn")).first()[0] or 0)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    if ledger is not None:
        finished = ledger.where("error is null") if retry_errors else ledger
        keyed = keyed.join(finished.select(key), key, "left_anti")
    for number in range(rounds):
        mine = keyed.where(F.pmod(F.xxhash64(F.lit(17), key), F.lit(rounds)) == number)
        answered = batch_generate(mine, make_predictor, **options).withColumn("turn", F.lit(turn))
        answered.write.mode("append").parquet(path)
    return read_ledger(spark, path, key).join(df.select(key), key, "left_semi")


def generate_tool_calls(df: DataFrame, make_predictor: Callable[[], Predictor], **options) -> DataFrame:
    """:func:`batch_generate`, then ``parsed`` (VARIANT, NULL when not JSON)."""
    jsonx.keep_last_of_repeated_keys(df.sparkSession)
    answered = batch_generate(df, make_predictor, **options)
    return answered.withColumn("_all", jsonx.parsed_array(F.col("generated"))).select(
        *answered.columns, jsonx.whole_value(F.col("_all"), F.col("generated")).alias("parsed")
    )
