"""The registered queries: each reads whole tables under ``sf_dir``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolloom.functions import jsonx
from toolloom.functions.routing import route_tool
from toolloom.functions.text import clean_text
from toolloom.operators import chat, evaluate, inference, metrics, patterns, requests, samples, spec
from toolloom.operators.split import train_test_split
from toolloom.plans import derived
from toolloom.sources.catalogue import default_catalogue
from toolloom.sources.scratch import scratch_folder
from toolloom.streaming.evaluation import stream_metrics
from toolloom.streaming.requests import write_stream

_OPERATION_KEYS = ["spec_id", "path_pos", "path", "method_pos", "method"]


def _clean_text(spark: SparkSession, d: str) -> DataFrame:
    return derived.read(spark, d, "pages").select("page_id", clean_text("html").alias("cleaned"))


def _clean_documents(spark: SparkSession, d: str) -> DataFrame:
    return derived.read(spark, d, "documents").select("doc_id", clean_text("text").alias("cleaned"))


def _operations(spark: SparkSession, d: str, namespaces: list[str] | None = None) -> DataFrame:
    return spec.spec_operations(derived.specs(spark, d), namespaces)


def _spec_operations(spark: SparkSession, d: str) -> DataFrame:
    return _operations(spark, d, []).select(
        *_OPERATION_KEYS,
        F.col("op.operationId").alias("operation_id"),
        F.col("op.summary").alias("summary"),
        F.size("op.parameters").cast("bigint").alias("n_parameters"),
        F.col("op.requestBody").isNotNull().alias("has_body"),
    )


def _spec_rejects(spark: SparkSession, d: str) -> DataFrame:
    return spec.spec_rejects(derived.flawed_specs(spark, d))


def _filter_operations(spark: SparkSession, d: str) -> DataFrame:
    return spec.filter_has_summary(_operations(spark, d)).select(*_OPERATION_KEYS)


def _format_tools(spark: SparkSession, d: str) -> DataFrame:
    tools = spec.format_tools(spec.filter_has_summary(_operations(spark, d)))
    return tools.select("spec_id", "path", "tool_name", "description", "input")


def _example_args(spark: SparkSession, d: str) -> DataFrame:
    tools = samples.example_args(spec.format_tools(_operations(spark, d, [])))
    return tools.select("spec_id", "path", "method", "arguments")


def _generate_samples(spark: SparkSession, d: str) -> DataFrame:
    made = samples.generate_samples(derived.specs(spark, d))
    return made.select("sample_id", "instruction", "input", "output")


def _split_hash(spark: SparkSession, d: str) -> DataFrame:
    rows = derived.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return train_test_split(rows, ["l_orderkey", "l_linenumber"])


def _split_exact(spark: SparkSession, d: str) -> DataFrame:
    return train_test_split(derived.read(spark, d, "orders").select("o_orderkey"), "o_orderkey", mode="exact")


def _split_grouped(mode: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, d: str) -> DataFrame:
        rows = derived.read(spark, d, "orders").select("o_orderkey", "o_custkey")
        return train_test_split(rows, "o_orderkey", mode=mode, group_by="o_custkey").select("o_orderkey", "split")

    return query


def _take_first_samples(spark: SparkSession, d: str) -> DataFrame:
    made = samples.generate_samples(derived.specs(spark, d))
    return evaluate.take_first(made, 300, samples.SAMPLE_ORDER).select("sample_id")


def _take_first(spark: SparkSession, d: str) -> DataFrame:
    pairs = derived.pairs(spark, d).select("sample_id", "instruction", "expected")
    return evaluate.take_first(pairs, 500, "sample_id")


def _take_first_half(spark: SparkSession, d: str) -> DataFrame:
    rows = derived.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return evaluate.take_first(rows, rows.count() // 2, ["l_orderkey", "l_linenumber"])


def _namespace_matches(spark: SparkSession, d: str) -> DataFrame:
    paths = spec.spec_paths(derived.specs(spark, d))
    return patterns.match_patterns(paths, derived.namespaces(spark, d))


def _filter_namespace_table(spark: SparkSession, d: str) -> DataFrame:
    wanted = derived.namespaces(spark, d).where("part_id % 50 <> 0")
    return spec.spec_operations(derived.specs(spark, d), wanted).select(*_OPERATION_KEYS)


def _catalogued_samples(spark: SparkSession, d: str) -> DataFrame:
    """Routed requests as samples with an answer made of the tool's key."""
    routed = requests.route_requests(derived.requests(spark, d), default_catalogue(spark))
    return routed.select(
        "request_id",
        F.col("request").alias("instruction"),
        F.col("definition").alias("input"),
        F.concat(F.lit('{"name": "'), "tool_key", F.lit('", "arguments": {}}')).alias("output"),
    )


def _chat_messages(spark: SparkSession, d: str) -> DataFrame:
    turns = chat.to_messages(_catalogued_samples(spark, d)).select("request_id", F.posexplode("messages"))
    return turns.select(
        "request_id",
        F.col("pos").cast("bigint").alias("position"),
        F.col("col.role").alias("role"),
        F.col("col.content").alias("content"),
    )


def _training_text(spark: SparkSession, d: str) -> DataFrame:
    texts = chat.training_text(_catalogued_samples(spark, d))
    return train_test_split(texts, "request_id").select("request_id", "text", "split")


def _inference_prompts(spark: SparkSession, d: str) -> DataFrame:
    """One tool, several tools or none, by request."""
    case = F.col("request_id") % 3
    rows = derived.requests(spark, d).select(
        "request_id",
        F.col("request").alias("instruction"),
        F.when(case == 0, F.lit('{"name": "one"}')).alias("tool"),
        F.when(case < 2, F.array(F.struct(F.lit("a").alias("name")), F.struct(F.lit("b").alias("name")))).alias("tools"),
    )
    prompted = chat.inference_prompts(rows, tool="tool", tools="tools")
    return prompted.select("request_id", "tool_text", "status", "prompt")


def _flag_overlength(spark: SparkSession, d: str) -> DataFrame:
    flagged = chat.flag_overlength(derived.read(spark, d, "documents").select("doc_id", "text"))
    return flagged.select("doc_id", F.col("n_tokens").cast("bigint").alias("n_tokens"), "over_length")


def _conversations_to_text(spark: SparkSession, d: str) -> DataFrame:
    return chat.conversations_to_text(derived.read(spark, d, "conversations"))


def _filter_requests(spark: SparkSession, d: str) -> DataFrame:
    return requests.filter_requests(derived.requests(spark, d))


def _route_tool(spark: SparkSession, d: str) -> DataFrame:
    return derived.requests(spark, d).select("request_id", route_tool(F.col("request")).alias("tool_key"))


def _lookup_tool(spark: SparkSession, d: str) -> DataFrame:
    """Requests with a tool chosen beforehand; every seventh names one that is not there."""
    key = F.when(F.col("request_id") % 7 == 0, "no_such_tool").otherwise(route_tool(F.col("request")))
    found = requests.lookup_tool(derived.requests(spark, d).withColumn("tool_key", key), default_catalogue(spark))
    return found.select(
        "request_id", "tool_key", F.get_json_object("definition", "$.function.name").alias("name"), "status"
    )


def _route_requests(spark: SparkSession, d: str) -> DataFrame:
    routed = requests.route_requests(derived.requests(spark, d), default_catalogue(spark))
    return routed.select("request_id", "tool_key", "status", "prompt")


def _json_validity(spark: SparkSession, d: str) -> DataFrame:
    valid = {m: jsonx.is_valid_json(F.col("generated"), m) for m in ("python", "strict")}
    return derived.pairs(spark, d).select("sample_id", *[c.alias(f"valid_{m}") for m, c in valid.items()])


def _parse_response(spark: SparkSession, d: str) -> DataFrame:
    jsonx.keep_last_of_repeated_keys(spark)
    response = derived.pairs(spark, d).select("sample_id", jsonx.parse_response(F.col("generated")).alias("response"))
    parsed = F.col("response.parsed")
    return response.select(
        "sample_id",
        jsonx.variant_kind(parsed).alias("kind"),
        F.try_variant_get(parsed, "$.name", "string").alias("name"),
        F.col("response.raw").alias("raw"),
    )


def _compare_calls(spark: SparkSession, d: str) -> DataFrame:
    compared = evaluate.compare_tool_calls(derived.pairs(spark, d))
    return compared.select("sample_id", "name_matches", "arguments_match", "compare_error")


def _results(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.evaluate_samples(derived.pairs(spark, d))


def _evaluate_samples(spark: SparkSession, d: str) -> DataFrame:
    return _results(spark, d).select("sample_id", "is_valid_json", "name_correct", "arguments_correct", "error")


def _pair_predictions(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.pair_predictions(*derived.samples_and_predictions(spark, d)).select(
        "sample_id", "expected", "generated", "error"
    )


def _evaluate_dataset(spark: SparkSession, d: str) -> DataFrame:
    results = evaluate.evaluate_dataset(*derived.samples_and_predictions(spark, d))
    return metrics.eval_metrics(results)


def _eval_metrics(spark: SparkSession, d: str) -> DataFrame:
    return metrics.eval_metrics(_results(spark, d))


def _metrics_by_tool(spark: SparkSession, d: str) -> DataFrame:
    named = _results(spark, d).withColumn("tool", F.get_json_object("expected", "$.name"))
    return metrics.metrics_by(named, "tool").drop("level")


def _timed_results(events: DataFrame) -> DataFrame:
    return evaluate.evaluate_samples(derived.timed_pairs(events)).withColumn("tool", F.get_json_object("expected", "$.name"))


def _metrics_by_window(spark: SparkSession, d: str) -> DataFrame:
    return metrics.metrics_by_window(_timed_results(derived.read(spark, d, "events")), "ts", "6 hours", by=["tool"])


def _metrics_sliding(spark: SparkSession, d: str) -> DataFrame:
    return metrics.metrics_by_window(_timed_results(derived.read(spark, d, "events")), "ts", "1 day", "6 hours")


def _stream_metrics(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream, run until all is read; windows that the watermark has not passed are still open and not there."""
    schema = derived.read(spark, d, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]")  # a stream's path may be one file only as a pattern
    timed = _timed_results(events).withColumn("ts", F.col("ts").cast("timestamp"))
    rows = stream_metrics(timed, "ts", "6 hours", late="1 day", by=["tool"])
    folder = scratch_folder(spark)
    write_stream(rows, f"{folder}/rows", f"{folder}/progress", availableNow=True).awaitTermination()
    closed = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    return closed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def _metrics_report(spark: SparkSession, d: str) -> DataFrame:
    return metrics.metrics_report(_eval_metrics(spark, d))


def _metrics_text(spark: SparkSession, d: str) -> DataFrame:
    return metrics.metrics_text(_eval_metrics(spark, d)).select("text")


def _card_metrics(spark: SparkSession, d: str) -> DataFrame:
    return metrics.card_metrics(_eval_metrics(spark, d))


def _eval_errors(spark: SparkSession, d: str) -> DataFrame:
    return metrics.eval_errors(_results(spark, d))


def _dataset_profile(spark: SparkSession, d: str) -> DataFrame:
    return metrics.dataset_profile(samples.generate_samples(derived.specs(spark, d)))


def _dataset_profile_merged(spark: SparkSession, d: str) -> DataFrame:
    """From profiles of 16 parts; the estimate is held against the exact number, which it may miss by 4 percent."""
    parts = F.pmod(F.xxhash64("spec_id"), F.lit(16)).alias("part")
    made = samples.generate_samples(derived.specs(spark, d)).select("*", parts)
    merged = metrics.profile_of_parts(metrics.profile_parts(made, "part"))
    exact = metrics.dataset_profile(made).select(F.col("num_tools").alias("exact"))
    near = (F.abs(F.col("num_tools") - F.col("exact")) <= F.lit(0.04) * F.col("exact")).alias("num_tools_near")
    return merged.join(F.broadcast(exact)).select("num_samples", "size_category", near)  # one row each


def stub_predictor() -> inference.Predictor:
    """Answers a prompt with its length; refuses some, to show that rows fail alone."""

    def predict(prompts: list[str], max_new_tokens: int, temperature: float) -> list[tuple[str, int]]:
        if any(len(p) % 10 == 3 for p in prompts):
            raise ValueError("refused")
        return [(f' {{"chars": {len(p)}}}\n' if len(p) % 2 else f"chars: {len(p)} ", len(p) % 7) for p in prompts]

    return predict


def _generate_tool_calls(spark: SparkSession, d: str) -> DataFrame:
    prompts = derived.read(spark, d, "documents").select("doc_id", F.col("text").alias("prompt"))
    answered = inference.generate_tool_calls(prompts, stub_predictor)
    return answered.select(
        "doc_id", "generated", "num_tokens", "error", "error_message", F.try_variant_get("parsed", "$.chars", "bigint").alias("chars")
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "clean_text_pages": _clean_text,
        "clean_text_documents": _clean_documents,
        "spec_operations": _spec_operations,
        "spec_rejects": _spec_rejects,
        "filter_operations": _filter_operations,
        "format_tools": _format_tools,
        "example_args": _example_args,
        "generate_samples": _generate_samples,
        "train_test_split": _split_hash,
        "train_test_split_exact": _split_exact,
        "split_grouped": _split_grouped("hash"),
        "split_grouped_exact": _split_grouped("exact"),
        "take_first": _take_first,
        "take_first_samples": _take_first_samples,
        "chat_messages": _chat_messages,
        "training_text": _training_text,
        "inference_prompts": _inference_prompts,
        "flag_overlength": _flag_overlength,
        "conversations_to_text": _conversations_to_text,
        "filter_requests": _filter_requests,
        "route_tool": _route_tool,
        "lookup_tool": _lookup_tool,
        "route_requests": _route_requests,
        "json_validity": _json_validity,
        "parse_response": _parse_response,
        "compare_calls": _compare_calls,
        "evaluate_samples": _evaluate_samples,
        "pair_predictions": _pair_predictions,
        "evaluate_dataset": _evaluate_dataset,
        "eval_metrics": _eval_metrics,
        "metrics_by_tool": _metrics_by_tool,
        "metrics_report": _metrics_report,
        "metrics_text": _metrics_text,
        "card_metrics": _card_metrics,
        "eval_errors": _eval_errors,
        "dataset_profile": _dataset_profile,
        "generate_tool_calls": _generate_tool_calls,
        "dataset_profile_merged": _dataset_profile_merged,
        "stream_metrics": _stream_metrics,
        "metrics_sliding": _metrics_sliding,
        "metrics_by_window": _metrics_by_window,
        "filter_namespace_table": _filter_namespace_table,
        "namespace_matches": _namespace_matches,
        "take_first_half": _take_first_half,
    }
