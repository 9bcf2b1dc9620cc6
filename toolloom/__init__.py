"""Spark-native data engine for tool-calling language models."""

import sys

from pyspark import cloudpickle

from toolloom.operators.chat import (
    flag_overlength,
    inference_prompts,
    prompt_column,
    to_messages,
    training_text,
)
from toolloom.operators.evaluate import (
    compare_tool_calls,
    evaluate_dataset,
    evaluate_samples,
    evaluate_single,
    pair_predictions,
    take_first,
)
from toolloom.operators.inference import batch_generate, generate_tool_calls
from toolloom.operators.metrics import (
    card_metrics,
    dataset_profile,
    eval_errors,
    eval_metrics,
    metrics_report,
    metrics_text,
)
from toolloom.operators.requests import (
    filter_requests,
    lookup_tool,
    route_requests,
)
from toolloom.operators.samples import example_args, expand_prompts, generate_samples
from toolloom.operators.spec import (
    filter_has_summary,
    filter_methods,
    filter_namespaces,
    format_tools,
    spec_operations,
)
from toolloom.operators.split import train_test_split

# Functions that run in Python workers travel with the job, so the package does
# not have to be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "batch_generate",
    "card_metrics",
    "compare_tool_calls",
    "dataset_profile",
    "eval_errors",
    "eval_metrics",
    "evaluate_dataset",
    "evaluate_samples",
    "evaluate_single",
    "example_args",
    "expand_prompts",
    "filter_has_summary",
    "filter_methods",
    "filter_namespaces",
    "filter_requests",
    "flag_overlength",
    "format_tools",
    "generate_samples",
    "generate_tool_calls",
    "inference_prompts",
    "lookup_tool",
    "metrics_report",
    "metrics_text",
    "pair_predictions",
    "prompt_column",
    "route_requests",
    "spec_operations",
    "take_first",
    "to_messages",
    "train_test_split",
    "training_text",
]
