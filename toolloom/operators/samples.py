"""Training samples from tool definitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom import fixed_values as fixed
from toolloom.functions import sql
from toolloom.functions.args import RULES, Rule, example_args_json
from toolloom.functions.text import render_prompt
from toolloom.functions.tools import call
from toolloom.operators.spec import LARGE_SPEC, filter_has_summary, format_tools, spec_operations

SAMPLE_COLUMNS = ["instruction", "input", "output"]
OPERATION_KEY = "concat_ws(' ', method, path)"
# Where a sample comes from, in the order of the documents.
SAMPLE_ORDER = ["spec_id", "path_pos", "method_pos", "template_id"]


def example_args(tools: DataFrame, seed: int = 42, rules: Sequence[Rule] = RULES, key: str = OPERATION_KEY) -> DataFrame:
    """Add ``arguments``, JSON text with one example value per property.

    The choice hangs on the seed, the operation and the parameter name only, not
    on the file that the operation comes from. ``key`` is SQL of what tells
    operations apart.
    """
    made = example_args_json("properties", key, seed, rules)
    return tools.selectExpr("*", f"{made} AS arguments")


def expand_prompts(df: DataFrame, templates: Sequence[str] = fixed.PROMPT_TEMPLATES, summary: str = "summary") -> DataFrame:
    """Every row with every template: adds ``template_id`` and ``instruction``."""
    exploded = df.select("*", F.posexplode(F.expr(sql.array(templates))).alias("template_id", "_template"))
    return exploded.withColumn("instruction", render_prompt("_template", sql.name(summary))).drop("_template")


def generate_samples(
    specs: DataFrame,
    templates: Sequence[str] = fixed.PROMPT_TEMPLATES,
    namespaces: Sequence[str] | DataFrame | None = None,
    seed: int = 42,
    rules: Sequence[Rule] = RULES,
    spread: int | None = LARGE_SPEC,
) -> DataFrame:
    """Samples of every kept operation of every spec, in one lazy plan.

    Adds ``sample_id``, a key made of where the sample comes from.
    """
    operations = filter_has_summary(spec_operations(specs, namespaces, spread=spread))
    # Definition and arguments are the same for all prompts of an operation, so
    # both are text before the rows multiply.
    tools = example_args(format_tools(operations), seed, rules)
    texts = tools.select(
        "spec_id",
        "path_pos",
        "method_pos",
        "tool_name",
        # With a summary there, the description is the cleaned summary.
        F.col("description").alias("summary"),
        "input",
        F.expr(call("tool_name", "arguments")).alias("output"),
    )
    return expand_prompts(texts, templates).select(
        F.concat_ws("/", "spec_id", "path_pos", "method_pos", "template_id").alias("sample_id"),
        "spec_id",
        "path_pos",
        "method_pos",
        "template_id",
        *SAMPLE_COLUMNS,
    )
