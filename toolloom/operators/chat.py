"""Chat formatting of samples and requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolloom import fixed_values as fixed
from toolloom.functions import chat
from toolloom.functions.text import SPACE_CLASS

# Words of any script, and single characters that are neither word nor whitespace.
_WORD = r"\p{L}\p{M}\p{N}_"
TOKEN_PATTERN = rf"[{_WORD}]+|[^{_WORD}{SPACE_CLASS}]"


def to_messages(df: DataFrame, system: str | None = None, with_answer: bool = True) -> DataFrame:
    """Add ``messages`` to rows with ``instruction``, ``input`` and, for training, ``output``."""
    answer = F.col("output") if with_answer else None
    return df.withColumn("messages", chat.messages(F.col("instruction"), F.col("input"), answer, system))


def training_text(df: DataFrame, system: str | None = None, style: chat.ChatStyle = chat.CHATML) -> DataFrame:
    """Add ``text``, the rendered training conversation."""
    turns = chat.messages(F.col("instruction"), F.col("input"), F.col("output"), system)
    return df.withColumn("text", chat.render_chat(turns, style))


def prompt_column(instruction: Column, tool: Column, system: str | None = None, style: chat.ChatStyle = chat.CHATML) -> Column:
    """Rendered prompt, up to where the model starts to answer."""
    return chat.render_chat(chat.messages(instruction, tool, None, system), style, add_generation_prompt=True)


def inference_prompts(
    df: DataFrame,
    instruction: str = "instruction",
    tool: str | None = "tool",
    tools: str | None = None,
    system: str | None = None,
    style: chat.ChatStyle = chat.CHATML,
) -> DataFrame:
    """Add ``tool_text``, ``status`` and ``prompt``.

    ``tool`` wins over ``tools``. Text passes unchanged, anything structured
    becomes JSON. A row with neither has status ``missing_tool`` and no prompt.
    """
    if tool is None and tools is None:
        raise ValueError("give a tool column, a tools column or both")
    given = [_as_text(df, c) for c in (tool, tools) if c is not None]
    text = df.withColumn("tool_text", F.coalesce(*given))
    has_tool = F.col("tool_text").isNotNull()
    return text.withColumn("status", F.when(has_tool, "ok").otherwise("missing_tool")).withColumn(
        "prompt",
        F.when(has_tool, prompt_column(F.col(instruction), F.col("tool_text"), system, style)),
    )


def _as_text(df: DataFrame, name: str) -> Column:
    is_text = df.schema[name].dataType.typeName() == "string"
    return F.col(name) if is_text else F.to_json(F.col(name))


def flag_overlength(
    df: DataFrame,
    text: str = "text",
    max_tokens: int = fixed.MAX_SEQ_LENGTH,
    count: Column | None = None,
) -> DataFrame:
    """Add ``n_tokens`` and ``over_length``.

    ``count`` is the number of tokens of a model's own tokenizer, for example a
    pandas UDF over the text; without it words and marks are counted.
    """
    tokens = F.regexp_count(F.col(text), F.lit(TOKEN_PATTERN)) if count is None else count
    return df.withColumn("n_tokens", tokens).withColumn("over_length", F.col("n_tokens") > max_tokens)


def conversations_to_text(
    turns: DataFrame,
    style: chat.ChatStyle = chat.CHATML,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``(conversation, n_turns, text)``: the turns of each conversation in order, rendered.

    One shuffle by conversation, whose turns are sorted inside its own row. Turns
    without a number come first, those without a text are empty.
    """
    message = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("content"))
    ordered = turns.groupBy(conversation).agg(F.sort_array(F.collect_list(message)).alias("_turns"))
    messages = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return ordered.select(
        conversation, F.size("_turns").cast("bigint").alias("n_turns"), chat.render_chat(messages, style).alias("text")
    )
