"""Chat messages and their rendering."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from toolloom import fixed_values as fixed


@dataclass(frozen=True)
class ChatStyle:
    """Role markers of a chat format.

    ``open`` and ``close`` surround a message; ``{role}`` in ``open`` is the
    role. ``begin`` comes first. The generation prompt is ``open`` for the
    assistant.
    """

    open: str
    close: str
    begin: str = ""


CHATML = ChatStyle(open="<|im_start|>{role}\n", close="<|im_end|>\n")


def system_prompt(product: str = fixed.DEFAULT_PRODUCT) -> str:
    return fixed.SYSTEM_PROMPT.format(product=product)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def user_content(instruction: Column, tool: Column) -> Column:
    head, rest = fixed.USER_MESSAGE.split("{instruction}")
    middle, tail = rest.split("{tool}")
    return F.concat(F.lit(head), instruction, F.lit(middle), tool, F.lit(tail))


def messages(instruction: Column, tool: Column, answer: Column | None = None, system: str | None = None) -> Column:
    """ARRAY<STRUCT<role, content>>: system, user and, for training, assistant."""
    turns = [
        message("system", F.lit(system_prompt() if system is None else system)),
        message("user", user_content(instruction, tool)),
    ]
    if answer is not None:
        turns.append(message("assistant", answer))
    return F.array(*turns)


def render_chat(turns: Column, style: ChatStyle = CHATML, add_generation_prompt: bool = False) -> Column:
    """One string from a message array."""
    before, after = style.open.split("{role}")

    def block(turn: Column) -> Column:
        return F.concat(F.lit(before), turn["role"], F.lit(after), turn["content"], F.lit(style.close))

    text = F.concat(F.lit(style.begin), F.array_join(F.transform(turns, block), ""))
    if add_generation_prompt:
        text = F.concat(text, F.lit(style.open.replace("{role}", "assistant")))
    return text
