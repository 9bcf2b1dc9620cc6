"""SQL text of literals.

Large expressions are written as SQL: Spark parses one text far faster than
Python builds the same tree call by call.
"""

from __future__ import annotations

from collections.abc import Sequence


def literal(value: str | int) -> str:
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value)


def array(values: Sequence[str | int]) -> str:
    return f"array({', '.join(literal(v) for v in values)})"


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"
