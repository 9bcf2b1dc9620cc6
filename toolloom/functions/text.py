"""Text clean-up and prompt rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from toolloom.functions import sql

# Java's \s is ASCII only; this class is what Python's str methods and regular
# expressions call whitespace.
SPACE_CLASS = r"\p{IsWhite_Space}\x1c-\x1f"
SPACE_CHARS = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    )
)
# Every run of whitespace except a lone blank, which is already what it becomes.
_RUN = rf" [{SPACE_CLASS}]+|[{SPACE_CLASS}&&[^ ]][{SPACE_CLASS}]*"


def strip(col: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def clean_text_sql(text: str) -> str:
    """SQL that drops tags, turns whitespace runs into one blank and strips; NULL becomes ''."""
    untagged = f"regexp_replace(coalesce({text}, ''), '<[^<]+?>', '')"
    return f"trim(regexp_replace({untagged}, {sql.literal(_RUN)}, ' '))"


def clean_text(column: str) -> Column:
    return F.expr(clean_text_sql(column))


def render_prompt(template: str, summary: str) -> Column:
    """Fill the ``{action}`` hole with the lower-cased summary."""
    return F.expr(f"replace({template}, '{{action}}', lower({summary}))")
