import re

import pytest
from pyspark.sql import functions as F

from toolloom import fixed_values as fixed
from toolloom.functions.chat import system_prompt
from toolloom.functions import sql
from toolloom.functions.text import clean_text, render_prompt, strip

CASES = [
    ("<p>Hello <b>World</b></p>", "Hello World"),
    ("Hello    World\n\nTest", "Hello World Test"),
    (None, ""),
    ("", ""),
    ("<>a>", ""),
    ("a < b > c", "a c"),
    ("<>", "<>"),
    ("&amp; stays", "&amp; stays"),
    ("<a\nhref='x'>y</a>", "y"),
    ("<<b>>", "<>"),
]


@pytest.mark.parametrize("text, cleaned", CASES)
def test_clean_text(spark, text, cleaned):
    row = spark.createDataFrame([(text,)], "t string").select(clean_text("t")).first()
    assert row[0] == cleaned


def test_whitespace_is_pythons(spark):
    texts = [f"{chr(c)}a{chr(c)}{chr(c)} b {chr(c)}c{chr(c)}" for c in [*range(0x21), 0x7F, 0x85, 0xA0, 0x1680, 0x180E, 0x200B, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = rows.select("t", clean_text("t"), strip(F.col("t"))).collect()
    for text, cleaned, stripped in got:
        assert cleaned == re.sub(r"\s+", " ", text).strip()
        assert stripped == text.strip()


def test_templates(spark):
    assert len(fixed.PROMPT_TEMPLATES) == 19
    action = "List {odd} \\1 $2 alerts."
    for template in fixed.PROMPT_TEMPLATES:
        assert "{action}" in template
    rows = spark.createDataFrame([(t,) for t in fixed.PROMPT_TEMPLATES], "t string")
    got = {r[0]: r[1] for r in rows.select("t", render_prompt("t", sql.literal(action))).collect()}
    assert got == {t: t.format(action=action.lower()) for t in fixed.PROMPT_TEMPLATES}


def test_system_prompt_names_the_given_product():
    assert "AI Agent for Acme. Given" in system_prompt("Acme")
