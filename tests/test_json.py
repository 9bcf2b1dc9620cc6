import json

import pytest
from pyspark.sql import functions as F

from toolloom.functions import jsonx

TEXTS = [
    '{"name": "test"}', '{"name": "test", "nested": {"key": "value"}}', '{"array": [1, 2, 3]}', "null", "true", "123",
    '"string"', '{"incomplete": ', "not json at all", '{"trailing": "comma",}', "", "  ", ' {"a":1}\n', '{"a":1} x',
    "1 2", "1,2", "1] x", "1} x", '1,"w":2', "]", "}", "{}{}", "1],[2", "NaN", "-Infinity", "Infinity", "-NaN", "+NaN",
    "+Infinity", "+INF", "-INF", "INF", '{"a":NaN}', '{"a":-INF}', "{'a':1}", "{a:1}", '{"a":1,"a":2}', '"a\tb"',
    '"a\nb"', "1e999", "1" * 50, "1" * 1500, "﻿{}", "01", "1.", "-0", "[1,]", '"INF +Infinity"', '"\\x"', '"a\\',
    "/*c*/1", "+1", ".5", "-", "1e", '"\\ud800"', "[1,2", '"\x7f"', "tru", "nullx", "null x", "1,", '"\\u12"',
    "[" * 500 + "]" * 500, "1E+5", "--1", "-01", '"é"', " 1", "\x0c1", '{"x":{"k":1,"k":[2]}}', '{"a":"+INF","b":1}',
    '{"a":"\\"+INF"}',
]


def test_is_valid_json_is_pythons_verdict(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = {r.t: r.v for r in rows.select("t", jsonx.is_valid_json(F.col("t")).alias("v")).collect()}

    def python(text):
        try:
            json.loads(text)
        except json.JSONDecodeError:
            return False
        return True

    assert {t: got[t] for t in TEXTS} == {t: python(t) for t in TEXTS}


def test_texts_of_any_depth(spark):
    deep = lambda n, inner="", more=0: "[" * n + inner + "]" * (n + more)
    objects = lambda n: '{"a":' * n + "1" + "}" * n
    valid = [deep(n) for n in (997, 998, 999, 1000, 1001, 1200, 50_000)] + [objects(n) for n in (998, 1000, 50_000)]
    valid += [deep(1200, '"]}+INF", NaN, {"k": -1e5}'), f' {{"a": {deep(3000)}, "b": [{objects(2000)}]}}\n']
    wrong = [deep(1200, "", 1), deep(1200, "", -1), deep(1200) + " x", deep(1200, "'a'"), deep(1200, "+INF"), deep(1200, "1 2"), "]" * 1200]
    wrong += [deep(1200) + tail for tail in (',"mark":1', ",1", "],[1", "},{", ',"element":[1')] + ["[" * 1200, "," + deep(1200), deep(50_000, "", 1)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(valid + wrong)], "i int, t string")
    got = {r.i: r.v for r in rows.select("i", jsonx.is_valid_json(F.col("t")).alias("v")).collect()}
    assert [i for i in got if got[i] != (i < len(valid))] == []
    strict = rows.where(f"i = {len(valid) - 2}").select(jsonx.is_valid_json(F.col("t"), "strict").alias("v")).first()
    assert strict.v is False  # NaN, far down


def test_null_text_is_not_valid(spark):
    assert spark.sql("select cast(null as string) t").select(jsonx.is_valid_json(F.col("t"))).first()[0] is False


def test_strict_mode_refuses_nan_only(spark):
    rows = spark.createDataFrame([(t,) for t in ['{"a":NaN}', "Infinity", '{"a":1,"a":2}', "[1]"]], "t string")
    assert [r[0] for r in rows.select(jsonx.is_valid_json(F.col("t"), "strict")).collect()] == [False, False, True, True]
    with pytest.raises(ValueError):
        jsonx.is_valid_json(F.col("t"), "other")


def test_parse_response_keeps_raw_text_and_last_of_repeated_keys(spark):
    jsonx.keep_last_of_repeated_keys(spark)
    rows = spark.createDataFrame([(' {"a": {"k": 1, "k": 2}}\n',), (" no json ",), ('{"a":1} x',)], "t string")
    got = rows.select(jsonx.parse_response(F.col("t")).alias("r")).select(F.to_json("r.parsed"), "r.raw").collect()
    assert [tuple(r) for r in got] == [
        ('{"a":{"k":2}}', '{"a": {"k": 1, "k": 2}}'),
        (None, "no json"),
        (None, '{"a":1} x'),
    ]


def test_quote_is_pythons_dumps(spark):
    texts = ["plain", 'a "b" \\ c', "é 😀  ", "\n\r\t\b\f\x01\x1f\x7f", "", "/</"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: r[1] for r in rows.select("t", F.expr(jsonx.quote("t"))).collect()} == {t: json.dumps(t) for t in texts}
