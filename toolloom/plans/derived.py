"""Inputs that Spark derives from the given tables, row by row; only the parts are dealt out over the cluster first.

The tables hold no API specs, tool calls or requests of this kind, so each
``part`` row becomes a spec document, each ``events`` row a pair of tool calls
and each user turn of ``conversations`` a request. The lists below are test
vocabulary; the checks use their flat form.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toolloom.functions import sql

BASES = [
    "/security/alerts",
    "/security/incidents",
    "/identityProtection",
    "/beta/auditLogs/signIns",
    "/deviceManagement",
    "/security/cases",
    "/me/messages",
    "/groups",
]
METHODS = ["get", "post", "patch", "delete", "put", "head", "GET"]
PATHS_PER_SPEC = 2
# Parts of a task. A few MB of them are a single split, but minutes of work as documents.
PARTS_PER_TASK = 10_000


def _parameter(spec: dict, name: str = "", kind: str = "string", text: str = "", required: bool = False, used: bool = True, kind_json: str | None = None):
    """A parameter as written in a spec, and what is expected of it."""
    flat = (name, kind, kind_json or json.dumps(kind), json.dumps(text), required, used)
    return json.dumps(spec), flat


def _query(name: str, kind: str, **more):
    return _parameter({"name": name, "in": "query", "schema": {"type": kind}}, name, kind, **more)


PARAMETERS = [
    _parameter(
        {"name": "$filter", "in": "query", "description": "<i>Filter</i>  items\n", "schema": {"type": "string"}},
        "$filter",
        text="Filter items",
    ),
    _query("$select", "string"),
    _query("$top", "integer"),
    _query("$orderby", "string"),
    _query("$expand", "string"),
    _query("$search", "string"),
    _parameter(
        {"name": "alertId", "in": "path", "required": True, "schema": {"type": "string"}}, "alertId", required=True
    ),
    _parameter(
        {"name": "incidentId", "in": "path", "required": True, "schema": {"type": "integer"}},
        "incidentId",
        "integer",
        required=True,
    ),
    _query("userId", "string"),
    _query("hostName", "string"),
    _query("query", "string"),
    _query("timeRange", "string"),
    _query("count", "integer"),
    _query("enabled", "boolean"),
    _query("tags", "array"),
    _query("shape", "object"),
    _parameter(
        {"name": "label", "in": "query", "description": 'é "x" \\ 😀', "schema": {"type": "string"}},
        "label",
        text='é "x" \\ 😀',
    ),
    _parameter(
        {"name": "label", "in": "query", "required": True, "schema": {"type": "array"}}, "label", "array", required=True
    ),
    _parameter({"name": "X-Trace", "in": "header", "schema": {"type": "string"}}, used=False),
    _parameter({"$ref": "#/components/parameters/page"}, used=False),
    _parameter({"name": "bare", "in": "query", "required": False}, "bare"),
    _parameter({"name": "session", "in": "cookie", "required": True}, used=False),
    _parameter(
        {"name": "mode", "in": "query", "schema": {"type": ["string", "null"]}}, "mode", "list", kind_json='["string", "null"]'
    ),
    _parameter(
        {"name": "request_body", "in": "path", "required": True, "schema": {"type": "number"}},
        "request_body",
        "number",
        required=True,
    ),
]
BODIES = ['{"content":{"application/json":{"schema":{}}}}', '{"$ref":"#/b"}', '{"content":{"text/plain":{}}}']


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(rows: DataFrame, per_task: int = PARTS_PER_TASK) -> DataFrame:
    """The rows dealt out evenly, whatever their keys: to as many tasks as they fill, and to every core."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / per_task))
    return rows.repartition(tasks)


def _literals(values: list[str]) -> Column:
    return F.expr(sql.array(values))


def _at(values: list[str], index: Column) -> Column:
    return F.element_at(_literals(values), (index + 1).cast("int"))


def _operation(number: Column, name: Column) -> tuple[Column, Column]:
    """Method and JSON text of one operation."""
    n = len(PARAMETERS)
    method = _at(METHODS, number % 7)
    picks = [number % n, F.floor(number / n) % n, (number * 5 + 16) % n]
    parameters = F.concat_ws(",", *[_at([p for p, _ in PARAMETERS], i) for i in picks])
    title = F.concat(F.when(number % 19 == 0, 'Été \\"x\\" ').otherwise(""), F.lit("<p>List  "), name, F.lit("</p>"))
    summary = F.when(number % 13 == 0, "").when(number % 17 == 0, '"summary":"<b> </b>",').otherwise(
        F.concat(F.lit('"summary":"'), title, F.lit('",'))
    )
    body = F.when(method.isin("post", "patch", "put"), F.concat(F.lit(',"requestBody":'), _at(BODIES, number % 3)))
    text = F.concat(
        F.lit("{"),
        F.when(number % 11 == 0, "").otherwise(F.concat(F.lit('"operationId":"op.'), number, F.lit('",'))),
        summary,
        F.lit('"description":"about it","parameters":['),
        parameters,
        F.lit("]"),
        F.coalesce(body, F.lit("")),
        F.lit("}"),
    )
    return method, text


def specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(spec_id, content)``: one document per part with two paths."""
    part = spread(read(spark, sf_dir, "part").select("p_partkey", "p_name"))
    paths = []
    for slot, other in enumerate(['"parameters":[]', '"summary":"a path"']):
        number = F.col("p_partkey") * PATHS_PER_SPEC + slot
        method, operation = _operation(number, F.col("p_name"))
        path = F.concat(_at(BASES, (F.col("p_partkey") + 3 * slot) % 8), F.lit("/"), number)
        paths.append(
            F.concat(F.lit('"'), path, F.lit('":{' + other + ',"'), method, F.lit('":'), operation, F.lit("}"))
        )
    content = F.concat(F.lit('{"openapi":"3.0.1","paths":{'), paths[0], F.lit(","), paths[1], F.lit("}}"))
    # A generated row: a filter on the text would be pushed below the dealing and build the texts there.
    return part.select(F.col("p_partkey").cast("string").alias("spec_id"), F.inline(F.array(F.struct(content.alias("content")))))


_CALL = '{"name": "@T", "arguments": {"k": @U, "value": @E, "tags": ["a"]}}'

# (generated, expected, valid, name, arguments, error); @T, @U and @E stand for
# the event's type, user and id.
PAIRS = [
    (_CALL, _CALL, True, True, True, None),
    (_CALL.replace("@T", "no_@T"), _CALL, True, False, False, None),
    ('{"name": "@T", "arguments": {"k": @U, "value": @E}}', _CALL, True, True, False, None),
    ('{"name": "@T", "arguments": {"k": @U, "value": @E, "tags": "a"}}', _CALL, True, True, False, None),
    ('{"name": "@T", "arguments": {"k": @U, "value": @E, "tags": [], "more": {}}}', _CALL, True, True, True, None),
    ('{"name": "@T", "arguments": {"k": "@U", "value": null, "tags": ["b"]}}', _CALL, True, True, True, None),
    (_CALL + " and more", _CALL, False, False, False, None),
    ("null", _CALL, True, False, False, None),
    ("[]", _CALL, True, False, False, "not_object"),
    ('{"name": "@T", "arguments": {"k": @U', _CALL, False, False, False, None),
    ('{"name": "@T", "arguments": null}', _CALL, True, False, False, "args_not_container"),
    ('{"name": "@T", "arguments": {"k": NaN, "value": -Infinity, "tags": []}}', _CALL, True, True, True, None),
    ("\n {\"name\":\"@T\",\"arguments\":{\"tags\":[],\"value\":1,\"k\":{\"x\":[@E]}}}\t", _CALL, True, True, True, None),
    ('{"name": "other", "name": "@T", "arguments": {"k": 1, "value": 2, "tags": "a", "tags": [{"x": 1, "x": 2}]}}', _CALL, True, True, True, None),
    ('{"name": "@T"}', _CALL, True, True, False, None),
    ('{"arguments": {"k": 1, "value": 2, "tags": []}}', _CALL, True, False, False, None),
    ('{"name": "@T", "arguments": ["k", "value", "x"]}', _CALL, True, True, False, None),
    ('{"name": "@T", "arguments": ["k", "value", "tags"]}', _CALL, True, False, False, "container_lookup"),
    ('{"name": "@T", "arguments": "k value tags"}', '{"name": "@T", "arguments": {"k": 1, "value": 2}}', True, True, True, None),
    (_CALL, "not JSON @E", True, False, False, None),
    (_CALL, "null", True, False, False, None),
    (_CALL, "[@E]", True, False, False, "expected_not_object"),
    (_CALL, '{"name": "@T"}', True, True, True, None),
    ('{"name": "@T", "arguments": 7}', '{"name": "@T", "arguments": {}}', True, True, True, None),
    (_CALL, '{"name": "@T", "arguments": null}', True, False, False, "expected_args_not_iterable"),
    ('{"a": 1} {"b": @E}', _CALL, False, False, False, None),
    ("@E, @U", _CALL, False, False, False, None),
    ("'@T'", _CALL, False, False, False, None),
    ("", _CALL, False, False, False, None),
    ('"@T"', _CALL, True, False, False, "not_object"),
]


def _filled(template: Column) -> Column:
    text = template
    for mark, name in (("@T", "event_type"), ("@U", "user_id"), ("@E", "event_id")):
        text = F.replace(text, F.lit(mark), F.col(name).cast("string"))
    return text


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(sample_id, instruction, expected, generated, inference_time, num_tokens)`` from events."""
    return timed_pairs(read(spark, sf_dir, "events")).drop("ts")


def timed_pairs(events: DataFrame) -> DataFrame:
    """The pairs with ``ts``, the event's time; events may be a stream."""
    case = F.col("event_id") % len(PAIRS)
    return events.select(
        "ts",
        F.col("event_id").alias("sample_id"),
        F.concat(F.lit("Do "), "event_type").alias("instruction"),
        _filled(_at([p[1] for p in PAIRS], case)).alias("expected"),
        _filled(_at([p[0] for p in PAIRS], case)).alias("generated"),
        (F.col("value") / 100).alias("inference_time"),
        F.col("user_id").alias("num_tokens"),
    )


def samples_and_predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The pairs taken apart; every tenth prediction is missing, every seventh comes again with another answer."""
    both = pairs(spark, sf_dir)
    samples = both.select("sample_id", "instruction", F.col("expected").alias("output"))
    predictions = both.where("sample_id % 10 <> 9").select("sample_id", "generated", "inference_time", "num_tokens")
    again = predictions.where("sample_id % 7 = 3").withColumn("generated", F.lit("~ another answer"))
    return samples, predictions.unionByName(again)


def flawed_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The specs, of which some are cut, doubled, a list, followed by junk or missing."""
    case = F.col("spec_id").cast("bigint") % 12
    text = F.col("content")
    flawed = (
        F.when(case == 0, F.expr("substring(content, 1, length(content) - 1)"))
        .when(case == 1, F.concat(text, text))
        .when(case == 2, F.concat(text, F.lit(" and more")))
        .when(case == 3, F.concat(F.lit("["), text, F.lit("]")))
        .when(case == 4, F.expr("concat(substring(content, 1, length(content) - 1), ',}')"))
        .when(case == 8, F.lit(None).cast("string"))
        .when(case == 9, F.concat(F.lit(" \n"), text, F.lit("\t")))
        .otherwise(text)
    )
    return specs(spark, sf_dir).withColumn("content", flawed)


PHRASES = [
    "update this alert ",
    "get the alert ",
    "show detection ",
    "target alert ",
    "specific incident ",
    "breach list ",
    "hunt for ",
    "kql query ",
    "secure score ",
    "risky users ",
    "login failures ",
    "design review ",
    "ioc feed ",
    "",
    "assign warning ",
    "threat intelligence ",
]


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(request_id, request)`` from the user turns; some blank, some stop words."""
    number = F.col("conv_id") + F.col("turn")
    text = (
        F.when(number % 19 == 17, "   ")
        .when(number % 19 == 18, " Quit\n")
        .otherwise(F.concat(F.lit("  "), _at(PHRASES, number % len(PHRASES)), F.col("text"), F.lit("\t")))
    )
    return (
        read(spark, sf_dir, "conversations")
        .where("role = 'user'")
        .select((F.col("conv_id") * 1000 + F.col("turn")).alias("request_id"), text.alias("request"))
    )


def namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(part_id, namespace)``: the end of a base and a number for each part; for some parts the number alone."""
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("part_id"))
    base = _at(BASES, F.col("part_id") % 8)
    ending = F.substr(base, (F.col("part_id") % 5 + 1).cast("int"))
    named = F.concat(F.when(F.col("part_id") % 50 == 0, "").otherwise(ending), F.lit("/"), F.col("part_id"))
    return part.select("part_id", named.alias("namespace"))
