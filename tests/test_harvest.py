import json
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from toolloom import fixed_values as fixed
from toolloom.functions.args import RULES
from toolloom.operators import samples, spec
from toolloom.plans import derived, jobs
from toolloom.sources.samples import read_samples
from toolloom.sources.specs import read_specs, rejected_specs


def specs_of(spark, *documents):
    return spark.createDataFrame([(f"s{i}", json.dumps(d)) for i, d in enumerate(documents)], "spec_id string, content string")


def one(operation, path="/security/alerts", method="get"):
    return {"paths": {path: {"parameters": [], method: operation}}}


LIST = {"operationId": "security_alerts_list", "summary": "List security alerts", "parameters": []}


def tool(spark, operation, path="/security/alerts", method="get"):
    row = spec.format_tools(spec.spec_operations(specs_of(spark, one(operation, path, method)))).first()
    return json.loads(row.input)["function"], row


def test_tool_with_a_query_parameter(spark):
    operation = {**LIST, "parameters": [{"name": "$filter", "in": "query", "schema": {"type": "string"}, "description": "Filter results"}]}
    function, row = tool(spark, operation)
    expected = {
        "type": "function",
        "function": {
            "name": "security_alerts_list",
            "description": "List security alerts",
            "parameters": {
                "type": "object",
                "properties": {"$filter": {"type": "string", "description": "Filter results"}},
                "required": [],
            },
        },
    }
    assert row.input == json.dumps(expected)


def test_required_path_parameter(spark):
    parameter = {"name": "alert-id", "in": "path", "required": True, "schema": {"type": "string"}, "description": "Alert ID"}
    function, _ = tool(spark, {**LIST, "parameters": [parameter, parameter]}, "/security/alerts/{alert-id}")
    assert list(function["parameters"]["properties"]) == ["alert-id"]
    assert function["parameters"]["required"] == ["alert-id", "alert-id"]


@pytest.mark.parametrize("required, kept", [(True, 1), (False, 0), (0, 0), (1, 1), ("", 0), ("false", 1), (None, 0), ([], 0), ([0], 1), ({}, 0)])
def test_required_is_pythons_truth(spark, required, kept):
    function, _ = tool(spark, {**LIST, "parameters": [{"name": "p", "in": "query", "required": required}]})
    assert len(function["parameters"]["required"]) == kept


@pytest.mark.parametrize("kind", ["integer", ["string", "null"], None])
def test_type_is_kept_as_written(spark, kind):
    function, _ = tool(spark, {**LIST, "parameters": [{"name": "p", "in": "query", "schema": {"type": kind}}]})
    assert function["parameters"]["properties"]["p"]["type"] == kind


def test_repeated_parameter_keeps_first_place_and_last_value(spark):
    parameters = [
        {"name": "a", "in": "query", "schema": {"type": "integer"}},
        {"name": "b", "in": "query"},
        {"name": "a", "in": "path", "schema": {"type": "array"}, "description": "<b>last</b>"},
        {"name": "h", "in": "header"},
        {"$ref": "#/x"},
    ]
    function, _ = tool(spark, {**LIST, "parameters": parameters})
    assert list(function["parameters"]["properties"].items()) == [
        ("a", {"type": "array", "description": "last"}),
        ("b", {"type": "string", "description": ""}),
    ]


@pytest.mark.parametrize(
    "body, has", [({"content": {"application/json": {}}}, True), ({"content": {"text/plain": {}}}, False), ({"$ref": "#/b"}, False)]
)
def test_request_body(spark, body, has):
    function, _ = tool(spark, {**LIST, "requestBody": body}, method="post")
    expected = {"type": "object", "description": "JSON body required for this action"}
    assert function["parameters"]["properties"].get("request_body") == (expected if has else None)


def test_name_falls_back_to_method_and_path(spark):
    function, _ = tool(spark, {"summary": "x"}, "/security/alerts/{id}", "delete")
    assert function["name"] == "delete__security_alerts_{id}"


def arguments(spark, properties, seed=42):
    parameters = [{"name": n, "in": "query", "schema": {"type": t}} for n, t in properties.items()]
    tools = spec.format_tools(spec.spec_operations(specs_of(spark, one({**LIST, "parameters": parameters}))))
    return json.loads(samples.example_args(tools, seed).first().arguments)


def test_example_arguments_by_rule(spark):
    names = ["$filter", "$select", "$top", "$orderby", "$expand", "$search", "alertId", "incidentId", "userId", "hostName", "query", "timeRange"]
    kinds = {"count": "integer", "enabled": "boolean", "items": "array", "shape": "object", "name": "string", "odd": "number"}
    seen = [arguments(spark, {**dict.fromkeys(names, "string"), **kinds}, seed) for seed in range(4)]
    assert len({json.dumps(a) for a in seen}) == 4
    for a in seen:
        assert list(a) == [*names, *kinds]
        clauses = a["$filter"].split(" and ")
        assert 1 <= len(clauses) == len(set(clauses)) <= 2 and set(clauses) <= set(fixed.FILTER_CLAUSES)
        fields = a["$select"].split(",")
        assert 2 <= len(fields) == len(set(fields)) <= 4 and set(fields) <= set(fixed.SELECT_FIELDS)
        assert a["$top"] in fixed.TOP_SIZES
        field, direction = a["$orderby"].split(" ")
        assert field in fixed.ORDER_FIELDS and direction in fixed.ORDER_DIRECTIONS
        assert a["$expand"] in fixed.EXPANSIONS
        assert a["$search"].strip('"') in fixed.SEARCH_TERMS and a["$search"].startswith('"')
        assert re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}_[1-9]\d{7}", a["alertId"])
        assert 1000 <= int(a["incidentId"]) <= 999_999 and isinstance(a["incidentId"], str)
        user, domain = a["userId"].split("@")
        assert user in fixed.USER_NAMES and domain in fixed.USER_DOMAINS
        prefix, number = a["hostName"].rsplit("-", 1)
        assert prefix in fixed.HOST_PREFIXES and len(number) == 2 and 1 <= int(number) <= 99
        assert a["query"] in fixed.HUNTING_QUERIES and a["timeRange"] in fixed.TIME_RANGES
        assert type(a["count"]) is int and 1 <= a["count"] <= 100
        assert type(a["enabled"]) is bool
        assert a["items"] in (["item0"], ["item0", "item1"], ["item0", "item1", "item2"])
        assert a["shape"] == {}
        assert re.fullmatch(r"example_name_[1-9]\d\d", a["name"]) and a["odd"].startswith("example_odd_")


def test_a_rule_of_ones_own_comes_first(spark):
    own = [("startswith(p.name, '$')", "'0'", False), *RULES]
    tools = spec.format_tools(spec.spec_operations(specs_of(spark, one({**LIST, "parameters": [{"name": "$top", "in": "query"}]}))))
    assert samples.example_args(tools, rules=own).first().arguments == '{"$top": 0}'


def test_one_sample_per_template(spark):
    made = samples.generate_samples(specs_of(spark, one(LIST))).collect()
    assert len({r.sample_id for r in made}) == len(made) == len(fixed.PROMPT_TEMPLATES)
    assert {r.instruction for r in made} == {t.format(action="list security alerts") for t in fixed.PROMPT_TEMPLATES}
    assert {r.output for r in made} == {'{"name": "security_alerts_list", "arguments": {}}'}


@pytest.mark.parametrize(
    "document",
    [
        one({"operationId": "x", "parameters": []}),
        one({**LIST, "summary": "<b> </b>", "description": "does not help"}),
        one(LIST, path="/me/messages"),
        one(LIST, method="GET"),
        one(LIST, method="head"),
        {"openapi": "3.0.1"},
        {"paths": {}},
    ],
)
def test_nothing_to_harvest(spark, document):
    assert samples.generate_samples(specs_of(spark, document)).isEmpty()


def test_namespaces_are_substrings_and_can_be_left_out(spark):
    specs = specs_of(spark, one(LIST, "/beta/riskyUsers/x"), one(LIST, "/me"))
    assert spec.spec_operations(specs).count() == 1
    assert spec.spec_operations(specs, []).count() == 2
    assert spec.spec_operations(specs, ["/m"]).count() == 1


def test_round_trip_of_every_derived_sample(spark):
    made = samples.generate_samples(derived.specs(spark, "/root/testdata/sf0.001")).collect()
    for row in made:
        definition, call = json.loads(row.input)["function"], json.loads(row.output)
        assert call["name"] == definition["name"]
        assert list(call["arguments"]) == list(definition["parameters"]["properties"])
        assert row.input == json.dumps(json.loads(row.input)) and row.output == json.dumps(call)
    assert set(Counter(r.sample_id.rsplit("/", 1)[0] for r in made).values()) == {len(fixed.PROMPT_TEMPLATES)}


def test_partitioning_does_not_change_samples(spark):
    specs = derived.specs(spark, "/root/testdata/sf0.001")
    seen = [sorted(samples.generate_samples(specs.repartition(n), spread=s).collect()) for n, s in ((1, 0), (7, None), (2, 1_000_000))]
    assert seen[0] == seen[1] == seen[2]


def test_large_spec_is_spread_over_tasks(spark):
    paths = {f"/security/alerts/{i}": {"get": LIST} for i in range(500)}
    documents = specs_of(spark, {"paths": paths}, one(LIST)).coalesce(1)
    for spread, parts in ((2000, 5), (None, 1), (10_000_000, 1)):
        operations = spec.spec_operations(documents, spread=spread)
        assert operations.count() == 501
        assert operations.select(F.spark_partition_id()).distinct().count() == parts
    assert "Exchange" not in spec.spec_operations(documents, spread=None)._jdf.queryExecution().executedPlan().toString()


def test_repeated_paths_and_methods_keep_first_place_and_last_value(spark):
    get = lambda name: json.dumps({**LIST, "operationId": name})
    text = '{"paths":{"/security/alerts":{"get":%s},"/security/cases":{"get":%s,"post":%s,"get":%s},"/security/alerts":{"get":%s}}}' % tuple(get(n) for n in "abcde")
    found = spec.spec_operations(spark.createDataFrame([("s", text)], "spec_id string, content string")).collect()
    assert sorted((r.path_pos, r.path, r.method_pos, r.method, r.op.operationId) for r in found) == [
        (0, "/security/alerts", 0, "get", "e"), (1, "/security/cases", 0, "get", "d"), (1, "/security/cases", 1, "post", "c"),
    ]


def test_one_odd_parameter_takes_no_other_with_it(spark):
    function, _ = tool(spark, {**LIST, "parameters": [{"name": "p", "in": "query"}, 5, "x", None, [1], {"name": "q", "in": "query", "required": True}]})
    assert list(function["parameters"]["properties"]) == ["p", "q"] and function["parameters"]["required"] == ["q"]


@pytest.mark.parametrize("text, error", [(None, "missing"), ("[1]", "not_an_object"), ("5", "not_an_object"), ('{"paths":{}', "not_json"), ('{"paths":{}} x', "not_json"), ('{"paths":{},}', "not_json"), ("", "not_json"), ('{"paths":{}}{}', "not_json")])
def test_unusable_specs_stop_or_are_told(spark, text, error):
    rows = spark.createDataFrame([("bad", text), ("good", json.dumps(one(LIST)))], "spec_id string, content string")
    assert [tuple(r) for r in spec.spec_rejects(rows).collect()] == [("bad", error)]
    assert spec.spec_operations(rows, on_error="skip").count() == 1
    with pytest.raises(Exception, match="unusable spec bad"):
        spec.spec_operations(rows).collect()


def test_very_long_numbers_and_texts_are_no_error(spark):
    text = '{"x":%s,"y":"%s","paths":{"/security/alerts":{"get":%s}}}' % ("1" * 3000, "a" * 3_000_000, json.dumps(LIST))
    assert spec.spec_operations(spark.createDataFrame([("s", text)], "spec_id string, content string")).count() == 1


def test_the_folder_of_a_spec_changes_no_sample(spark):
    text = json.dumps(one({**LIST, "parameters": [{"name": n, "in": "query"} for n in ("alertId", "userId", "query", "$filter")]}))
    rows = spark.createDataFrame([("/a/x.json", text), ("/b/y.json", text)], "spec_id string, content string")
    made = samples.generate_samples(rows).collect()
    sides = [{(r.instruction, r.input, r.output) for r in made if r.spec_id == i} for i in ("/a/x.json", "/b/y.json")]
    assert sides[0] == sides[1] and len(made) == 2 * len(fixed.PROMPT_TEMPLATES)


def test_harvest_from_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(one(LIST), indent=2))
    out = jobs.harvest(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    lines = [json.loads(x) for f in (tmp_path / "out").glob("*.json") for x in f.read_text().splitlines()]
    assert len(lines) == 19 and all(list(x) == ["instruction", "input", "output"] for x in lines)
    jobs.harvest(spark, str(tmp_path / "in"), out, templates=["{action}"])
    assert read_samples(spark, out).count() == 1


def test_yaml_is_read_like_json(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text(yaml.safe_dump({**one(LIST), "info": {200: "é"}}))
    made = samples.generate_samples(read_specs(spark, str(tmp_path / "a.yaml"), "yaml"))
    assert made.count() == 19


@pytest.mark.parametrize("fmt, text", [("json", "[1]"), ("json", '{"paths": '), ("json", '{"paths":{}} x'), ("yaml", "- 1"), ("yaml", "a: [")])
def test_root_has_to_be_a_mapping(spark, tmp_path, fmt, text):
    if fmt == "yaml":
        pytest.importorskip("yaml")
    (tmp_path / f"bad.{fmt}").write_text(text)
    (tmp_path / f"good.{fmt}").write_text(json.dumps(one(LIST)))
    kept = read_specs(spark, str(tmp_path), fmt, on_error="keep")
    assert [r.spec_id.rsplit("/", 1)[1] for r in rejected_specs(kept).collect()] == [f"bad.{fmt}"]
    with pytest.raises(Exception):
        read_specs(spark, str(tmp_path), fmt).collect()
