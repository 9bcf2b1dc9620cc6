import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from toolloom.operators import evaluate, metrics
from toolloom.plans import derived

CALL = {"name": "a", "arguments": {"x": 1, "y": [2], "z": {"k": None}}}
TEXT = json.dumps(CALL)

# (generated, expected, valid, name, arguments, error): what comes out, case by case.
OUTCOMES = [
    (TEXT, TEXT, True, True, True, None),
    (f" {TEXT}\n", TEXT, True, True, True, None),
    (TEXT + " tail", TEXT, False, False, False, None),
    (TEXT[:-1], TEXT, False, False, False, None),
    ("", TEXT, False, False, False, None),
    (None, TEXT, False, False, False, "null_text"),
    ("null", TEXT, True, False, False, None),
    ("[]", TEXT, True, False, False, "not_object"),
    ("5", TEXT, True, False, False, "not_object"),
    ("NaN", TEXT, True, False, False, "not_object"),
    (TEXT, None, True, False, False, "null_expected"),
    (TEXT, "null", True, False, False, None),
    (TEXT, "no JSON", True, False, False, None),
    (TEXT, "[1]", True, False, False, "expected_not_object"),
    ("{}", "{}", True, True, True, None),
    ("{}", '{"name":""}', True, True, True, None),
    ('{"name":null}', '{"name":""}', True, False, False, None),
    ('{"name":1}', '{"name":1.0}', True, True, True, None),
    ('{"name":true}', '{"name":1}', True, True, True, None),
    ('{"name":NaN}', '{"name":NaN}', True, False, False, None),
    ('{"name":"NaN"}', '{"name":"NaN"}', True, True, True, None),
    ('{"name":"1"}', '{"name":1}', True, False, False, None),
    ('{"name":"\\u0061"}', '{"name":"a"}', True, True, True, None),
    ('{"name":"z","name":"a"}', '{"name":"a"}', True, True, True, None),
    ('{"name":"a"}', '{"name":"a","arguments":{}}', True, True, True, None),
    ('{"name":"a"}', '{"name":"a","arguments":{"x":1}}', True, True, False, None),
    ('{"name":"a","arguments":null}', '{"name":"a","arguments":{"x":1}}', True, False, False, "args_not_container"),
    ('{"name":"a","arguments":3}', '{"name":"a","arguments":{}}', True, True, True, None),
    ('{"name":"a","arguments":["x"]}', '{"name":"a","arguments":{"x":1}}', True, True, True, None),
    ('{"name":"a","arguments":["y"]}', '{"name":"a","arguments":{"x":1}}', True, True, False, None),
    ('{"name":"a","arguments":"x y"}', '{"name":"a","arguments":{"y":1}}', True, True, True, None),
    ('{"name":"a","arguments":["x"]}', '{"name":"a","arguments":{"x":[]}}', True, False, False, "container_lookup"),
    (TEXT, '{"name":"a","arguments":7}', True, False, False, "expected_args_not_iterable"),
    (TEXT, '{"name":"a","arguments":""}', True, True, True, None),
]


def scored(spark, pairs):
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, generated string, expected string")
    results = evaluate.evaluate_samples(rows).collect()
    return {r.i: (r.is_valid_json, r.name_correct, r.arguments_correct, r.error) for r in results}


def test_outcomes(spark):
    got = scored(spark, [o[:2] for o in OUTCOMES])
    assert [(o, got[i]) for i, o in enumerate(OUTCOMES) if got[i] != o[2:]] == []


_scalars = st.none() | st.booleans() | st.integers(-3, 3) | st.sampled_from(["", "a", "é", "[1]"])
_values = st.recursive(_scalars, lambda inner: st.lists(inner, max_size=2) | st.dictionaries(st.sampled_from("abc"), inner, max_size=3), max_leaves=4)
_calls = st.builds(lambda n, a: {"name": n, "arguments": a}, st.text("abc", min_size=1, max_size=3), st.dictionaries(st.sampled_from("uvwxyz"), _values, min_size=1))


def mutations(call):
    """(generated text, outcome) for changes to a call of which the outcome is known."""
    name, args = call["name"], call["arguments"]
    key = sorted(args)[0]
    text = json.dumps(call)
    put = lambda **new: json.dumps({**call, **new})
    right, only_name, wrong, broken = (True, True, True, None), (True, True, False, None), (True, False, False, None), (False, False, False, None)
    other_kind = {list: {}, dict: []}.get(type(args[key]))
    yield text, right
    yield json.dumps(call, indent=1, sort_keys=True), right
    yield put(more=1), right
    yield put(arguments={**args, "more": [1]}), right
    yield put(arguments=dict(reversed(args.items()))), right
    yield put(name=name + "x"), wrong
    yield put(arguments={k: v for k, v in args.items() if k != key}), only_name
    yield put(arguments={**args, key: "text"}), only_name if other_kind is not None else right
    if other_kind is not None:
        yield put(arguments={**args, key: other_kind}), only_name
    yield text[:-1], broken
    yield text + "}", broken
    yield f"[{text}", broken
    yield text.replace('"', "'"), broken


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_calls, min_size=10, max_size=10))
def test_mutated_calls(spark, calls):
    cases = [(made, json.dumps(call), outcome) for call in calls for made, outcome in mutations(call)]
    got = scored(spark, [c[:2] for c in cases])
    assert [(c, got[i]) for i, c in enumerate(cases) if got[i] != c[2]] == []


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(_values, _values), min_size=40, max_size=40))
def test_any_pair_has_consistent_flags(spark, pairs):
    for valid, name, arguments, _ in scored(spark, [(json.dumps(a), json.dumps(b)) for a, b in pairs]).values():
        assert valid and (name or not arguments)


@pytest.mark.parametrize(
    "generated, expected, match",
    [
        ({"$filter": "severity eq 'high'", "$top": 50}, {"$filter": "severity eq 'high'", "$top": 50}, True),
        ({"$filter": "test"}, {"$filter": "test", "$top": 50}, False),
        ({"items": "string"}, {"items": ["a", "b"]}, False),
        ({"$top": "other kind"}, {"$top": 50}, True),
    ],
)
def test_compare_arguments(spark, generated, expected, match):
    texts = [json.dumps({"name": "list", "arguments": a}) for a in (generated, expected)]
    row = evaluate.compare_tool_calls(spark.createDataFrame([texts], "generated string, expected string")).first()
    assert (row.name_matches, row.arguments_match, row.compare_error) == (True, match, None)


def test_compare_names(spark):
    texts = [json.dumps({"name": n, "arguments": {}}) for n in ("get", "list")]
    row = evaluate.compare_tool_calls(spark.createDataFrame([texts], "generated string, expected string")).first()
    assert (row.name_matches, row.arguments_match) == (False, True)


def test_repeated_keys_are_an_error_when_the_setting_is_off(spark):
    text = '{"name":"a","arguments":{"x":{"k":1,"k":2}}}'
    results = evaluate.evaluate_samples(spark.createDataFrame([(text, text)], "generated string, expected string"))
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        row = results.first()
    finally:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    assert (row.is_valid_json, row.error) == (True, "unreadable")


def test_pairing_keeps_samples_without_a_prediction(spark):
    samples = spark.createDataFrame([(1, "a", "{}"), (2, "b", "{}"), (3, "c", "{}")], "sample_id long, instruction string, output string")
    predictions = spark.createDataFrame([(1, "{}", None), (3, None, "broken")], "sample_id long, generated string, error string")
    results = evaluate.evaluate_dataset(samples, predictions)
    got = {r.sample_id: (r.is_valid_json, r.arguments_correct, r.error) for r in results.collect()}
    assert got == {1: (True, True, None), 2: (False, False, "missing_prediction"), 3: (False, False, "broken")}
    errors = metrics.eval_errors(results).orderBy("index").collect()
    assert [tuple(r) for r in errors] == [(2, "b", "missing_prediction"), (3, "c", "broken")]


def test_of_several_predictions_one_counts(spark):
    samples = spark.createDataFrame([(1, "a", "{}"), (2, "b", "{}")], "sample_id long, instruction string, output string")
    predictions = spark.createDataFrame([(1, "{}", "broken"), (1, "{", None), (1, "[]", None), (2, None, "broken"), (2, "{}", None)], "sample_id long, generated string, error string")
    for rows in (predictions, predictions.repartition(3)):
        paired = evaluate.pair_predictions(samples, rows).collect()
        assert sorted((r.sample_id, r.generated, r.error) for r in paired) == [(1, "[]", None), (2, "{}", None)]


def test_harvested_samples_come_in_the_order_of_their_documents(spark):
    rows = [("a", p, 0, t, f"a/{p}/0/{t}", "i", "{}") for p in (10, 2) for t in (10, 9, 0)]
    samples = spark.createDataFrame(rows, "spec_id string, path_pos int, method_pos int, template_id int, sample_id string, instruction string, output string")
    none = spark.createDataFrame([], "sample_id string, generated string")
    got = evaluate.evaluate_dataset(samples, none, max_samples=4).collect()
    assert {r.sample_id for r in got} == {"a/2/0/0", "a/2/0/9", "a/2/0/10", "a/10/0/0"}


@pytest.mark.parametrize("n, kept", [(None, 5), (0, 5), (2, 2), (9, 5)])
def test_take_first(spark, n, kept):
    rows = spark.range(5).repartition(3)
    for dense in (False, True):
        got = sorted(r.id for r in evaluate.take_first(rows, n, "id", dense).collect())
        assert got == list(range(kept))


def test_same_on_any_partitioning(spark):
    rows = derived.pairs(spark, "/root/testdata/sf0.001")
    outcomes = []
    for n in (1, 2, 7):
        results = evaluate.evaluate_samples(rows.repartition(n))
        outcomes.append((metrics.eval_metrics(results).first(), sorted(results.collect())))
    assert outcomes[0] == outcomes[1] == outcomes[2]


def test_filter_on_the_verdict_does_not_parse_again(spark):
    errors = metrics.eval_errors(evaluate.evaluate_samples(derived.pairs(spark, "/root/testdata/sf0.001")))
    plan = errors._jdf.queryExecution().executedPlan().toString()
    # One parse a side, one second look a side, and what the rare cases need.
    assert plan.count("from_json(") <= 12
    assert "PushedFilters" in plan


def test_expected_against_itself_is_perfect(spark):
    calls = derived.pairs(spark, "/root/testdata/sf0.001").where("sample_id % 30 < 19").withColumn("generated", F.col("expected"))
    row = metrics.eval_metrics(evaluate.evaluate_samples(calls)).first()
    assert (row.json_validity_rate, row.tool_name_accuracy, row.argument_accuracy, row.error_count) == (1.0, 1.0, 1.0, 0)


def test_flags_imply_each_other(spark):
    results = evaluate.evaluate_samples(derived.pairs(spark, "/root/testdata/sf0.001"))
    assert results.where("(arguments_correct and not name_correct) or (name_correct and not is_valid_json)").isEmpty()
