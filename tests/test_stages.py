import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from toolloom import fixed_values as fixed
from toolloom.functions.chat import ChatStyle, system_prompt
from toolloom.functions.routing import route_tool
from toolloom.operators import chat, evaluate, inference, requests
from toolloom.operators.split import train_test_split
from toolloom.plans import derived, jobs
from toolloom.plans.queries import stub_predictor
from toolloom.sources import catalogue as tools
from toolloom.sources.reports import write_eval_report
from toolloom.sources.samples import count_samples, read_samples, write_samples
from toolloom.streaming.requests import route_stream, write_stream

# The predictors below run in workers, which cannot import the tests.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Each with the tool the keyword cascade gives, which is not always the best one.
PROMPTS = [
    ("Get all high severity security alerts from the last 24 hours", "get_alert"),
    ("Show me the details of alert ID da637551227677560813_-961444813", "list_alerts"),
    ("Assign alert to analyst@contoso.com and mark as in progress", "update_alert"),
    ("List all active security incidents", "list_incidents"),
    ("Run a hunting query for PowerShell execution events in the last 7 days", "run_hunting_query"),
    ("Get the organization's current security score", "list_secure_scores"),
    ("List all risky users flagged by Identity Protection", "list_risky_users"),
    ("Show failed sign-in attempts from the last hour", "list_sign_ins"),
    ("Get threat intelligence indicators for known malware", "list_ti_indicators"),
    ("TARGET WARNING", "get_alert"),
    ("a new design", "list_sign_ins"),
    ("specific breach", "get_incident"),
    ("hello", "list_alerts"),
]


def test_routing(spark):
    rows = spark.createDataFrame(PROMPTS, "request string, key string")
    assert rows.where(route_tool(F.col("request")) != F.col("key")).isEmpty()
    assert rows.where(route_tool(F.col("request"), [], "only") != "only").isEmpty()


def test_requests_are_stripped_and_stop_words_dropped(spark):
    texts = ["  hi ", "", "   ", "QUIT", " exit\n", "q", "　", "quit now"]
    kept = requests.filter_requests(spark.createDataFrame([(t,) for t in texts], "request string"))
    assert sorted(r.request for r in kept.collect()) == ["hi", "quit now"]


def test_lookup(spark):
    rows = spark.createDataFrame([("x", "get_alert"), ("x", "nothing"), (" ", "get_alert"), (None, None)], "request string, tool_key string")
    found = requests.lookup_tool(rows, tools.default_catalogue(spark)).collect()
    assert sorted((r.status, r.definition is None) for r in found) == [("blank_request", True), ("blank_request", True), ("ok", False), ("unknown_tool", True)]


def test_catalogue_round_trip(spark, tmp_path):
    default = tools.default_catalogue(spark, "Acme")
    assert default.count() == 10 and {k for _, narrower, k in fixed.ROUTES for k in [k, *[n for _, n in narrower]]} <= set(fixed.TOOLS)
    definition = json.loads(default.where("tool_key = 'get_alert'").first().definition)
    assert definition["function"]["parameters"]["required"] == ["alertId"]
    assert "from Acme." in default.where("tool_key = 'list_alerts'").first().definition
    stored = tools.read_tool_catalogue(spark, tools.write_tool_catalogue(default, str(tmp_path / "c")))
    assert sorted(stored.collect()) == sorted(default.collect())


def test_small_catalogue_is_broadcast(spark):
    routed = requests.route_requests(derived.requests(spark, "/root/testdata/sf0.001"), tools.default_catalogue(spark))
    assert "BroadcastHashJoin" in routed._jdf.queryExecution().executedPlan().toString()


def test_chat_of_a_sample(spark):
    row = spark.createDataFrame([("do", "{}", "[]")], "instruction string, input string, output string")
    turns = chat.to_messages(row, "sys").first().messages
    assert [tuple(t) for t in turns] == [("system", "sys"), ("user", "User Request: do\nAvailable Tool: {}"), ("assistant", "[]")]
    assert len(chat.to_messages(row, with_answer=False).first().messages) == 2
    text = chat.training_text(row).first().text
    assert text.startswith(f"<|im_start|>system\n{system_prompt()}<|im_end|>\n") and text.endswith("<|im_start|>assistant\n[]<|im_end|>\n")
    style = ChatStyle(open="[{role}]", close="", begin="<s>")
    prompt = row.select(chat.prompt_column(F.col("instruction"), F.col("input"), "sys", style)).first()[0]
    assert prompt == "<s>[system]sys[user]User Request: do\nAvailable Tool: {}[assistant]"


def test_prompts_need_a_tool(spark):
    rows = spark.createDataFrame([("a", "t", None), ("b", None, [("x",)]), ("c", None, None), ("d", "t", [("x",)])], "instruction string, tool string, tools array<struct<name string>>")
    got = {r.instruction: (r.tool_text, r.status, r.prompt is None) for r in chat.inference_prompts(rows, tools="tools").collect()}
    assert got == {
        "a": ("t", "ok", False),
        "b": ('[{"name":"x"}]', "ok", False),
        "c": (None, "missing_tool", True),
        "d": ("t", "ok", False),
    }
    with pytest.raises(ValueError):
        chat.inference_prompts(rows, tool=None)


def test_overlength_with_a_tokenizer_of_ones_own(spark):
    rows = spark.createDataFrame([("a, b",), ("x" * 5,)], "text string")
    assert [r.n_tokens for r in chat.flag_overlength(rows).collect()] == [3, 1]
    own = chat.flag_overlength(rows, max_tokens=4, count=F.length("text")).collect()
    assert [(r.n_tokens, r.over_length) for r in own] == [(4, False), (5, True)]


def test_tokens_are_words_of_any_script(spark):
    texts = {"Straße": 1, "é über naïve": 3, "a\u00a0b": 2, "日本語 テキスト": 2, "a,b! ?": 5, "x_1": 1, "": 0, " \u3000\n": 0, "e\u0301te\u0301": 1}
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    assert {r.text: r.n_tokens for r in chat.flag_overlength(rows).collect()} == texts


def test_conversations_are_rendered_in_order(spark):
    rows = spark.createDataFrame([(1, 10, "user", "c"), (1, 2, "assistant", "b"), (1, 1, "user", "a"), (2, 1, "user", None)], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.text) for r in chat.conversations_to_text(rows.repartition(3), ChatStyle("[{role}]", ";")).collect()}
    assert got == {1: (3, "[user]a;[assistant]b;[user]c;"), 2: (1, "[user];")}


@pytest.mark.parametrize("mode", ["hash", "exact"])
def test_groups_are_never_on_both_sides(spark, mode):
    rows = spark.range(2000).withColumn("g", F.col("id") % 130)
    split = train_test_split(rows, "id", 0.2, mode=mode, group_by="g")
    sides = split.groupBy("g").agg(F.count_distinct("split").alias("n"), F.min("split").alias("s")).collect()
    assert all(r.n == 1 for r in sides) and split.count() == 2000
    n_test = sum(r.s == "test" for r in sides)
    assert n_test == 26 if mode == "exact" else 10 < n_test < 45


@pytest.mark.parametrize("mode", ["hash", "exact"])
def test_split_is_complete_and_disjoint(spark, mode):
    rows = spark.range(1003)
    split = train_test_split(rows, "id", mode=mode)
    sides = {r.id: r.split for r in split.collect()}
    assert len(sides) == split.count() == 1003
    n_test = sum(s == "test" for s in sides.values())
    assert n_test == 101 if mode == "exact" else 60 < n_test < 150
    again = {r.id: r.split for r in train_test_split(rows.repartition(7), "id", mode=mode).collect()}
    assert again == sides
    assert {r.id: r.split for r in train_test_split(rows, "id", seed=7, mode=mode).collect()} != sides


@pytest.mark.parametrize("n, test_size, wanted", [(1, 0.1, 1), (7, 0.5, 4), (0, 0.1, 0), (30, 0.99, 30)])
def test_exact_split_of_few_rows(spark, n, test_size, wanted):
    split = train_test_split(spark.range(n), "id", test_size, mode="exact")
    assert (split.where("split = 'test'").count(), split.count()) == (wanted, n)


def test_hash_split_does_not_shuffle(spark):
    plan = train_test_split(spark.range(10), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    for bad in (0, 1):
        with pytest.raises(ValueError):
            train_test_split(spark.range(10), "id", bad)
    with pytest.raises(ValueError):
        train_test_split(spark.range(10), "id", mode="other")


def lines(path, n):
    path.write_text("".join(json.dumps({"instruction": f"{path.stem} {i}", "input": "{}", "output": '{"name": "a"}'}) + "\n" for i in range(n)))


def test_samples_are_numbered_in_file_order(spark, tmp_path):
    lines(tmp_path / "a.jsonl", 700)
    lines(tmp_path / "b.jsonl", 301)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        got = [(r.sample_id, r.instruction) for r in read_samples(spark, str(tmp_path)).orderBy("sample_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(enumerate([*[f"a {i}" for i in range(700)], *[f"b {i}" for i in range(301)]]))


def test_unusable_sample_files(spark, tmp_path):
    (tmp_path / "empty.jsonl").write_text("\n")
    (tmp_path / "broken.jsonl").write_text("{")
    with pytest.raises(ValueError):
        read_samples(spark, str(tmp_path / "empty.jsonl"))
    with pytest.raises(Exception):
        read_samples(spark, str(tmp_path / "broken.jsonl")).collect()
    with pytest.raises(Exception):
        read_samples(spark, str(tmp_path / "missing.jsonl"))


def test_count_samples(spark, tmp_path):
    lines(tmp_path / "a.jsonl", 3)
    (tmp_path / "b.jsonl").write_text("x\n\n")
    (tmp_path / "c.txt").write_text("no\n")
    (tmp_path / "deeper").mkdir()
    lines(tmp_path / "deeper" / "d.jsonl", 9)
    assert count_samples(spark, str(tmp_path / "a.jsonl")).first().num_samples == 3
    assert count_samples(spark, str(tmp_path)).first().num_samples == 5


def test_prepare_training(spark, tmp_path):
    lines(tmp_path / "a.jsonl", 200)
    out = jobs.prepare_training(spark, str(tmp_path / "a.jsonl"), str(tmp_path / "out"), mode="exact")
    texts = spark.read.parquet(out)
    assert {r.split: r["count"] for r in texts.groupBy("split").count().collect()} == {"test": 20, "train": 180}
    assert not texts.where("over_length").count()


def test_failing_prompts_fail_alone(spark):
    rows = spark.createDataFrame([(i, "x" * n if n else None, 2**60 + i if i else None) for i, n in enumerate([5, 13, 4, 0, 23, 7])], "i int, prompt string, big long")
    got = {r.i: r for r in inference.generate_tool_calls(rows.coalesce(1), stub_predictor, batch_size=4).collect()}
    assert {i: r.error for i, r in got.items()} == {0: None, 1: "generation_failed", 2: None, 3: "missing_prompt", 4: "generation_failed", 5: None}
    assert {i: r.error_message for i, r in got.items() if r.error_message} == {1: "refused", 4: "refused"}
    assert [got[0].generated, got[2].generated, got[5].num_tokens] == ['{"chars": 5}', "chars: 4", 0]
    assert got[0].parsed is not None and got[2].parsed is None
    assert got[5].big == 2**60 + 5 and got[0].big is None
    assert got[0].inference_time > 0 and got[1].inference_time == 0


def echo():
    return lambda prompts, n, t: [('{"name": "a", "arguments": {}}', 4) for _ in prompts]


def test_evaluate_file_and_report(spark, tmp_path):
    lines(tmp_path / "a.jsonl", 50)
    row = jobs.evaluate_file(spark, str(tmp_path / "a.jsonl"), echo, str(tmp_path / "report"), max_samples=20).first()
    assert (row.total_samples, row.argument_accuracy, row.error_count) == (20, 1.0, 0)
    assert spark.read.parquet(str(tmp_path / "report" / "results")).count() == 20
    assert spark.read.json(str(tmp_path / "report" / "metrics")).first().error_count == 0


def test_report_lists_errors(spark, tmp_path):
    results = evaluate.evaluate_samples(derived.pairs(spark, "/root/testdata/sf0.001"))
    row = write_eval_report(results, str(tmp_path)).first()
    assert spark.read.json(str(tmp_path / "errors")).count() == row.error_count > 0


def test_evaluate_single(spark):
    tool = tools.default_catalogue(spark).where("tool_key = 'list_alerts'").first().definition
    row = evaluate.evaluate_single(spark, "list", tool, echo).first()
    assert (row.tool_name, row.verdict, json.loads(row.response)["name"]) == ("security_alerts_list", "[Valid JSON]", "a")
    row = evaluate.evaluate_single(spark, "list", tool, lambda: lambda p, n, t: [("oops {", 2)] * len(p)).first()
    assert (row.verdict, row.response) == ("[Invalid JSON]", "oops {")


def test_write_samples_overwrites(spark, tmp_path):
    rows = spark.createDataFrame([("a", "b", "c", 1)], "instruction string, input string, output string, more int")
    for _ in range(2):
        path = write_samples(rows, str(tmp_path / "s"))
    assert [tuple(r) for r in read_samples(spark, path).collect()] == [(0, "a", "b", "c")]


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    asked = derived.requests(spark, "/root/testdata/sf0.001")
    asked.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(asked.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    catalogue = tools.default_catalogue(spark)
    answers = route_stream(stream, catalogue, echo).drop("parsed", "inference_time")
    query = write_stream(answers, str(tmp_path / "out"), str(tmp_path / "checkpoint"), availableNow=True)
    query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = route_stream(asked, catalogue, echo).drop("parsed", "inference_time")
    assert sorted(got.collect()) == sorted(batch.collect())


def test_evaluation_runs_on_a_stream(spark, tmp_path):
    pairs = derived.pairs(spark, "/root/testdata/sf0.001")
    pairs.write.parquet(str(tmp_path / "in"))
    stream = evaluate.evaluate_samples(spark.readStream.schema(pairs.schema).parquet(str(tmp_path / "in")))
    write_stream(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), availableNow=True).awaitTermination(120)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(evaluate.evaluate_samples(pairs).collect())
