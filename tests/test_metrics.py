import pytest

from pyspark.sql import functions as F

from toolloom.operators import metrics

SCHEMA = "sample_id int, instruction string, is_valid_json boolean, name_correct boolean, arguments_correct boolean, inference_time double, num_tokens long, error string"


@pytest.fixture
def results(spark):
    rows = [(i, "x", i < 90, i < 85, i < 80, 0.1, 3, "bad" if i >= 97 else ("" if i == 96 else None)) for i in range(100)]
    return spark.createDataFrame(rows, SCHEMA)


def test_rates_and_timing(results):
    row = metrics.eval_metrics(results).first()
    assert (row.total_samples, row.valid_json_count, row.correct_tool_name_count, row.correct_arguments_count) == (100, 90, 85, 80)
    assert (row.json_validity_rate, row.tool_name_accuracy, row.argument_accuracy, row.overall_accuracy) == (0.9, 0.85, 0.8, 0.8)
    assert (row.total_inference_time, row.avg_inference_time, row.tokens_per_second, row.error_count) == (10.0, 0.1, 30.0, 3)


def test_no_rows_give_zeros(spark):
    row = metrics.eval_metrics(spark.createDataFrame([], SCHEMA)).first()
    assert set(row.asDict().values()) == {0}


def test_report_has_the_documented_fields(results):
    report = metrics.metrics_report(metrics.eval_metrics(results))
    assert report.columns == [
        "total_samples", "valid_json_count", "correct_tool_name_count", "correct_arguments_count", "json_validity_rate",
        "tool_name_accuracy", "argument_accuracy", "overall_accuracy", "total_inference_time_seconds",
        "avg_inference_time_seconds", "tokens_per_second", "error_count",
    ]
    assert report.first().json_validity_rate == 0.9


def test_text(results):
    text = metrics.metrics_text(metrics.eval_metrics(results)).first().text
    assert "EVALUATION METRICS" in text
    assert "JSON Validity Rate:   90.00% (90/100)\n" in text
    assert "Avg Inference Time:   0.100s\nTokens/Second:        30.0\nTotal Errors:         3\n" in text


def test_card_and_profile(spark, results):
    card = metrics.card_metrics(metrics.eval_metrics(results)).first()
    assert tuple(round(v, 9) for v in card) == (90.0, 85.0, 80.0)
    sizes = {n: metrics.dataset_profile(spark.range(n).selectExpr("'{}' AS input")).first().size_category for n in (0, 999, 1000, 9999, 10000)}
    assert sizes == {0: "n<1K", 999: "n<1K", 1000: "1K<n<10K", 9999: "1K<n<10K", 10000: "10K<n<100K"}


def test_metrics_by_roll_up_to_the_total(spark, results):
    tagged = results.withColumn("tool", F.when(F.rand(3) < 0.5, "a").otherwise("b"))
    tagged = spark.createDataFrame(tagged.collect(), tagged.schema)
    rows = metrics.metrics_by(tagged, "tool").collect()
    total = metrics.eval_metrics(tagged).first()
    (top,) = [r for r in rows if r.is_total]
    for name in ("total_samples", "valid_json_count", "json_validity_rate", "argument_accuracy", "error_count"):
        assert top[name] == total[name]
    assert sum(r.total_samples for r in rows if not r.is_total) == top.total_samples and len(rows) == 3
    profile = metrics.dataset_profile(spark.createDataFrame([('{"function":{"name":"a"}}',), ('{"function":{"name":"b"}}',), ('{"function":{"name":"a"}}',)], "input string")).first()
    assert (profile.num_samples, profile.num_tools) == (3, 2)
