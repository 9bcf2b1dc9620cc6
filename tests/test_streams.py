import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from toolloom.operators import evaluate, metrics
from toolloom.streaming.evaluation import late_rows, pair_stream, state_rows, stream_metrics
from toolloom.streaming.requests import write_stream

START = dt.datetime(2024, 1, 1)
RESULTS = "sample_id long, ts timestamp, tool string, is_valid_json boolean, name_correct boolean, arguments_correct boolean, inference_time double, num_tokens long, error string"


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def results(n, seed=1):
    rng = random.Random(seed)
    return [(i, at(i + rng.randint(-5, 5)), rng.choice(["a", "b", None]), i % 3 > 0, i % 4 > 0, i % 5 > 0, rng.choice([0.1, 0.25, 0.0]), i % 7, "bad" if i % 11 == 0 else None) for i in range(n)]


def write(spark, folder, number, rows, schema):
    """One file of a stream; files are read in the order of their times."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/part={number}")


class Stream:
    """Files given one after the other to a query that stops and starts again between them."""

    def __init__(self, spark, folder, schema, build):
        self.spark, self.folder, self.schema, self.build, self.n = spark, str(folder), schema, build, 0

    def give(self, rows):
        write(self.spark, f"{self.folder}/in", self.n, rows, self.schema)
        self.n += 1
        stream = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").parquet(f"{self.folder}/in")
        query = write_stream(self.build(stream), f"{self.folder}/out", f"{self.folder}/checkpoint", availableNow=True)
        assert query.awaitTermination(120)
        return query

    def out(self):
        return sorted(self.spark.read.parquet(f"{self.folder}/out").collect(), key=str)


@pytest.mark.parametrize("slide", [None, "5 minutes"])
def test_windows_of_a_stream_equal_those_of_the_table(spark, tmp_path, slide):
    """Four runs, each started anew from the checkpoint, with repeated rows; the last file only moves the time on."""
    rows = results(200)
    later = [(10_000, at(5000), "a", True, True, True, 0.1, 1, None)]
    stream = Stream(spark, tmp_path, RESULTS, lambda s: stream_metrics(s, "ts", "20 minutes", "30 minutes", slide, ["tool"]))
    held = []
    for part in (rows[:70], rows[60:140], rows[140:], later):
        query = stream.give(part)
        assert late_rows(query) == 0
        held.append(state_rows(query))
    want = metrics.metrics_by_window(spark.createDataFrame(rows, RESULTS), "ts", "20 minutes", slide, ["tool"])
    assert len(stream.out()) > 10 and stream.out() == sorted(want.collect(), key=str)
    assert max(held) < 200 and held[-1] < 10  # closed windows and old keys leave the state


def test_late_rows_are_counted_one_by_one(spark, tmp_path):
    stream = Stream(spark, tmp_path, RESULTS, lambda s: stream_metrics(s, "ts", "20 minutes", "30 minutes", by=["tool"]))
    rows = results(100)
    assert late_rows(stream.give(rows)) == 0
    too_late = [(500 + i, at(5), "a", True, True, True, 0.1, 1, None) for i in range(7)]
    in_time = [(600, at(95), "b", True, True, True, 0.1, 1, None)]
    assert late_rows(stream.give(too_late + in_time)) == 7
    stream.give([(10_000, at(5000), "a", True, True, True, 0.1, 1, None)])
    want = metrics.metrics_by_window(spark.createDataFrame(rows + in_time, RESULTS), "ts", "20 minutes", by=["tool"])
    assert stream.out() == sorted(want.collect(), key=str)


def test_without_a_key_repeated_results_count_again(spark, tmp_path):
    stream = Stream(spark, tmp_path, RESULTS, lambda s: stream_metrics(s, "ts", "1 hour", "30 minutes", key=None))
    rows = results(50)
    stream.give(rows + rows[:3] + [(77, None, "a", True, True, True, 0.1, 1, None)])
    stream.give([(10_000, at(5000), "a", True, True, True, 0.1, 1, None)])
    want = metrics.metrics_by_window(spark.createDataFrame(rows + rows[:3], RESULTS), "ts", "1 hour")
    assert stream.out() == sorted(want.collect(), key=str)


def test_windows_add_up_to_the_whole(spark):
    table = spark.createDataFrame(results(300), RESULTS)
    windows = metrics.metrics_by_window(table, "ts", "1 hour", by=["tool"])
    whole = metrics.eval_metrics(table).first()
    sums = windows.agg(*[F.sum(c).alias(c) for c in (*metrics.COUNTS, "error_count")]).first()
    assert all(sums[c] == whole[c] for c in (*metrics.COUNTS, "error_count"))


SAMPLES = "sample_id long, sent timestamp, instruction string, output string"
ANSWERS = "sample_id long, seen timestamp, generated string, inference_time double, num_tokens long, error string"


def test_samples_and_predictions_pair_on_streams_as_in_tables(spark, tmp_path):
    """Answers before and after their samples' file, several of them, failed ones, null texts, none, and too late ones."""
    rng = random.Random(4)
    samples = [(i, at(i), f"do {i}", "{}") for i in range(120)]
    answers = []
    for i in range(120):
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            answers.append((i, at(i + rng.randint(0, 60)), rng.choice([None, "x", "y"]), rng.choice([0.1, 0.2]), 1, rng.choice([None, None, "bad"])))
    outside = [(3, at(3 + 61), "aaa", 0.0, 0, None), (4, at(3), "aaa", 0.0, 0, None)]
    sides = {}
    for name, schema, parts in (
        ("samples", SAMPLES, [samples[:50], samples[50:], [(-1, at(9000), "later", "{}")]]),
        ("answers", ANSWERS, [answers[30:], answers[:30] + outside, [(-2, at(9000), "later", 0.0, 0, None)]]),
    ):
        sides[name] = (schema, parts)
    for turn in range(3):
        streams = []
        for name, (schema, parts) in sides.items():
            write(spark, f"{tmp_path}/{name}", turn, parts[turn], schema)
            streams.append(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/{name}"))
        paired = pair_stream(*streams, "sent", "seen", "60 MINUTES", "3 hours")
        assert write_stream(paired, f"{tmp_path}/out", f"{tmp_path}/checkpoint", availableNow=True).awaitTermination(180)
    batch = evaluate.pair_predictions(spark.createDataFrame(samples, SAMPLES), spark.createDataFrame(answers, ANSWERS).drop("seen"))
    found = spark.read.parquet(f"{tmp_path}/out").select(*batch.columns)
    assert batch.where("error = 'missing_prediction'").count() > 10
    assert sorted(found.collect(), key=str) == sorted(batch.collect(), key=str)


def test_an_answer_without_text_gives_way_to_one_with_text(spark):
    samples = spark.createDataFrame([(1, "{}"), (2, "{}"), (3, "{}")], "sample_id long, output string")
    answers = [(1, None, None), (1, "good", None), (2, "bad", "failed"), (2, None, None), (3, None, None)]
    paired = evaluate.pair_predictions(samples, spark.createDataFrame(answers, "sample_id long, generated string, error string"))
    assert {r.sample_id: (r.generated, r.error) for r in paired.collect()} == {1: ("good", None), 2: (None, None), 3: (None, None)}
