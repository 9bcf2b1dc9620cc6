import math
import random
import struct
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from toolloom.functions.numbers import round_half_even
from toolloom.operators.inference import generate_resumable, read_ledger
from toolloom.operators.split import split_at, split_border, train_test_split

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def noting(folder, stop=None, refuse=None):
    """A predictor that notes every prompt it answers; it ends its worker's task at one prompt and refuses another."""

    def make():
        def predict(prompts, n, t):
            if stop in prompts:
                raise SystemExit("lost")
            if refuse in prompts:
                raise ValueError("refused")
            for p in prompts:
                with Path(folder, f"{p}.txt").open("a") as f:
                    f.write("x")
            return [(f"answer {p}", 1) for p in prompts]

        return predict

    return make


def test_a_stopped_run_repeats_no_finished_round(spark, tmp_path):
    calls, ledger = tmp_path / "calls", str(tmp_path / "ledger")
    calls.mkdir()
    prompts = spark.createDataFrame([(i, f"p{i}") for i in range(80)] + [(None, "no key")], "sample_id int, prompt string")
    with pytest.raises(Exception):
        generate_resumable(prompts, noting(calls, stop="p41"), ledger, rounds=8)
    finished = {r.sample_id for r in read_ledger(spark, ledger).collect()}
    assert 10 <= len(finished) < 80
    found = generate_resumable(prompts, noting(calls, refuse="p7"), ledger, rounds=8)
    rows = {r.sample_id: r for r in found.collect()}
    assert found.count() == len(rows) == 80
    made = Counter({int(f.stem[1:]): len(f.read_text()) for f in calls.glob("*.txt")})
    assert all(made[i] == 1 for i in finished)  # never predicted again
    assert all(rows[i].generated == f"answer p{i}" for i in rows if i != 7)
    again = generate_resumable(prompts, noting(calls), ledger, rounds=8, retry_errors=True)
    seven = again.where("sample_id = 7").first()
    assert (seven.generated, seven.error, again.count()) == ("answer p7", None, 80)
    assert sum(len(f.read_text()) for f in calls.glob("*.txt")) == sum(made.values()) + (0 if 7 in finished else 1)
    more = prompts.where("sample_id > 70").unionByName(spark.createDataFrame([(99, "p99")], prompts.schema))
    assert sorted(r.sample_id for r in generate_resumable(more, noting(calls), ledger).collect()) == [*range(71, 80), 99]


def test_added_rows_move_only_rows_between_the_borders(spark):
    before, after = spark.range(1000), spark.range(1300)
    old = train_test_split(before, "id", 0.2, mode="exact")
    border = split_border(before, "id", 0.2)
    kept = split_at(after, border, "id")
    sides = {r.id: r.split for r in old.collect()}
    assert all(sides[r.id] == r.split for r in kept.where("id < 1000").collect())  # a kept border moves none
    new = train_test_split(after, "id", 0.2, mode="exact")
    assert new.where("split = 'test'").count() == 260
    new_border = split_border(after, "id", 0.2).first().place
    low, high = sorted([border.first().place, new_border])
    moved = [r.id for r in new.where("id < 1000").collect() if sides[r.id] != r.split]
    scores = {}
    for i in moved:  # the place of a row is the border of the table that is this row alone
        scores[i] = split_border(after.where(F.col("id") == i), "id", 0.5).first().place
    assert all(low < scores[i] <= high for i in moved) and len(moved) < 60


def test_rounding_is_that_of_the_exact_binary_value(spark):
    rng = random.Random(2)
    values = [rng.choice([rng.random(), rng.uniform(-1e4, 1e4), rng.randint(-10**6, 10**6) / 1000, rng.randint(0, 10**5) / 32, struct.unpack("d", rng.randbytes(8))[0]]) for _ in range(10_000)]
    values += [0.03125, 0.09375, 2.675, 1.005, 0.5, 1.5, 2.5, -0.5, -2.5, 1e22, 0.0, 123456789.005, math.inf, -math.inf, math.nan, None]
    values = [v for v in values if v is None or math.isnan(v) or math.isinf(v) or abs(v) < 1e290]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for places in (2, 4):
        for r in frame.select("x", round_half_even(F.col("x"), places).alias("y")).collect():
            if r.x is None or math.isnan(r.x) or math.isinf(r.x):
                assert str(r.x) == str(r.y)
            else:
                assert r.y == round(r.x, places), r.x
