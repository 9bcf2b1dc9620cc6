import math
import random

import pytest
from pyspark.sql import functions as F

from toolloom.llm import mixing


def shared_out(sizes, weights, share):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in full]
        if not rest:
            return full
        level = (total - sum(full.values())) / sum(w[s] for s in rest)
        over = [s for s in rest if level * w[s] >= 2 * sizes[s]]
        if not over:
            return full | {s: level * w[s] for s in rest}
        full |= {s: 2.0 * sizes[s] for s in over}


def corpus(seed, n=900):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.choice([0, 1, 5, 60, 60, 300]))), rng.choice(["a", "b", "B", "é", "z", None]) if rng.random() < 0.6 else "hot", i) for i in range(n)]
    return rows + [(n, None, "a", 0), (n + 1, "", "blank", 0), (None, "x y", "a", 0)]


def test_targets_and_totals(spark):
    rows = corpus(1)
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    found = mixing.mix(frame).collect()
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = shared_out(sizes, (3, 1, 2), 1.5)
    taken = {}
    for r in found:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert len(found) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 300 for s in want)
    for parts in (1, 7, 13):
        assert sorted(map(str, found)) == sorted(map(str, mixing.mix(frame.repartition(parts)).collect()))


def test_rates_meet_the_targets_before_rounding(spark):
    found = mixing.mix(spark.createDataFrame(corpus(2), "doc_id long, text string, source string, size int"), weights=(5, 1), share=1.2)
    sums = found.groupBy("source").agg(F.sum(F.col("rate") * F.col("size")).alias("expected"), F.max("target").alias("target"), F.max("rate").alias("top")).collect()
    assert all(math.isclose(r.expected, r.target, rel_tol=1e-4, abs_tol=1e-6) and r.top <= 2 for r in sums)


def test_keep_columns_and_empty_table(spark):
    frame = spark.createDataFrame(corpus(3, 20), "doc_id long, text string, source string, size int")
    assert {r.kept_size for r in mixing.mix(frame, keep=["size", "text"]).collect()} == set(range(20))
    assert mixing.mix(frame.where("false")).count() == 0


def test_a_mix_that_does_not_settle_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 1)
    with pytest.raises(ArithmeticError):
        mixing.mix(spark.createDataFrame(corpus(4), "doc_id long, text string, source string, size int"))
