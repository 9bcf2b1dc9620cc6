import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from toolloom.llm import metric_join
from toolloom.llm.common import join_hot
from toolloom.llm.graph import spread_components
from toolloom.llm.queries import llm_checks, llm_queries

SCHEMA = "vec_id long, embedding array<float>, label int, rep int, copies string, home int"


def corpus(seed, n=900, dim=8):
    """Clusters around few centres in few dimensions, so that many pairs lie on either side of the bound; a hot one."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        kind = rng.integers(0, 10)
        base = centres[0] if kind < 4 else centres[rng.integers(0, 12)]
        v = base + rng.normal(size=dim) * (0.0 if kind == 0 else 0.12 if kind < 8 else 1.0)
        rows.append((i * 13 % 1000, [float(np.float32(x)) for x in v * 10 ** rng.uniform(-3, 3)], int(rng.integers(0, 2)) if kind != 1 else 0, 1, "x", 2))
    strange = [None, [], [0.0] * dim, [math.nan] * dim, [math.inf] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [1.0, 2.0], [2.0, 4.0], [1e-38] * dim, [3e38] * dim]
    rows += [(2000 + k, v, 0, 1, "x", 2) for k, v in enumerate(strange)]
    return rows + [(3000, rows[0][1], None, 1, "x", 2), (3001, rows[0][1], rows[0][2], 1, "x", 2)]


def brute(rows, cosine=0.98):
    def fit(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, float), lab) for i, v, lab, *_ in rows if i is not None and lab is not None and fit(v)]
    near = {i: set() for i, *_ in rows}
    for a, (i, x, lab) in enumerate(good):
        for j, y, other in good[a + 1 :]:
            if lab == other and len(x) == len(y) and float(x @ y) / math.sqrt(float(x @ x) * float(y @ y)) >= cosine:
                near[i].add(j), near[j].add(i)
    found = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        found[i] = (len(near[i]), min(seen))
    return found


@pytest.mark.parametrize("cell,block", [(2048, 8192), (60, 8192), (25, 40)])
def test_equals_brute_force_whatever_the_cells(spark, monkeypatch, cell, block):
    monkeypatch.setattr(metric_join, "CELL", cell)
    monkeypatch.setattr(metric_join, "BLOCK", block)
    monkeypatch.setattr(metric_join, "DEALT", 300)
    rows = corpus(cell)
    found = metric_join.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    want = brute(rows)
    assert sum(n for n, _ in want.values()) > 5000 and len({c for _, c in want.values()}) > 100
    assert len(found) == len(rows) and {r.id: (r.n_links, r.component) for r in found} == want


def test_cells_of_well_kept_clusters_have_few_guests(spark, monkeypatch):
    """Eighty tight clusters far apart: the bounds keep nearly all vectors at home."""
    monkeypatch.setattr(metric_join, "CELL", 20)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(80, 64))
    rows = [(i, [float(x) for x in centres[i % 80] + rng.normal(size=64) * 0.005], 1, 1, "x", 2) for i in range(1600)]
    sent = []
    kept = metric_join.guests
    monkeypatch.setattr(metric_join, "guests", lambda *a: sent.append(kept(*a)) or sent[-1])
    found = metric_join.near_vectors(spark.createDataFrame(rows, SCHEMA))
    assert all(r.n_links == 19 and r.component == r.id % 80 for r in found.collect())
    assert sent[0].count() < 1600 * 8  # of about 80 cells


def test_repeated_and_missing_ids(spark):
    v, w = [1.0, 0.0], [0.0, 1.0]
    rows = [(1, v, 0, 1, "x", 2), (1, v, 0, 1, "x", 2), (5, v, 0, 1, "x", 2), (5, w, 0, 1, "x", 2), (None, v, 0, 1, "x", 2)]
    found = metric_join.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=str) == sorted([(1, 2, 1), (1, 2, 1), (5, 2, 1), (5, 0, 5), (None, 0, None)], key=str)
    assert metric_join.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_its_sql(spark, tmp_path):
    rows = corpus(9, 250)
    spark.createDataFrame(rows, SCHEMA).select("vec_id", "embedding", "label").write.parquet(f"{tmp_path}/embeddings.parquet")
    connection = duckdb.connect()
    connection.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    sql = connection.execute(f"select vec_id, n_links, component_id, kept from ({llm_checks()['op13_metric_join']})").fetchall()
    assert sorted(map(tuple, llm_queries()["op13_metric_join"](spark, str(tmp_path)).collect())) == sorted(sql)


def test_hot_keys_join_like_others(spark):
    rows = [(1 if random.random() < 0.5 else i, i) for i in range(5000)]
    left = spark.createDataFrame([*rows, (None, -1)], "k long, v long")
    right = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for how in ("inner", "left"):
        want = left.join(right, ["k"], how).select("k", "v", "w")
        assert sorted(map(str, join_hot(left, right, ["k"], how).select("k", "v", "w").collect())) == sorted(map(str, want.collect()))


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(1000, 3000)] + [(3, 7)]
    found = {r.node: r.label for r in spread_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 141)} | {i: 3 for i in [3, 7, *range(1000, 3000)]}
