"""Small inputs by bytes that are much work: they have to be dealt out, and filters must not be pushed below the dealing."""

import re

import pytest

from toolloom.operators import spec
from toolloom.plans import derived
from toolloom.plans.queries import all_queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("parts"))
    rows = spark.range(2000).selectExpr("CASE WHEN id > 1000 THEN NULL ELSE id END AS p_partkey", "concat('name ', id % 7) AS p_name")
    rows.coalesce(1).write.parquet(f"{base}/part.parquet")  # one row group, half of the keys null
    return base


def shares(rows):
    return rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()


def below_dealing(rows):
    """The pieces of the plan from each dealing of the parts down to their scan."""
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    return re.findall(r"Repartition \d+.*?Relation", plan, re.DOTALL)


def test_specs_are_dealt_evenly_whatever_their_keys(spark, folder):
    specs = derived.specs(spark, folder)
    assert specs.count() == 2000
    per_task = shares(specs)
    assert len(per_task) >= 4 and max(per_task) <= 2 * 2000 / len(per_task)


def test_tasks_grow_with_the_rows(spark):
    rows = derived.spread(spark.range(1000).toDF("id"), per_task=50)
    assert rows.rdd.getNumPartitions() == 20 and rows.count() == 1000


@pytest.mark.parametrize("query", ["spec_rejects", "spec_operations", "generate_samples", "dataset_profile", "namespace_matches"])
def test_texts_are_made_above_the_dealing(spark, folder, query):
    dealings = below_dealing(all_queries()[query](spark, folder))
    assert dealings and all("openapi" not in d for d in dealings)


def test_texts_of_rejects_are_parsed_once(spark, folder):
    plan = spec.spec_rejects(derived.flawed_specs(spark, folder))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
