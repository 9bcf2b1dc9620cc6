import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from toolloom.plans.checks import all_checks
from toolloom.plans.queries import all_queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        connection.sql(f"create view {file.stem} as select * from '{file}'")
    return connection


def test_every_query_has_a_check():
    assert set(all_queries()) == set(all_checks())
    assert set(all_queries()) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", all_queries())
def test_query_equals_its_sql(spark, duck, name):
    frame = contract.queries()[name](spark, DATA)
    names = sorted(frame.columns)
    ours = [tuple(r) for r in frame.select(*[f"`{n}`" for n in names]).collect()]
    result = duck.execute(contract.oracle_sql()[name])
    found = [d[0] for d in result.description]
    assert sorted(found) == names
    theirs = [tuple(row[found.index(n)] for n in names) for row in result.fetchall()]

    def same(a, b):
        return math.isclose(a, b, rel_tol=1e-12) if isinstance(a, float) and b is not None else a == b

    ours.sort(key=str), theirs.sort(key=str)
    assert len(ours) == len(theirs) > 0
    assert all(same(a, b) for x, y in zip(ours, theirs) for a, b in zip(x, y))


def test_entry(spark):
    assert contract.entry(spark).count() == 1
