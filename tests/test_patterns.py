import random

import pytest
from pyspark.sql import functions as F

from toolloom.operators import spec
from toolloom.operators.evaluate import SMALL, take_first
from toolloom.operators.metrics import dataset_profile, merge_profiles, profile_of_parts, profile_parts
from toolloom.operators.patterns import match_patterns
from toolloom.sources.samples import read_samples


def table(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def words(seed, n, letters, longest):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(n)]


@pytest.mark.parametrize("gram", [1, 3, 8])
def test_matches_are_those_of_contains(spark, gram):
    texts = [*words(1, 300, "ab/é", 25), "", None, "/security/alerts/1", "/security/alerts/1", "🙂ab🙂"]
    patterns = [*words(2, 60, "ab/é", 7), "", None, "/alerts/", "/alerts/", "🙂", "/security/alerts/12", "a" * 40]
    found = match_patterns(table(spark, texts, "path"), table(spark, patterns, "namespace"), gram=gram).collect()
    want = {(t, p) for t in texts for p in patterns if t is not None and p is not None and p in t}
    assert len(found) == len(want) and {tuple(r) for r in found} == want


def test_table_and_list_keep_the_same_rows(spark):
    paths = spark.createDataFrame([(i, p) for i, p in enumerate([*words(3, 200, "abc/", 12), None, ""])], "i int, path string")
    for wanted in (["ab", "c/a", "abcabc"], ["zzz"], []):
        by_list = sorted(r.i for r in spec.filter_namespaces(paths, wanted).collect())
        by_table = sorted(r.i for r in spec.filter_namespaces(paths, table(spark, wanted, "namespace")).collect())
        assert by_list == by_table


def test_a_hundred_thousand_patterns_need_no_nested_loop(spark):
    numbers = spark.range(100_000)
    patterns = numbers.select(F.concat(F.lit("/alerts/"), "id", F.lit("/")).alias("namespace"))
    paths = spark.range(99_000, 104_000).select(F.concat(F.lit("/security/alerts/"), "id", F.lit("/notes")).alias("path"))
    found = match_patterns(paths, patterns)
    assert found.count() == 1000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_first_rows_without_sorting_all_in_one_task(spark):
    rng = random.Random(7)
    rows = [(rng.choice([None, *range(50)]), rng.choice(["x", "y", None]), i) for i in range(3 * SMALL)]
    frame = spark.createDataFrame(rows, "a int, b string, c int").repartition(6).cache()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "", r[2]))
    for n in (SMALL + 1, 2 * SMALL, len(rows), len(rows) + 5):
        found = take_first(frame, n, ["a", "b", "c"])
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, order[:n]))
    ties = take_first(frame, SMALL + 5, ["a", "b"]).collect()  # the last key is shared by some 200 rows
    assert len(ties) == SMALL + 5
    keys = lambda some: sorted(str((r[0], r[1])) for r in some)
    assert keys(ties) == keys(order[: SMALL + 5])
    plan = take_first(frame, 2 * SMALL, ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "GlobalLimit" not in plan
    assert len(take_first(frame, 10, ["a", "b", "c"]).collect()) == 10


def write_lines(path, lines):
    path.write_text("".join(line + "\n" for line in lines))


def test_first_samples_open_the_first_files_only(spark, tmp_path):
    good = '{"instruction": "%d", "input": "{}", "output": "x"}'
    write_lines(tmp_path / "a 1.jsonl", ["", *[good % i for i in range(300)], "  \t"])
    write_lines(tmp_path / "b.jsonl", [*[good % i for i in range(300, 500)], "not read {", "not read either"])
    for name in "cdefgh":
        write_lines(tmp_path / f"{name}.jsonl", ["{broken"])
    for n, files in ((1, 1), (300, 1), (301, 2), (500, 2)):
        found = read_samples(spark, str(tmp_path), first=n)
        assert len({f for f in found.inputFiles()}) == files
        assert sorted((r.sample_id, r.instruction) for r in found.collect()) == [(i, str(i)) for i in range(n)]
    with pytest.raises(Exception):
        read_samples(spark, str(tmp_path), first=501).collect()
    few = read_samples(spark, [str(tmp_path / "a 1.jsonl")], first=10_000)
    assert few.count() == 300


def test_profiles_of_parts_merge_to_that_of_the_whole(spark):
    made = spark.range(60_000).select(F.format_string('{"function":{"name":"tool %d"}}', F.col("id") % 25_000).alias("input"), (F.col("id") % 7).alias("file"))
    parts = profile_parts(made, "file")
    whole, exact = profile_of_parts(parts).first(), dataset_profile(made).first()
    assert (whole.num_samples, whole.size_category) == (exact.num_samples, exact.size_category) and exact.num_tools == 25_000
    assert abs(whole.num_tools - exact.num_tools) <= 0.03 * exact.num_tools
    # a file that comes later costs its own profile; merging in steps gives the same
    older, newer = profile_parts(made.where("file < 6"), "file"), profile_parts(made.where("file = 6"), "file")
    assert profile_of_parts(merge_profiles(older, F.lit(0).alias("file")).unionByName(newer.withColumn("file", F.col("file").cast("int")))).first() == whole
    few = profile_of_parts(profile_parts(made.where("id < 40"), "file")).first()
    assert (few.num_samples, few.num_tools) == (40, 40)
    assert tuple(profile_of_parts(profile_parts(made.where("false"), "file")).first()) == (0, 0, "n<1K")
