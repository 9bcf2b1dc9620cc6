import pytest

from toolloom.llm import common


@pytest.mark.parametrize(
    "default, given, want",
    [
        ("file:///", "/shared/x", "file:///shared/x"),
        ("hdfs://name:8020", "/shared/x", "hdfs://name:8020/shared/x"),
        ("hdfs://name:8020/", "/shared/x", "hdfs://name:8020/shared/x"),
        ("hdfs://name:8020", "s3a://bucket/x", "s3a://bucket/x"),
        ("hdfs://name:8020", "file:/shared/x", "file:/shared/x"),
    ],
)
def test_paths_without_a_scheme_are_of_the_default_file_system(spark, default, given, want):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    before = hadoop.get("fs.defaultFS")
    try:
        hadoop.set("fs.defaultFS", default)
        assert common.qualified(spark, given) == want
    finally:
        hadoop.set("fs.defaultFS", before)


def test_scratch_folders_are_new_and_have_a_scheme(spark):
    one, two = common.scratch_dir(spark), common.scratch_dir(spark)
    assert one != two and one.startswith("file:/")
