"""What the operators of this subpackage share: shared scratch tables and table access."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN = "toolloom.llm.scratch"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder (not yet made) below spark.checkpoint.dir, which all executors share.

    Where that setting is missing, a local session gets a temporary folder of its own, a cluster an error. A path
    without a scheme is one of Hadoop's default file system, as it is to Spark.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="toolloom-")
        spark.conf.set(_OWN, base)
    return f"{qualified(spark, base).rstrip('/')}/toolloom-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """The absolute path with its scheme; without one it is of Hadoop's default file system."""
    if "://" in path or path.startswith("file:/"):
        return path
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    return f"{'file://' if default == 'file:///' else default.rstrip('/')}/{path.lstrip('/')}"


def stored(frame: DataFrame) -> DataFrame:
    """Writes the frame to the shared scratch folder and reads it back: it is computed once and survives lost executors."""
    spark, path = frame.sparkSession, scratch_dir(frame.sparkSession)
    schema = frame.schema
    frame.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def renamed(frame: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names on the left; other columns may clash as they like."""
    return frame.select(*[frame[old].alias(new) for new, old in columns.items()])


def crc_remainder(key: Column, by: int) -> Column:
    """crc32 of the key as text, modulo by; the fold that train and held-out rows are told apart with."""
    return F.crc32(key.cast("string").cast("binary")) % by


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) where value is worked out once, even if body uses it inside the functions of arrays."""
    return F.get(F.transform(F.array(value), body), 0)


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", share: int = 1000) -> DataFrame:
    """left joined to right, which has one row for each key, however many rows of left have the same key.

    Keys that hold more than 1 / share of left's rows are fewer than share: their rows of right are broadcast, and only
    the others are shuffled. Both sides are read several times, so they should be stored. Null keys join nothing.
    """
    many = left.count() / share
    hot = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > many).select(*keys)
    hot_rows = F.broadcast(right.join(F.broadcast(hot), keys, "left_semi").withColumn("_hot", F.lit(True)))
    marked = left.join(hot_rows.select(*keys, "_hot"), keys, "left")
    others = marked.where("_hot is null").drop("_hot").join(right, keys, how)
    return left.join(hot_rows.drop("_hot"), keys).unionByName(others)
