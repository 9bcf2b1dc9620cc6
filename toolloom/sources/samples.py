"""Training samples from and to JSON lines."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from toolloom import schemas
from toolloom.operators.samples import SAMPLE_COLUMNS

_ROW_IN_TASK = (1 << 33) - 1


def read_samples(spark: SparkSession, path: str | list[str], first: int | None = None) -> DataFrame:
    """``(sample_id, instruction, input, output)``, numbered 0, 1, 2, ... in file order; blank lines don't count.

    A missing path is an error from Spark, and so is a line that is not JSON.
    No sample at all is a ValueError. With ``first`` only that many samples are
    read, and only the files that hold them are opened; lines after them are not parsed.
    """
    lines = _lines(spark, path)
    if lines.isEmpty():
        raise ValueError(f"dataset is empty: {path}")
    numbered = _numbered(_lines(spark, _first_files(spark, lines, first)) if first else lines)
    kept = numbered.where(F.col("sample_id") < first) if first else numbered
    parsed = F.from_json("value", schemas.SAMPLE, {"mode": "FAILFAST"})
    return kept.select("sample_id", parsed.alias("_sample")).select("sample_id", *[F.col(f"_sample.{c}") for c in SAMPLE_COLUMNS])


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines that are not blank, as text, with where they come from."""
    placed = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))
    return placed.where(F.length(F.btrim("value", F.lit(" \t\r"))) > 0)


def _first_files(spark: SparkSession, lines: DataFrame, first: int) -> list[str]:
    """The least number of files, in their order, that hold the first lines: counted one, two, four, ... at a time."""
    files = [_plain(f) for f in sorted(lines.inputFiles())]
    known, taken = 0, 0
    while taken < len(files):
        more = files[taken : taken + max(1, taken)]
        counts = {_plain(r["_file"]): r["count"] for r in _lines(spark, more).groupBy("_file").count().collect()}
        for file in more:
            known, taken = known + counts.get(file, 0), taken + 1
            if known >= first:
                return files[:taken]
    return files


def _plain(file: str) -> str:
    """A file's name as a path to read; Spark writes local ones with one slash or three, and some signs encoded."""
    return unquote(re.sub("^file:/+", "file:///", file))


def _numbered(lines: DataFrame) -> DataFrame:
    """Dense row numbers without sorting or shuffling the rows.

    A first pass counts the lines of every file split, without parsing them. Running totals give each
    split its first number: inside its file, and over the files, so that no task
    sees more than the splits of one file or one row per file. How the table of splits
    is joined is left to Spark.
    """
    placed = lines.withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_IN_TASK)))
    before = Window.unboundedPreceding, -1
    counts = placed.groupBy("_file", "_start").agg(F.count("*").alias("_count"), F.min("_row").alias("_first"))
    in_file = F.sum("_count").over(Window.partitionBy("_file").orderBy("_start").rowsBetween(*before))
    files = counts.groupBy("_file").agg(F.sum("_count").alias("_size"))
    over_files = F.sum("_size").over(Window.orderBy("_file").rowsBetween(*before))
    begins = files.select("_file", F.coalesce(over_files, F.lit(0)).alias("_begin"))
    splits = counts.withColumn("_earlier", F.coalesce(in_file, F.lit(0))).join(begins, "_file")
    splits = splits.select("_file", "_start", (F.col("_begin") + F.col("_earlier") - F.col("_first")).alias("_shift"))
    return placed.join(splits, ["_file", "_start"]).select((F.col("_row") + F.col("_shift")).alias("sample_id"), "value")


def write_samples(samples: DataFrame, path: str) -> str:
    """Overwrite ``path`` with JSON lines of the three sample fields."""
    samples.select(*SAMPLE_COLUMNS).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def count_samples(spark: SparkSession, path: str) -> DataFrame:
    """``num_samples``: lines of a file, or of the ``.jsonl`` files of a directory.

    Lines are counted as they are, blank ones too, and only in the directory
    itself.
    """
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    is_dir = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(jvm_path).isDirectory()
    reader = spark.read.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", "false") if is_dir else spark.read
    return reader.text(path).agg(F.count("*").alias("num_samples"))
