"""Train and test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toolloom import fixed_values as fixed
from toolloom.functions import sql
from toolloom.functions.hashing import HASH_RANGE, hash32

# Rows of one bucket of the exact split end up in one task: n / 2^20 of n rows.
_BUCKETS = 1 << 20


def train_test_split(
    df: DataFrame,
    key: str | list[str],
    test_size: float = fixed.TEST_SIZE,
    seed: int = fixed.SPLIT_SEED,
    mode: str = "hash",
    group_by: str | list[str] | None = None,
) -> DataFrame:
    """Add ``split``, train or test; every row gets exactly one.

    ``hash`` decides row by row, so it needs no shuffle and a row keeps its side
    when others are added. ``exact`` puts exactly ceil(n * test_size) rows in
    test; its key has to be unique. With ``group_by`` whole groups are dealt out
    instead of rows: rows that share it are never on both sides, and ``exact``
    counts groups.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must be between 0 and 1")
    keys, score = _scored(group_by or key, seed)
    if mode == "hash":
        is_test = score < int(test_size * HASH_RANGE)
        return df.withColumn("split", F.when(is_test, "test").otherwise("train"))
    if mode == "exact":
        return split_at(df, split_border(df, key, test_size, seed, group_by), key, seed, group_by)
    raise ValueError(f"unknown mode: {mode}")


def _scored(key: str | list[str], seed: int) -> tuple[list[str], Column]:
    keys = [key] if isinstance(key, str) else list(key)
    return keys, F.expr(hash32(f"concat_ws('|', '{seed}', {', '.join(sql.name(k) for k in keys)})"))


def split_at(df: DataFrame, border: DataFrame, key: str | list[str], seed: int = fixed.SPLIT_SEED, group_by: str | list[str] | None = None) -> DataFrame:
    """Add ``split`` by the border of an exact split, which may have been kept from an earlier state of the table.

    Kept, it moves no row that was there: rows added since are dealt out by the same
    border. A new one from :func:`split_border` makes the size exact again and
    moves only rows that lie between the two.
    """
    keys, score = _scored(group_by or key, seed)
    place = F.struct(score.alias("score"), *[F.col(sql.name(k)) for k in keys])
    return df.withColumn("split", F.when(place <= border.select("place").scalar(), "test").otherwise("train"))


def split_border(df: DataFrame, key: str | list[str], test_size: float = fixed.TEST_SIZE, seed: int = fixed.SPLIT_SEED, group_by: str | list[str] | None = None) -> DataFrame:
    """``place``: one row, the last place (score and keys) of the test side of an exact split. Write it to keep it."""
    keys, score = _scored(group_by or key, seed)
    return _exact(df, keys, score, test_size, group_by is not None)


def _exact(df: DataFrame, keys: list[str], score: Column, test_size: float, grouped: bool) -> DataFrame:
    """The border of the exact size without ordering all rows, from two scans of the keys alone.

    A histogram of the score, of a fixed number of buckets, tells in which
    bucket the test side ends, and a second look at that bucket after which
    score and key.
    """
    place = F.struct(score.alias("score"), *[F.col(sql.name(k)) for k in keys])
    places = df.select(place.alias("place"))
    places = places.distinct() if grouped else places
    bucketed = places.withColumn("bucket", F.floor(F.col("place.score") / (HASH_RANGE // _BUCKETS)))
    histogram = bucketed.groupBy("bucket").agg(F.count("*").alias("n"))
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        histogram.withColumn("upto", F.sum("n").over(upto))
        .withColumn("wanted", F.ceil(F.max("upto").over(Window.partitionBy()) * F.lit(test_size)))
        .where((F.col("upto") >= F.col("wanted")) & (F.col("upto") - F.col("n") < F.col("wanted")))
        .select(F.struct("bucket", (F.col("wanted") - F.col("upto") + F.col("n")).alias("rest")).alias("last"))
    )
    end = bucketed.withColumn("last", last.scalar()).where(F.col("bucket") == F.col("last.bucket"))
    ranked = end.withColumn("rank", F.row_number().over(Window.partitionBy("bucket").orderBy("place")))
    return ranked.where(F.col("rank") == F.col("last.rest")).select("place")
