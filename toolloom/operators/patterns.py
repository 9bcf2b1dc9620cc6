"""Substring tests against a table of patterns, however many, as equi joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 8


def _grams(text: Column, size: Column) -> Column:
    """The distinct pieces of so many characters of a text; none if it is shorter."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    pieces = F.transform(starts, lambda i: F.substr(text, i, size))
    return F.when(F.length(text) >= size, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


def match_patterns(texts: DataFrame, patterns: DataFrame, text: str = "path", pattern: str = "namespace", gram: int = GRAM) -> DataFrame:
    """``(text, pattern)`` for all different texts and patterns of which the text contains the pattern, compared as written.

    A text that contains a pattern contains each piece of it, so every pattern is
    looked up by one piece only: the one that the fewest texts have, of ``gram``
    characters, or the whole of a shorter pattern. Texts and patterns meet in an equi
    join on pieces, and ``contains`` decides. Patterns with a piece that no text
    has are gone before. Pieces compress so well that Spark takes large tables of them for
    small ones, so the joins are told not to broadcast. The empty pattern is in every text; nulls match nothing.
    """
    lines = texts.select(F.col(text).alias("_text")).where("_text is not null").distinct()
    wanted = patterns.select(F.col(pattern).alias("_pattern")).where("_pattern is not null").distinct()
    size = F.least(F.length("_pattern"), F.lit(gram))
    pieces = wanted.select("_pattern", F.explode(_grams(F.col("_pattern"), size)).alias("_gram"))
    # only lengths that patterns have are cut from the texts: gram + 1 at most
    lengths = wanted.agg(F.collect_set(size).alias("lengths")).scalar()
    cut = lines.withColumn("_size", F.explode(lengths))
    cut = cut.select("_text", F.explode(_grams(F.col("_text"), F.col("_size"))).alias("_gram"))
    seen = cut.groupBy("_gram").agg(F.count("*").alias("_seen"))
    rarest = pieces.join(seen.hint("merge"), "_gram", "left").groupBy("_pattern").agg(F.min(F.struct(F.coalesce("_seen", F.lit(0)).alias("seen"), "_gram")).alias("_best"))
    index = rarest.where("_best.seen > 0").select("_pattern", F.col("_best._gram").alias("_gram"))
    met = cut.join(index.hint("merge"), "_gram").where(F.col("_text").contains(F.col("_pattern")))
    return met.select(F.col("_text").alias(text), F.col("_pattern").alias(pattern))


def filter_patterns(df: DataFrame, patterns: DataFrame, text: str = "path", pattern: str = "namespace", gram: int = GRAM) -> DataFrame:
    """Rows whose text contains a pattern of the table; a table without patterns keeps all, as an empty list does."""
    found = match_patterns(df, patterns, text, pattern, gram).select(F.col(text).alias("_found")).distinct()
    none = patterns.where(F.col(pattern).isNotNull()).agg((F.count("*") == 0).alias("none")).scalar()
    marked = df.withColumn("_none", none).join(found.hint("merge"), F.col(text) == F.col("_found"), "left")
    return marked.where(F.col("_none") | F.col("_found").isNotNull()).select(*df.columns)
