"""From documents to token files in stages; each stage's result is written and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolloom.llm import decontaminate, mixing, set_join, token_files, toxicity
from toolloom.llm.common import crc_remainder, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic; learned from the labels of the training fold."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), usable=crc_remainder(F.col("doc_id"), 5) != 0)
    scored = toxicity.score(docs, model, keep=COLUMNS).where("score < 0.5")
    return scored.select(*[F.col(f"kept_{c}").alias(c) for c in COLUMNS])


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the least id; of repeated rows one. Documents without id stay."""
    groups = set_join.near_groups(docs, near=80, of=100)
    more = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("id")).distinct()
    return docs.join(more, F.col("doc_id") == F.col("id"), "left_anti").dropDuplicates(["doc_id", "text"]).select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontaminate.without(docs, decontaminate.find(docs, table(spark, sf_dir, "benchmark"), similarity=0.8)).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    taken = mixing.mix(docs, weights=(3, 1, 2), share=1.5, keep=COLUMNS).where("copies > 0")
    again = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return again.select(*[F.col(f"kept_{c}").alias(c) for c in COLUMNS])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' documents, as read back."""
    manifest = token_files.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_tokens(manifest, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean),
    ("near_duplicates", single),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_files", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
