"""The registered queries of this subpackage: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toolloom.llm import alignment, chunk_dedup, decontaminate, lm_score, manifest, metric_join, mixing, pii, quality, set_join, threads, token_files, toxicity
from toolloom.llm.checks import llm_checks
from toolloom.llm.common import crc_remainder, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), similarity=0.8)
    return found.select("doc_id", "item_id", "start_word", "n_words", "similarity")


def op2_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunk_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", F.inline("spans"))
    return found.select("doc_id", F.col("start").alias("start_char"), F.col("end").alias("end_char"), "n_words", "stays")


def op3_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = threads.threads(table(spark, sf_dir, "conversations"))
    turns = F.transform("path", lambda p: F.struct(p["conv"].alias("conv_id"), p["turn"].alias("turn")))
    return found.select("thread", turns.alias("path"), "depth", F.col("conv").alias("conv_id"), "turn", "role", "text", "has_quotes", "parent_conv", "parent_turn")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = crc_remainder(F.col("doc_id"), 7) == 2
    scored = lm_score.score_texts(table(spark, sf_dir, "documents"), train=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base, both = pii.listed(F.col("base")), pii.listed(pii.merged(F.col("base"), F.col("found")))
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(base, 256).alias("base_sha256"), both.alias("spans"))


def op7_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.near_groups(table(spark, sf_dir, "documents"), near=80, of=100)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_tokens(manifest, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), usable=crc_remainder(F.col("doc_id"), 5) != 0)
    scored = toxicity.score(docs, model, keep=["doc_id"])
    doc_id = F.col("kept_doc_id")
    return scored.select(doc_id.alias("doc_id"), (crc_remainder(doc_id, 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.apply_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "outside"
    )


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    parts = alignment.aligned_parts(table(spark, sf_dir, "documents"), *files)
    found = alignment.align(parts, alignment.pair_counts(parts))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cut = F.when(crc_remainder(docs["doc_id"], 2) == 0, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])
    found = manifest.verify(docs, {"text": cut})
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


def op13_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = metric_join.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    dealt = (
        op1_decontaminate, op2_chunk_dedup, op3_threads, op4_lm_score, op5_mixing, op6_personal_data, op7_set_join, op8_token_files,
        op9_toxicity, op10_quality_rules, op11_alignment, op12_manifest, op13_metric_join,
    )
    return {f.__name__: f for f in dealt}


__all__ = ["llm_checks", "llm_queries"]
