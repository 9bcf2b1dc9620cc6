"""Benchmark decontamination: which documents hold a passage that is nearly a benchmark item.

Windows of an item's number of words are laid over the documents wherever they share a shingle with some item,
starting where the item would start. A window gets the weighted SimHash of its distinct shingles: each votes on every bit with
its weight, 1 + ln(items / items that have it), or 1 + ln(items) if no item has it. The 64 bits are divided into BLOCKS. Two
fingerprints that differ in at most RADIUS bits differ in at most RADIUS / BLOCKS of them in some block, so the items are indexed
under every value within that distance of theirs, and windows look up their own values: none within the radius is missed.
Of random pairs of equal word number one in seven meets. Candidates within the radius are verified by the exact
similarity, weight of the shared shingles over weight of all. A window as near as SIMILARITY shares a shingle with its item, and
differs from it in 10 bits on average, with a deviation of 3.

Shingles are five words, lower-cased A-Z. An item of fewer words has its whole word sequence as one shingle; an item
without words is nothing to look for. Null and empty texts hold nothing. Windows that the document's begin or end cuts are
compared as far as they go. Whole texts of any length are searched. Ties at the limit count as found. Repeated items are found each under
its own id; repeated rows of a document give its result once. Null ids are kept and compared as equal. Empty tables give an empty result. Columns other than the
named ones are not looked at.

The main path is DataFrame functions only. The items' shingles are broadcast only if their number is below a bound,
and joined by shuffle otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import bound, stored

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCKS = 4
WEIGHT_UNIT = 2.0**-20  # votes are whole numbers of it, so that their sums don't hang on their order
MOST_BROADCAST = 1_000_000
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of characters other than space and \\x09-\\x0D, lower-cased A-Z; null and blank texts have none."""
    bare = F.trim(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[\\x20\\x09-\\x0D]+"))


def shingles(of: Column, size: int) -> Column:
    """The hash of every run of size words, in order."""
    hashes = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(F.lit(size), *[F.get(w, i + k) for k in range(size)]))
    return F.when(F.size(of) >= size, bound(of, hashes)).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: DataFrame, key: str) -> DataFrame:
    """key and print of each key's (hash, weight): a bit is set if those with it outweigh those without."""
    vote = F.round(F.col("weight") / F.lit(WEIGHT_UNIT)).cast("long")
    votes = [F.sum(F.when(F.getbit("hash", F.lit(b)) == 1, vote).otherwise(-vote)).alias(f"bit_{b}") for b in range(64)]
    bits = [F.when(F.col(f"bit_{b}") > 0, F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("long") for b in range(64)]
    return hashes.groupBy(key).agg(*votes).select(key, reduce(Column.bitwiseOR, bits).alias("print"))


def _cuts(n: int) -> list[tuple[int, int]]:
    cuts = [64 * k // n for k in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def blocks(fingerprint: Column, n: int = BLOCKS) -> Column:
    """(number, value) of the n blocks that divide the 64 bits."""
    parts = [F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value")) for k, (a, b) in enumerate(_cuts(n))]
    return F.array(*parts)


def probes(prints: DataFrame, radius: int = RADIUS, n: int = BLOCKS) -> DataFrame:
    """Each row with each block and value that a print within the radius may have in common with its own: those within radius / n bits."""
    widths = [b - a for a, b in _cuts(n)]
    every = prints.sparkSession.range(1 << max(widths)).where(F.bit_count("id") <= radius // n)
    changes = every.select("id", F.explode(F.array(*[F.when(F.col("id") < 1 << w, F.lit(k)) for k, w in enumerate(widths)])).alias("block")).where("block is not null")
    own = prints.select("*", F.inline(blocks(F.col("print"), n)))
    return own.join(F.broadcast(changes), "block").withColumn("value", F.col("value").bitwiseXOR(F.col("id"))).drop("id")  # n * 2^(64 / n) rows at most


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, item_id, start_word, n_words, similarity: the nearest window of each document and item found."""
    spark = docs.sparkSession
    split = items.select(items[item_col].alias("item_id"), words(items[item_text_col]).alias("words")).where(F.size("words") > 0)
    sized = split.withColumn("n", F.size("words")).withColumn("size", F.least("n", F.lit(SHINGLE)))
    sizes = sorted(r.size for r in sized.select("size").distinct().collect())  # at most five numbers
    if not sizes:
        return spark.createDataFrame([], "doc_id long, text_hash long, item_id long, start_word int, n_words int, similarity double")
    of_size = lambda c: F.coalesce(*[F.when(F.col("size") == s, shingles(c, s)) for s in sizes])
    known = stored(sized.withColumn("hashes", of_size(F.col("words"))).select(F.monotonically_increasing_id().alias("key"), "item_id", "n", "size", "hashes"))
    n_items = known.count()
    places = known.select("n", "size", F.posexplode("hashes").alias("offset", "hash")).distinct()
    heaviest = F.lit(1.0) + F.log(F.lit(float(n_items)))
    has = known.select("key", F.explode(F.array_distinct("hashes")).alias("hash"))
    weights = stored(has.groupBy("hash").agg((heaviest - F.log(F.count(F.lit(1)).cast("double"))).alias("weight")))
    totals = has.join(weights, "hash").groupBy("key").agg(F.sum("weight").alias("item_weight"))

    texts = docs.select(docs[id_col].alias("doc_id"), F.xxhash64(docs[text_col]).alias("text_hash"), docs[text_col].alias("text"))
    split_docs = texts.select("doc_id", "text_hash", words(F.col("text")).alias("words"))
    by_size = [F.struct(F.lit(s).alias("size"), shingles(F.col("words"), s).alias("hashes")) for s in sizes]
    every = split_docs.select("doc_id", "text_hash", (F.explode(F.array(*by_size)) if len(sizes) > 1 else by_size[0]).alias("s"))
    shown = every.select("doc_id", "text_hash", F.col("s.size").alias("size"), F.posexplode("s.hashes").alias("at", "hash"))
    few = places.count() <= MOST_BROADCAST
    side, weight_side = (F.broadcast(places), F.broadcast(weights)) if few else (places, weights)
    starts = shown.join(side, ["hash", "size"]).select("doc_id", "text_hash", "n", "size", F.greatest(F.col("at") - F.col("offset"), F.lit(0)).alias("start_word")).distinct()
    windows = starts.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("n", "size", "start_word")).alias("windows"))

    held = windows.withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
    cut = texts.join(held, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("text_hash").eqNullSafe(F.col("h"))).dropDuplicates(["doc_id", "text_hash"])
    laid = cut.select("doc_id", "text_hash", words(F.col("text")).alias("words"), F.explode("windows").alias("w"))
    window = laid.select("doc_id", "text_hash", "w.*", F.slice("words", F.col("w.start_word") + 1, F.col("w.n")).alias("words"))
    hashed = window.withColumn("hashes", F.array_distinct(of_size(F.col("words")))).select(F.struct("doc_id", "text_hash", "n", "start_word").alias("window"), "hashes")
    printed = stored(hashed)

    item_prints = simhash(has.join(weights, "hash"), "key").join(known.select("key", "n"), "key")
    shown_hashes = printed.select("window", F.explode("hashes").alias("hash"))
    prints = simhash(shown_hashes.join(weight_side, "hash", "left").withColumn("weight", F.coalesce("weight", heaviest)), "window")
    index = probes(item_prints).withColumnRenamed("print", "item_print")
    asked = prints.select("window", "print", F.col("window.n").alias("n"), F.inline(blocks(F.col("print"))))
    near = asked.join(index, ["n", "block", "value"]).where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS).select("window", "key").distinct()
    pairs = near.join(printed, "window").select("window", "key", F.explode("hashes").alias("hash"))
    weighed = pairs.join(weights, "hash", "left").withColumn("weight", F.coalesce("weight", heaviest)).join(has.withColumn("in_item", F.lit(1)), ["key", "hash"], "left")
    sums = weighed.groupBy("window", "key").agg(F.sum("weight").alias("window_weight"), F.coalesce(F.sum(F.col("weight") * F.col("in_item")), F.lit(0.0)).alias("both")).join(totals, "key")
    scored = sums.withColumn("similarity", F.col("both") / (F.col("window_weight") + F.col("item_weight") - F.col("both"))).where(F.col("similarity") >= similarity - 1e-9)
    best = scored.groupBy("window.doc_id", "window.text_hash", "key").agg(F.max(F.struct("similarity", (-F.col("window.start_word")).alias("back"), F.col("window.n").alias("n"))).alias("b"))
    named = best.join(known.select("key", "item_id"), "key")
    return named.select("doc_id", "text_hash", "item_id", (-F.col("b.back")).cast("int").alias("start_word"), F.col("b.n").cast("int").alias("n_words"), F.col("b.similarity").alias("similarity"))


def without(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents in which nothing was found, with all their columns."""
    hit = found.select(F.col("doc_id").alias("hit_doc_id"), F.col("text_hash").alias("hit_text_hash")).distinct()
    return docs.join(hit, docs[id_col].eqNullSafe(hit["hit_doc_id"]) & F.xxhash64(docs[text_col]).eqNullSafe(hit["hit_text_hash"]), "left_anti")
