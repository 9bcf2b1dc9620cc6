"""Quality rules with thresholds that follow the data.

Every document gets its measures; each (language, source) gets quantile sketches of them, which merge, so any number of
partial sketches gives one. Fences stand FENCE times a spread outside the quartiles, as in a box plot. The spread is that between the
group's quartiles plus the document's own sampling error: a share of k units scatters by sqrt(p (1 - p) / k) around the group's p, so
short texts have more room and long ones less, without a fixed least room. Fences leave ordinary documents of a language and source alone, whatever is
ordinary there, and fixed cutoffs stay for the base rules only. A document is kept if it passes the base rules and no
measure lies outside the fences of its group.

Null texts have no words and fail the base rules. Null language or source is a group of its own. A group's quartiles are blended
with those of its language, and these with those of all documents: n documents weigh n, what is above them PRIOR; a new or
small group thus has nearly the fences of its language. Repeated rows count as often as they occur, ties with a fence are inside. Empty tables
give empty results. Very long texts are measured whole, each in its row.
Columns other than the named ones are not looked at. Words are runs of characters other than space and \\x09-\\x0D.

The main path is DataFrame functions only. The windows of five words are compared inside the row: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import bound, stored

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
FENCE = 4.0
PRIOR = 10.0
PASSAGE = 20
#: measure: (fence below, fence above)
MEASURES = {
    "word_length": (True, True),
    "symbol_share": (False, True),
    "dup_line_share": (False, True),
    "repeat_share": (False, True),
    "distinct_share": (True, False),
    "upper_share": (False, True),
}


def sampling_error(measure: str, usual: Column) -> Column:
    """How far a document's measure scatters by chance around the usual one, by its number of words or lines.

    Repeated words come in passages, so PASSAGE words are one unit. Word lengths scatter by about their mean, numbers of distinct words by their root.
    """
    words = F.greatest(F.col("n_words"), F.lit(2)).cast("double")
    if measure == "word_length":
        return usual / F.sqrt(words)
    if measure == "distinct_share":
        return 1 / (F.sqrt(words) * F.log(words))
    units = F.greatest({"dup_line_share": F.col("n_lines"), "repeat_share": words / PASSAGE}.get(measure, words), F.lit(1)).cast("double")
    p = (usual * units + 1) / (units + 2)
    return F.sqrt(p * (1 - p) / units)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source, the counts and the shares that the fences apply to."""
    named = docs.select(docs[id_col].alias("doc_id"), docs[lang_col].alias("lang"), docs[source_col].alias("source"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    nothing = F.translate("text", WHITE, "")
    lines = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]")))
    split = named.select(
        "doc_id", "lang", "source",
        F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "").alias("words"),
        F.length(nothing).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(nothing) - F.length(F.translate(nothing, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_upper"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.array_distinct(lines)).cast("long").alias("n_own_lines"),
    )
    n = F.size("words")
    windows = lambda w: F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    hashes = F.when(n >= WINDOW, bound(F.col("words"), windows))
    hashed = split.withColumn("hashes", hashes).withColumn("n_words", n.cast("long")).withColumn("n_kinds", F.size(F.array_distinct("words")).cast("long")).drop("words")
    counted = hashed.withColumn("n_repeat_words", _covered(F.col("hashes"))).drop("hashes")
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return counted.withColumn("n_dup_lines", F.col("n_lines") - F.col("n_own_lines")).select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        share(F.col("word_chars"), F.col("n_words")).alias("word_length"),
        share(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"),
        share(F.col("n_dup_lines"), F.col("n_lines")).alias("dup_line_share"),
        share(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_share"),
        # distinct words fall with length; Herdan's constant doesn't
        F.when(F.col("n_words") > 1, F.log("n_kinds") / F.log("n_words")).otherwise(1.0).alias("distinct_share"),
        share(F.col("n_upper"), F.col("word_chars")).alias("upper_share"),
    )


def _covered(hashes: Column) -> Column:
    """Number of words in windows whose hash occurs twice or more; most texts have none, which a distinct count shows."""

    def repeated(p: Column) -> Column:
        own = lambda x, i: F.coalesce((F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"]), F.get(p, i - 1)["h"] == x["h"], F.get(p, i + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(p, own), lambda x: x["i"]))

    def width(at: Column) -> Column:
        gaps = F.transform(at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(hashes.isNotNull() & some, bound(bound(pairs, repeated), width)).otherwise(F.lit(0)).cast("long")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def fences(measured: DataFrame) -> DataFrame:
    """lang, source, and for each measure the quartiles that its fences stand on; one row per group that occurs."""
    good = measured.where(~base_failed())
    sketch = good.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(m).alias(m) for m in MEASURES])
    present = measured.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source")).distinct()
    same = F.col("g_lang").eqNullSafe(F.col("lang")) & F.col("g_source").eqNullSafe(F.col("source"))
    groups = stored(present.join(sketch, same, "left").drop("lang", "source"))
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(m).alias(m) for m in MEASURES]]
    full = groups.where("n > 0")
    langs = full.groupBy(F.col("g_lang").alias("l_lang")).agg(*merged).withColumnsRenamed({"n": "l_n"} | {m: f"l_{m}" for m in MEASURES})
    every = full.agg(*merged).withColumnsRenamed({"n": "a_n"} | {m: f"a_{m}" for m in MEASURES})
    joined = groups.join(langs, F.col("g_lang").eqNullSafe(F.col("l_lang")), "left").join(F.broadcast(every), F.lit(True), "left")  # one row

    def quartile(m: str, q: float) -> Column:
        blend = F.lit(None).cast("double")
        for prefix in ("a_", "l_", ""):
            n, own = F.coalesce(F.col(f"{prefix}n"), F.lit(0)), F.kll_sketch_get_quantile_double(F.col(f"{prefix}{m}"), F.lit(q))
            blend = F.when(n > 0, F.when(blend.isNull(), own).otherwise((n * own + PRIOR * blend) / (n + PRIOR))).otherwise(blend)
        return blend

    return joined.select("g_lang", "g_source", *[quartile(m, q).alias(f"{m}_{s}") for m in MEASURES for q, s in ((0.25, "q1"), (0.75, "q3"))])


def apply_rules(docs: DataFrame, **columns: str) -> DataFrame:
    """The measures of every document with base_failed, kept and the measures outside their fences."""
    measured = stored(measures(docs, **columns))
    limits = stored(fences(measured))
    joined = measured.join(limits, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")), "left")

    def beyond(m: str) -> Column:
        below, above = MEASURES[m]
        q1, q3 = F.col(f"{m}_q1"), F.col(f"{m}_q3")
        low, high = F.col(m) < q1 - FENCE * (q3 - q1 + sampling_error(m, q1)), F.col(m) > q3 + FENCE * (q3 - q1 + sampling_error(m, q3))
        return F.when((low if below else F.lit(False)) | (high if above else F.lit(False)), F.lit(m))

    outside = F.filter(
        F.array(*[beyond(m) for m in MEASURES]),
        lambda x: x.isNotNull(),
    )
    judged = joined.withColumn("outside", outside).withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("outside") == 0)).drop("g_lang", "g_source", *[f"{m}_{s}" for m in MEASURES for s in ("q1", "q3")])
