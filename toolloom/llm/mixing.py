"""Mixing sources to target token weights by entropy balancing.

A document of size x gets the rate 2 / (1 + exp(-(b + l * x / m))): the rates nearest in (bounded) entropy to a common
base rate that meet the token target of each source, tilted exponentially by size, never above MOST copies. b belongs to
the base rate, m is the mean size of the source's words, and l is the source's multiplier, the solution of the convex dual, found by
Newton steps that are kept inside a bracket. Every step is one aggregation over the counts of (source, size), which
hold all that the dual depends on; its sums are of integers, so neither partitioning nor retries change a rate.

Rates become copies by a hash of the id: whole copies, and one more where the hash falls below the fraction. The
source's offset to that comparison is then set from sums by hash bucket so that the words taken meet the target as
near as one bucket of documents allows. No rows are drawn at random: reruns agree in every column.

Null texts and ids are allowed (size 0; one null id hashes as the text "null"); documents of size 0 take 0 words. Null
is a source of its own, after all others. Rows with equal id and size share their fate. Sources without words have target 0. Empty tables
give empty results. Only the named columns are looked at.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toolloom.llm.common import stored

MOST = 2
BUCKETS = 4096
STEPS = 60
CLOSE = 1e-6


def word_count(text: Column) -> Column:
    """Number of runs of bytes other than space and \\x09-\\x0D."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float], share: float) -> DataFrame:
    """source, source_size, target. sources has one row per source (source, source_size).

    By code point, null last, the sources weigh as listed, over and over. The total is share of all sizes; a target
    stops at MOST times the source's size and the excess is shared anew by weight until none is above.

    Sharing in rounds fills first the sources with the least room for their weight; so all rounds are one running
    sum in the order of source_size / weight: a source is full if the level reached without it is above its own.
    """
    place = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sources.withColumn("k", (F.row_number().over(place) - 1) % len(weights))
    weighed = ranked.withColumn("weight", F.array(*[F.lit(float(w)) for w in weights])[F.col("k")])
    room = weighed.withColumn("room", MOST * F.col("source_size").cast("double")).withColumn("at", F.col("room") / F.col("weight"))
    order = Window.orderBy("at", F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    filled = (
        room.withColumn("total", F.sum("source_size").over(whole) * share)
        .withColumn("used", F.coalesce(F.sum("room").over(before), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("used")) / F.col("left"))
        .withColumn("full", F.col("level") >= F.col("at"))
    )
    # levels fall from the first source that is not full: that one holds
    last = filled.withColumn("level", F.max(F.when(~F.col("full"), F.col("level"))).over(whole))
    return last.select("source", F.col("source_size"), F.when(F.col("full"), F.col("room")).otherwise(F.col("level") * F.col("weight")).alias("target"))


def _rate(base: float, tilt: Column, x: Column) -> Column:
    """The tilted rate; base is the logit of the base rate over MOST."""
    return MOST / (1 + F.exp(-(F.lit(base) + tilt * x)))


def _exactly(words: Column, factor: Column, bits: int) -> Column:
    """Sum of words * factor with the factor cut to so many binary places: integers, so the order of rows is of no matter."""
    whole = F.floor(factor * float(1 << bits)).cast("decimal(18,0)")
    return F.coalesce(F.sum(words.cast("decimal(19,0)") * whole), F.lit(0)).cast("double") / float(1 << bits)


def _same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joins on the source, null being one; the right side's other columns come along."""
    named = right.withColumnRenamed("source", "_source")
    return left.join(named, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def tilts(sizes: DataFrame, wanted: DataFrame, base: float) -> DataFrame:
    """wanted with scale, full and tilt. sizes: source, size, n (documents); wanted: source, source_size, target.

    One aggregation a step; the multipliers and their brackets are a table of one row per source, written at each step.
    Only the question whether any is still open comes to the driver. A source that STEPS steps don't settle is an error.
    """
    squares = F.sum((F.col("n") * F.col("size")).cast("decimal(19,0)") * F.col("size").cast("decimal(18,0)")).cast("double")
    scale = sizes.groupBy("source").agg((squares / F.greatest(F.sum(F.col("n") * F.col("size")), F.lit(1))).alias("scale"))
    full = F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12)
    none = F.lit(None).cast("double")
    begin = _same_source(wanted, scale).select("source", "source_size", "target", "scale", full.alias("full"), F.lit(0.0).alias("tilt"), none.alias("low"), none.alias("high"))
    state = stored(begin.withColumn("open", ~F.col("full") & (F.col("source_size") > 0)))
    x = F.col("size") / F.col("scale")
    rate = _rate(base, F.col("tilt"), x)
    words = F.col("n") * F.col("size")
    for _ in range(STEPS):
        if state.where("open").isEmpty():
            return state.drop("low", "high", "open")
        joined = _same_source(sizes.where("size > 0"), state.where("open"))
        taken = _exactly(words, rate, 52).alias("taken")
        slope = _exactly(words, x * rate * (1 - rate / MOST), 30).alias("slope")
        state = stored(_newton(_same_source(state, joined.groupBy("source").agg(taken, slope), "left")))
    if not state.where("open").isEmpty():
        raise ArithmeticError(f"{STEPS} steps did not settle the mix: {state.where('open').drop('low', 'high').limit(5).collect()}")
    return state.drop("low", "high", "open")


def _newton(state: DataFrame) -> DataFrame:
    """One step of each open multiplier: Newton's if it stays inside the bracket, else the bracket is halved or widened."""
    gap = F.col("target") - F.col("taken")
    moves = F.col("open") & (F.abs(gap) > CLOSE * F.col("target"))
    above = gap < 0
    bracket = state.withColumn("open", moves).withColumns(
        {"low": F.when(moves & ~above, F.col("tilt")).otherwise(F.col("low")), "high": F.when(moves & above, F.col("tilt")).otherwise(F.col("high"))}
    )
    tilt, low, high = F.col("tilt"), F.col("low"), F.col("high")
    step = F.when(F.col("slope") > 0, tilt + gap / F.col("slope"))
    inside = F.coalesce(step > low, F.lit(True)) & F.coalesce(step < high, F.lit(True)) & (F.abs(step - tilt) < 8 * (1 + F.abs(tilt)))
    other = F.when(low.isNull(), F.least(2 * high, high - 1)).when(high.isNull(), F.greatest(2 * low, low + 1)).otherwise((low + high) / 2)
    new = F.when(step.isNotNull() & inside, step).otherwise(other)
    return bracket.withColumn("tilt", F.when(F.col("open"), new).otherwise(tilt)).drop("taken", "slope")


def _with_rates(docs: DataFrame, plan: DataFrame, base: float) -> DataFrame:
    """docs (doc_id, source, size and what else they have) with what their source's row says, rate, whole and bucket.

    One more copy goes to the documents whose bucket is not above the source's cut; buckets order the gaps between
    the id's hash and the rate's fraction.
    """
    rate = F.when(F.col("size") == 0, 0.0).when(F.col("full"), F.lit(float(MOST))).otherwise(_rate(base, F.col("tilt"), F.col("size") / F.col("scale")))
    u = (F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(1)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    gap = u - (F.col("rate") - F.col("whole"))
    return (
        _same_source(docs, plan)
        .withColumn("rate", rate)
        .withColumn("whole", F.floor("rate"))
        .withColumn("bucket", F.least(F.floor((gap + 1) / 2 * BUCKETS), F.lit(BUCKETS - 1)))
    )


def plan_mix(sized: DataFrame, weights: Sequence[float], share: float) -> tuple[DataFrame, float]:
    """One row per source: source, source_size, target, scale, full, tilt, cut; and the base rate's logit. sized: doc_id, source, size."""
    counts = stored(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    even = min(share, MOST * (1 - 1e-9)) / MOST
    base = math.log(even / (1 - even))
    tilted = tilts(counts, targets(sources, weights, share), base)
    rated = _with_rates(sized, tilted, base).where("size > 0")
    free = F.col("whole") < MOST
    found = rated.groupBy("source", "target", F.when(free, F.col("bucket")).alias("bucket")).agg(F.sum("size").alias("words"), F.sum(F.col("size") * F.col("whole")).alias("sure"))
    inside = Window.partitionBy("source", "target")
    sums = found.withColumn("sure", F.sum("sure").over(inside)).withColumn("upto", F.col("sure") + F.sum(F.when(F.col("bucket").isNotNull(), F.col("words"))).over(inside.orderBy("bucket")))
    # the last bucket whose end is not farther from the target than its begin
    nearer = F.abs(F.col("upto") - F.col("target")) <= F.abs(F.col("upto") - F.col("words") - F.col("target"))
    cuts = sums.where("bucket is not null").where(nearer).groupBy("source").agg(F.max("bucket").alias("cut"))
    return stored(_same_source(tilted, cuts, "left").withColumn("cut", F.coalesce("cut", F.lit(-1)))), base


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken and the columns to keep; one row per document."""
    named = docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"), word_count(docs[text_col]).alias("size"), *[docs[c].alias(f"kept_{c}") for c in keep])
    sized = stored(named.select("doc_id", "source", "size"))
    plan, base = plan_mix(sized, weights, share)
    more = (F.col("whole") < MOST) & (F.col("bucket") <= F.col("cut"))
    copies = F.when(F.col("size") == 0, 0).otherwise(F.col("whole") + F.when(more, 1).otherwise(0)).cast("int")
    final = _with_rates(named if keep else sized, plan, base).withColumn("copies", copies)
    return final.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"), *[F.col(f"kept_{c}").alias(f"kept_{c}") for c in keep])
