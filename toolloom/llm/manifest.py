"""Merkle manifest of a dataset: one tree per source, a tree over the sources' roots, and proofs by descent.

H is the lower-case hex sha256 of its inputs joined. A leaf is H of a row's fields, each as its UTF-8 byte count, a colon
and the value, or - if null. Leaves of a source ascend by id; three neighbours (fewer at the end) become their H until one
is left. The sources' roots, null first and then by their bytes, become the root in the same way.

The store holds content-addressed records, digest -> children, in one table per height. Leaf requests descend
from the root: at each height the digests reached are joined to their records, the child that the next rank digit names
is entered and the children not selected are kept as a segment (left, right). Requests that share a path share its row until they
part, so a level has at most as many rows as it has requested nodes, and the root is no hot key. A proof is the
path's segments in reverse, from the leaf up.

Ranks come from ranges of the sorted rows and running counts of those ranges, not from one window per source.

Null ids and sources are allowed: null ids come first, null is a source of its own. Rows with equal ids are ordered by
their digests; equal rows have equal digests, and a record that several places share is stored once. Texts are hashed
whole where they are read and never shuffled. An empty table has no root and gives no rows. Columns other than the named ones are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toolloom.llm.common import shuffle_partitions, stored

WIDTH = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SEGMENTS = "array<struct<left:string,right:string>>"


class Tree(NamedTuple):
    leaves: DataFrame  # tree, rank, digest
    roots: DataFrame  # tree, height, digest
    records: list[DataFrame]  # at place h: digest -> children of the nodes of height h + 1


def field(value: Column) -> Column:
    """A value as it goes into a leaf."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(docs: DataFrame, fields: Sequence[str] = FIELDS, **instead: Column) -> Column:
    """The leaf digest of each row; columns given by name take the place of the table's."""
    return digest(*[field(instead.get(f, docs[f])) for f in fields])


def ranked(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """rows with rank: 0, 1, 2, ... in their tree, by the order columns; no task sees more than a range of the rows."""
    keys = [tree, *order]
    ranges = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys)
    pieces = stored(ranges.withColumn("_piece", F.spark_partition_id()))
    inside = Window.partitionBy("_piece", tree).orderBy(*order)
    counts = pieces.groupBy("_piece", tree).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(tree).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as ranges
    starts = counts.select(F.col("_piece").alias("_p"), F.col(tree).alias("_t"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = pieces.withColumn("_row", F.row_number().over(inside) - 1)
    joined = placed.join(starts, (F.col("_piece") == F.col("_p")) & F.col(tree).eqNullSafe(F.col("_t")))
    return joined.select(*rows.columns, (F.col("_before") + F.col("_row")).alias("rank"))


def _height(n: Column) -> Column:
    """Levels until one node is left of n."""
    steps = F.sequence(F.lit(0), F.lit(40))
    powers = F.transform(steps, lambda h: F.pow(F.lit(float(WIDTH)), h))
    return F.size(F.filter(powers, lambda p: p < n))


def grow(leaves: DataFrame) -> Tree:
    """All levels over leaves (tree, rank, digest); a level is a third of the one below it."""
    counts = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("_n"))
    heights = counts.select(F.col("tree").alias("_t"), _height(F.col("_n")).alias("height"))
    level = leaves.join(heights, F.col("tree").eqNullSafe(F.col("_t"))).select("tree", "rank", "digest", "height")
    level = stored(level)
    roots, records, h = [], [], 0
    while True:
        done = F.col("height") == h
        roots.append(level.where(done).select("tree", F.lit(h).alias("height"), "digest"))
        above = level.where(~done).groupBy("tree", "height", F.floor(F.col("rank") / WIDTH).alias("rank"))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("rank", "digest"))), lambda c: c["digest"])
        nodes = above.agg(ordered.alias("children"))
        level = stored(nodes.select("tree", "rank", "height", "children", F.sha2(F.array_join("children", ""), 256).alias("digest")))
        if level.isEmpty():
            break
        records.append(level.groupBy("digest").agg(F.first("children").alias("children")))
        h += 1
    roots_ = roots[0]
    for r in roots[1:]:
        roots_ = roots_.unionByName(r)
    return Tree(leaves, roots_, records)


def descend(tree: Tree, entries: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """tree, rank, digest, segments (from the entry down) of all leaves below the entries, or of the wanted ones (tree, rank).

    entries: tree, height, digest and the segments above it.
    """
    top = len(tree.records)
    starts = entries.withColumn("rank", F.lit(0).cast("long"))
    reached = starts.where(F.col("height") == top)
    for h in range(top, 0, -1):
        records = tree.records[h - 1].withColumnRenamed("digest", "_node")
        opened = reached.join(records, F.col("digest") == F.col("_node"))
        child = opened.select("tree", F.lit(h - 1).alias("height"), "rank", "segments", "children", F.posexplode("children").alias("_digit", "_child"))
        left = F.array_join(F.slice("children", F.lit(1), F.col("_digit")), "")
        right = F.array_join(F.slice("children", F.col("_digit") + 2, F.lit(WIDTH)), "")
        segment = F.struct(left.alias("left"), right.alias("right"))
        chosen = child.select(
            "tree", "height", F.col("_child").alias("digest"), (F.col("rank") * WIDTH + F.col("_digit")).alias("rank"), F.concat("segments", F.array(segment)).alias("segments")
        )
        if wanted is not None:
            paths = wanted.select(F.col("tree").alias("_t"), F.floor(F.col("rank") / float(WIDTH ** (h - 1))).alias("_r")).distinct()
            chosen = chosen.join(paths, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("rank") == F.col("_r")), "left_semi")
        reached = stored(chosen.unionByName(starts.where(F.col("height") == h - 1).select(*chosen.columns)))
    return reached.select("tree", "rank", "digest", "segments")


def folded(start: Column, segments: Column) -> Column:
    """The root that a leaf digest leads to, segment by segment from the leaf up."""
    return F.aggregate(segments, start, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def proofs(leaves: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """subroot, root and proof (segments from the leaf up) of all leaves (tree, rank, digest), or of the wanted (tree, rank)."""
    per_tree = grow(leaves)
    subroots = stored(per_tree.roots)
    order = subroots.withColumn("_all", F.lit(0)).withColumn("_null", F.col("tree").isNotNull())
    places = stored(ranked(order, "_all", ["_null", "tree"]).select(F.col("tree").alias("name"), "rank", "height", "digest"))
    whole = grow(places.select(F.lit("").alias("tree"), "rank", "digest"))
    root = whole.roots.select(F.col("digest").alias("root"))
    none = F.array().cast(_SEGMENTS)
    entered = descend(whole, whole.roots.withColumn("segments", none))
    below = entered.select(F.col("rank").alias("_place"), "segments").join(places, F.col("_place") == F.col("rank"))
    entries = below.select(F.col("name").alias("tree"), "height", "digest", "segments")
    found = descend(per_tree, entries, wanted)
    named = subroots.select(F.col("tree").alias("_t"), F.col("digest").alias("subroot"))
    both = found.join(named, F.col("tree").eqNullSafe(F.col("_t"))).drop("_t")
    return both.join(F.broadcast(root)).select("tree", "rank", "digest", F.reverse("segments").alias("proof"), "subroot", "root")  # one row


def verify(docs: DataFrame, tampered: dict[str, Column], fields: Sequence[str] = FIELDS, id_col: str = "doc_id", tree_col: str = "source") -> DataFrame:
    """id, leaf, subroot, root, proof, folded_root and verified of every row, whose columns are read as tampered.

    leaf, subroot, root and proof are those of the rows as they are; folded_root is what the tampered row's leaf leads to.
    """
    named = docs.select(F.col(id_col).alias("id"), F.col(tree_col).alias("tree"), leaf(docs, fields).alias("digest"), leaf(docs, fields, **tampered).alias("now"))
    leaves = stored(ranked(named, "tree", ["id", "digest", "now"]))
    proved = proofs(leaves.select("tree", "rank", "digest")).select(F.col("tree").alias("_t"), F.col("rank").alias("_r"), "subroot", "root", "proof")
    joined = leaves.join(proved, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("rank") == F.col("_r")))
    found = joined.select("id", F.col("digest").alias("leaf"), "subroot", "root", "proof", folded(F.col("now"), F.col("proof")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def proof_digest(proof: Column) -> Column:
    """H of the proof's siblings, level by level from the leaf, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)
