"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import join_hot, stored


def components(edges: DataFrame) -> DataFrame:
    """node, label for all nodes of edges (a, b); the label is the least node of the component.

    Each step takes the least label of all neighbours and then the label's label, so chains shorten by more than half.
    Labels live in written tables, one for each step; only the question whether anything changed comes to the driver.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b"))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        better = labels.join(near, "node", "left").select("node", F.least("label", "near").alias("new"), F.col("label").alias("old"))
        jump = better.select(F.col("node").alias("new"), F.col("new").alias("further"))
        after = stored(better.join(jump, "new", "left").select("node", F.least("new", "further").alias("label"), (F.least("new", "further") < F.col("old")).alias("moved")))
        labels = after.select("node", "label")
        if after.where("moved").isEmpty():
            return labels


def spread_components(edges: DataFrame) -> DataFrame:
    """As components, but a node of very many edges, or a label that very many nodes share, is no one task's work.

    The labels of such nodes are broadcast, which are a thousand at most; see join_hot.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b"))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")))
    while True:
        near = join_hot(both, labels.select(F.col("node").alias("b"), "label"), ["b"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        better = stored(labels.join(near, "node", "left").select("node", F.least("label", "near").alias("new"), F.col("label").alias("old")))
        jump = better.select(F.col("node").alias("new"), F.col("new").alias("further"))
        least = F.least("new", "further")
        after = stored(join_hot(better, jump, ["new"], "left").select("node", least.alias("label"), (least < F.col("old")).alias("moved")))
        labels = after.select("node", "label")
        if after.where("moved").isEmpty():
            return labels
