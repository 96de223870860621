"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_labels(edges: DataFrame) -> DataFrame:
    """Rows (node, label) for the nodes of ``edges`` (src, dst): equal labels, same component.

    Each round every node points at the neighbour (or itself) that comes first in a fixed random
    order, and edges are redrawn between the nodes pointed at; the number of nodes falls by a
    constant factor on average, so rounds grow with the logarithm of the longest path. Minima are
    combined before the shuffle. Both sides of a redrawing join are checkpoints with plain
    exchanges, so Spark can split a hub's edges. Self-loops and repeated edges are allowed.
    """
    edges = cut(edges.where("src != dst").select("src", "dst").distinct())
    rounds = []
    while not edges.isEmpty():
        both = edges.union(edges.select("dst", "src"))
        first = F.min(F.struct(F.xxhash64(F.lit(11), "dst").alias("h"), F.col("dst").alias("to")))
        own = F.struct(F.xxhash64(F.lit(11), "src").alias("h"), F.col("src").alias("to"))
        parent = both.groupBy("src").agg(first.alias("m"))
        parent = cut(parent.select(F.col("src").alias("node"), F.least("m", own)["to"].alias("to")))
        rounds.append(parent)
        left = parent.select(F.col("node").alias("src"), F.col("to").alias("a"))
        right = parent.select(F.col("node").alias("dst"), F.col("to").alias("b"))
        drawn = edges.join(left, "src").join(right, "dst").where("a != b")
        drawn = drawn.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
        edges = cut(drawn.distinct())
    if not rounds:
        return edges.select(F.col("src").alias("node"), F.col("dst").alias("label"))
    labels = rounds[0].withColumnRenamed("to", "label")
    for parent in rounds[1:]:
        parent = parent.withColumnRenamed("node", "label")
        labels = labels.join(parent, "label", "left").select(
            "node", F.coalesce("to", "label").alias("label")
        )
    return labels
