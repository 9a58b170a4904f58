"""Connected components of a graph given by its edges, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import stored


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node ties its larger neighbours to the least node that it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node ties its smaller neighbours and itself to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b): root is the least node it can reach.

    Minima are pre-aggregated per task, and a node with very many neighbours meets
    its minimum in a join that can be split; neighbours are never gathered. Every step is
    written to the shared folder, so its lineage is short. Loops and repeated edges are harmless.
    """
    tidy = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(tidy, label)
    before = _checksum(now)
    while before[0]:
        now = stored(_small_star(_large_star(now)), label)
        after = _checksum(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.unionByName(now.select(F.col("a").alias("node"), F.col("b").alias("root")))
