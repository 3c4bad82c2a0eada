"""Connected components by large-star and small-star steps, no component in one task or on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.storage import stage

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b, whole numbers), by its smallest node.

    Each round is written to the shared folder and read again, so lineage stays short.  Sums of nodes and
    of edges tell when nothing changes any more.  The smallest neighbour of a node is a grouped minimum, so
    a node with many edges is folded where they lie.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    held = stage(edges, "components")
    before = None
    for _ in range(MAX_ROUNDS):
        now = tuple(
            held.frame.agg(
                F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
            ).first()
        )
        if now == before or not now[0]:
            break
        before = now
        after = stage(_small_star(_large_star(held.frame)), "components")
        held.release()
        held = after
    else:
        raise RuntimeError("components did not settle")
    stars = held.frame.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = held.frame.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionAll(centres)


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to its smallest neighbour (or itself)."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and the node, are linked to its smallest neighbour."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
