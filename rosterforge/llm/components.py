"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterforge.sources.staging import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node next to it."""
    both = edges.unionByName(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    least = both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("least"))
    return (
        both.join(least, "hi").filter("lo > hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    ).filter("hi > lo").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("least"))
    moved = edges.join(least, "hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    own = least.select("hi", F.col("least").alias("lo"))
    return own.unionByName(moved.filter("hi > lo")).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has an edge; the root is the smallest node it can reach.

    Each round is written to the shared folder and read back, so the lineage stays short and a
    lost executor costs one re-read. Minima are combined before the shuffle; the joins are plain
    inner joins whose large partitions Spark may split. A round changes nothing only when every
    node points at its root, which ends the loop; the number of rounds is logarithmic.
    Null ends and loops are dropped. No edges give no rows.
    """
    now = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
    ).distinct()
    now, seen = stored(now, "edges"), None
    while True:
        # a checksum of the table, whatever its order
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
            )
        seen = state
        now = stored(_small_star(_large_star(now)), "edges")
