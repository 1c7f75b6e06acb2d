"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.session import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = both.groupBy("src").agg(F.least("src", F.min("dst")).alias("root"))
    return (both.where("dst > src").join(least, "src")
            .select(F.col("dst").alias("src"), F.col("root").alias("dst")).where("src <> dst").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them (`src > dst` holds here)."""
    least = edges.groupBy("src").agg(F.min("dst").alias("root"))
    moved = edges.join(least, "src").select(F.col("dst").alias("src"), F.col("root").alias("dst"))
    return least.withColumnRenamed("root", "dst").unionByName(moved.where("src <> dst")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("src", "dst")), F.sum(F.col("dst") % 1000003)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): each node of `edges` (src, dst bigint) with the smallest node reachable from it.

    Rounds grow with the logarithm of the longest path. Each round is a table in the shared folder, so
    lineage stays flat; only its count and checksum reach the driver.
    """
    now = settle(edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "edges")
    before, state = None, _state(now)
    while state != before:
        now = settle(_small_star(_large_star(now)), "stars")
        before, state = state, _state(now)
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(roots)
