"""Crawl as batch reachability: frontier x edges, minus visited, level by level."""

from __future__ import annotations

import warnings
from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.functions.urls import url_key
from ladle.operators import sizing
from ladle.operators.links import links
from ladle.operators.sizing import small
from ladle.session import scratch, settle

#: Edges of one bucket, where they are written in buckets.
EDGES_PER_BUCKET = 2_000_000


class Unfinished(UserWarning):
    """A depth limit cut a crawl while its last frontier still held nodes."""


def reach(seeds: DataFrame, edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """`node, depth` of everything reachable from `seeds(node)`: up to the fixpoint, or within
    `max_depth` hops, which warns if it leaves nodes unfollowed.

    The edges are written once and each level reads them from there. Where they are so many that a frontier may not
    fit a broadcast, they are written in buckets by source, and a level exchanges its frontier only, never the edges.

    Each level is a written table in the shared folder: lineage stays flat and a lost
    executor costs one task. A measured small frontier is broadcast to the edges.
    """
    spark = seeds.sparkSession
    base = scratch(spark, "reach")
    level = lambda d: f"{base}/depth={d}"
    edges = _by_source(settle(edges.select("src", "dst").where(F.col("src").isNotNull() & F.col("dst").isNotNull()), "edges"))
    seeds.select("node").where(F.col("node").isNotNull()).distinct().write.parquet(level(0))
    node_schema = seeds.select("node").schema
    visited_schema = f"node {seeds.schema['node'].dataType.simpleString()}, depth int"
    for depth in count(1) if max_depth is None else range(1, max_depth + 1):
        frontier = spark.read.schema(node_schema).parquet(level(depth - 1))
        visited = spark.read.schema(visited_schema).parquet(base)
        (edges.join(small(frontier.withColumnRenamed("node", "src")), "src")
              .select(F.col("dst").alias("node")).distinct()
              .join(visited.select("node"), "node", "left_anti")
              .write.parquet(level(depth)))
        if spark.read.schema(node_schema).parquet(level(depth)).isEmpty():
            break
    else:
        warnings.warn(f"nodes at depth {max_depth} were not followed", Unfinished, stacklevel=2)
    return spark.read.schema(visited_schema).parquet(base)


def _by_source(edges: DataFrame) -> DataFrame:
    """Written edges, in buckets by source if there are many."""
    spark, rows = edges.sparkSession, edges.count()
    if rows <= sizing.BROADCAST_ROWS:
        return edges
    buckets = min(100_000, max(spark.sparkContext.defaultParallelism, -(-rows // EDGES_PER_BUCKET)))
    path = scratch(spark, "edges-by-source")
    name = f"ladle_edges_{path[-32:]}"
    (edges.repartition(buckets, "src").write.option("path", path)
          .bucketBy(buckets, "src").sortBy("src").saveAsTable(name))
    return spark.table(name)


def crawl(seeds: DataFrame, pages: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Reachability over the links of stored pages: `url_key, depth`, with the limit of `reach`.

    Every page is parsed once, into the edges between keys that the levels then read.
    """
    edges = (links(pages, keep=("url",), newest=True)
             .select(url_key(F.col("url")).alias("src"), F.col("link_key").alias("dst")).distinct())
    return reach(seeds.select(F.col("url_key").alias("node")), edges, max_depth).withColumnRenamed("node", "url_key")
