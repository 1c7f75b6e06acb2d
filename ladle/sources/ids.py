"""Id ranges and sequence numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.urls import recipe_url
from ladle.session import settle


def id_range(spark: SparkSession, start: int, end: int, prefix: str) -> DataFrame:
    """`[start, end)` with the URL of each id; empty when the range is."""
    return (spark.range(start, max(start, end)).withColumnRenamed("id", "recipe_id")
                 .withColumn("url", recipe_url(prefix, F.col("recipe_id"))))


def sequence_ids(df: DataFrame, order: list[str], start: int = 0, name: str = "id") -> DataFrame:
    """Number rows `start+1 ...` in `order` without a single-partition window.

    Rows are range-partitioned and written once; each partition then only needs the count of
    the partitions before it, a table with one row per partition. The row's place in the
    input breaks ties, so equal values may fill several partitions.
    """
    mono = F.monotonically_increasing_id()
    placed = df.withColumn("_tie", mono)
    placed = placed.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    placed = settle(placed.withColumn("_part", F.shiftright(mono, 33).cast("int"))
                          .withColumn("_row", mono.bitwiseAND(F.lit((1 << 33) - 1))))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    sizes = {r["_part"]: r["_n"] for r in counts.collect()}  # one row per partition
    before, total = [], start
    for part in sorted(sizes):
        before.append((part, total))
        total += sizes[part]
    offsets = df.sparkSession.createDataFrame(before, "_part int, _before bigint")
    return (placed.join(F.broadcast(offsets), "_part")
                  .withColumn(name, F.col("_before") + F.col("_row") + 1)
                  .drop("_part", "_row", "_before"))
