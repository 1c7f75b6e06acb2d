"""Results -> fixed-size batches, each one JSON array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.values import batch_key
from ladle.schemas import RESULT


def batch_ordinal(id_: Column, start: int, size: int) -> Column:
    """Ids run from `start + 1`; a batch can never hold more than `size` of them."""
    return F.floor((id_ - start - 1) / F.lit(size)).cast("bigint")


def batches(results: DataFrame, size: int = 100, start: int = 0) -> DataFrame:
    """One row per batch: `batch, first_id, last_id, n, batch_key, body`."""
    record = F.struct(*RESULT.fieldNames())
    grouped = results.groupBy(batch_ordinal(F.col("id"), start, size).alias("batch")).agg(
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
        F.count("*").alias("n"),
        F.array_sort(F.collect_list(F.struct("id", record.alias("record")))).alias("_items"))
    return grouped.select(
        "batch", "first_id", "last_id", "n",
        batch_key(F.col("first_id"), F.col("last_id")).alias("batch_key"),
        F.to_json(F.col("_items.record"), {"ignoreNullFields": "false"}).alias("body"))


def batch_bounds(results: DataFrame, size: int = 100, start: int = 0) -> DataFrame:
    """Keys and sizes only; contents are not moved."""
    return (results.groupBy(batch_ordinal(F.col("id"), start, size).alias("batch"))
                   .agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"),
                        F.count("*").alias("n"))
                   .withColumn("batch_key", batch_key(F.col("first_id"), F.col("last_id"))))
