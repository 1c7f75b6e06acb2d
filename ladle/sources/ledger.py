"""Which landed files a load has taken: later loads read the others only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.operators.upsert import has_table

_FILES = "path string, size bigint, modified timestamp"


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """`path, size, modified` of every file below `path`; nothing is read of their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
                        F.col("_metadata.file_modification_time").alias("modified"))


def new_files(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """Files below `path` that `ledger` does not hold; one that was written again since counts as new."""
    found = landed_files(spark, path)
    if not has_table(spark, ledger):
        return found
    return found.join(spark.read.schema(_FILES).parquet(ledger), ["path", "size", "modified"], "left_anti")


def record(files: DataFrame, ledger: str) -> None:
    """Add `files` to the ledger: the last step of a load, so one that failed is done again."""
    files.select("path", "size", "modified").write.mode("append").parquet(ledger)
