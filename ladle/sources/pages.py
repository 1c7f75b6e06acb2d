"""Stored pages: a Parquet table laid out by host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.urls import host, store_key, url_key
from ladle.operators.sizing import small

# Hosts are too many to be folders of their own; a hash of the host is the partition.
HOST_BUCKETS = 32


def keyed_pages(pages: DataFrame) -> DataFrame:
    url = F.col("url")
    return (pages.withColumn("host", host(url))
                 .withColumn("url_key", url_key(url))
                 .withColumn("store_key", store_key(url)))


def host_bucket(name: Column) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(HOST_BUCKETS)).cast("int")


def store_pages(pages: DataFrame, path: str, mode: str = "append") -> None:
    """Write pages by host. The rebalance hint lets a large host fill many tasks and files;
    inside a file pages are sorted, so a reader of one host skips the other row groups."""
    (keyed_pages(pages).withColumn("host_bucket", host_bucket(F.col("host")))
        .hint("rebalance", "host_bucket")
        .sortWithinPartitions("host_bucket", "host", "url_key")
        .write.mode(mode).partitionBy("host_bucket").parquet(path))


def read_pages(spark: SparkSession, path: str, only_host: str | None = None) -> DataFrame:
    """Stored pages; `only_host` prunes to the host's partition and row groups.

    The columns of the layout stay, so that `of_keys` can prune by them.
    """
    pages = spark.read.parquet(path)
    if only_host is not None:
        pages = pages.where((F.col("host_bucket") == host_bucket(F.lit(only_host))) & (F.col("host") == only_host))
    return pages


def with_url_key(pages: DataFrame) -> DataFrame:
    """Stored pages carry their key; others get it from their URL."""
    return pages if "url_key" in pages.columns else pages.withColumn("url_key", url_key(F.col("url")))


def of_keys(pages: DataFrame, keys: DataFrame) -> DataFrame:
    """Pages whose key is in `keys(url_key)`. Of stored pages only the host partitions of those keys
    are read: the numbers of the wanted ones, at most `HOST_BUCKETS`, become a filter of the scan."""
    wanted = keys.select("url_key").distinct()
    if "host_bucket" in pages.columns:
        numbers = wanted.select(host_bucket(host(F.col("url_key"))).alias("n")).distinct().collect()
        pages = pages.where(F.col("host_bucket").isin([r["n"] for r in numbers]))
    return with_url_key(pages).join(small(wanted), "url_key", "left_semi")
