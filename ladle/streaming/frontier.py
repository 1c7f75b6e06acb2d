"""The crawl as a Structured Streaming query over a frontier of URLs.

`frontier folder -> first-seen URLs -> page lookup -> store pages, append new links -> frontier`
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ladle.functions.urls import url_key
from ladle.operators.extract import lookup_pages
from ladle.operators.links import links
from ladle.session import ship_package
from ladle.sources.pages import keyed_pages

FRONTIER = "url string"


def file_frontier(spark: SparkSession, path: str) -> DataFrame:
    """URLs from Parquet files under `path/*/`; new files are picked up as they appear."""
    return spark.readStream.schema(FRONTIER).parquet(f"{path}/*")


def topic_frontier(spark: SparkSession, servers: str, topic: str = "urls-to-process") -> DataFrame:
    """URLs from a Kafka topic, earliest first (needs the Kafka connector on the class path)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
                 .option("subscribe", topic).option("startingOffsets", "earliest").load()
                 .select(F.col("value").cast("string").alias("url")))


def to_topic(urls: DataFrame, servers: str, topic: str = "urls-to-process") -> None:
    """Batch write of URLs to a Kafka topic: null key, string value."""
    (urls.select(F.col("url").alias("value")).write.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def seed_frontier(seeds: DataFrame, path: str) -> None:
    """Add seed URLs in a folder of their own; those seen before are dropped by the stream."""
    seeds.select("url").distinct().write.parquet(f"{path}/seed-{uuid.uuid4().hex}")


def one_per_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = pa.table({"key": batch.column("url_key"), "at": pa.array(range(batch.num_rows))})
            yield batch.take(keys.group_by("key").aggregate([("at", "min")])["at_min"].combine_chunks())


def first_seen(urls: DataFrame, horizon: str | None = None) -> DataFrame:
    """Stream of URLs whose key was not seen before.

    Duplicates inside an Arrow batch are dropped before the shuffle, so one URL that makes up
    a third of the stream is a few rows when it reaches the state store. `horizon` bounds the
    state by event time and needs a column `ts`.
    """
    ship_package(urls.sparkSession)
    keyed = urls.withColumn("url_key", url_key(F.col("url")))
    thinned = keyed.mapInArrow(one_per_key, keyed.schema)
    if horizon is None:
        return thinned.dropDuplicates(["url_key"])
    return thinned.withWatermark("ts", horizon).dropDuplicatesWithinWatermark(["url_key"])


def crawl_step(batch: DataFrame, batch_id: int, pages: DataFrame, out: str, frontier: str) -> None:
    """One micro-batch: mark visited, look pages up, store them, send links back.

    The state of the stream holds every URL key that was visited and drops those that come again, so the links are
    not compared with the visited table: a batch costs what it holds, however long the crawl has run. Only links among the
    batch's own URLs are left out here.
    Every write replaces a folder named by the batch id, so a replay after a failure leaves
    the same tables.
    """
    spark = batch.sparkSession
    own = f"{out}/visited/batch={batch_id}"
    batch.select("url_key", "url").write.mode("overwrite").parquet(own)
    urls = spark.read.schema("url_key string, url string").parquet(own)
    fetched = lookup_pages(urls.select("url"), pages)
    stored = f"{out}/pages/batch={batch_id}"
    (keyed_pages(fetched).withColumn("status", F.when(F.col("html").isNull(), "networkFailure")
                                                .otherwise("success"))
        .write.mode("overwrite").parquet(stored))
    landed = spark.read.parquet(stored).where(F.col("html").isNotNull())
    found = f"{out}/links/batch={batch_id}"
    (links(landed, keep=("url",)).groupBy("link_key").agg(F.min("link").alias("link"))
        .write.mode("overwrite").parquet(found))
    new = spark.read.schema("link_key string, link string").parquet(found)
    (new.join(urls.select(F.col("url_key").alias("link_key")), "link_key", "left_anti")
        .select(F.col("link").alias("url"))
        .write.mode("overwrite").parquet(f"{frontier}/batch-{batch_id}"))


def crawl_stream(urls: DataFrame, pages: DataFrame, out: str, frontier: str, checkpoint: str,
                 available_now: bool = False) -> StreamingQuery:
    """Start the crawl over the stream `urls(url)`."""
    writer = first_seen(urls).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(lambda df, n: crawl_step(df, n, pages, out, frontier)).start()


def crawl_until_idle(spark: SparkSession, seeds: DataFrame, pages: DataFrame, base: str,
                     max_runs: int | None = None) -> DataFrame:
    """Drive the file-backed crawl until a run adds no URL; returns the stored pages.

    An `availableNow` run fixes its input at the start, so links found by one run are the
    input of the next, on the same checkpoint. Each call adds its seeds. A crawl that `max_runs`
    cuts is an error; calling again goes on with it.
    """
    frontier, out = f"{base}/frontier", f"{base}/out"
    seed_frontier(seeds, frontier)
    known, runs = -1, 0
    while True:
        if max_runs is not None and runs == max_runs:
            raise RuntimeError(f"the crawl is not finished after {max_runs} runs")
        runs += 1
        query = crawl_stream(file_frontier(spark, frontier), pages, out, frontier,
                             f"{base}/checkpoint", available_now=True)
        query.awaitTermination()
        count = spark.read.schema("url_key string, url string").parquet(f"{out}/visited").count()
        if count == known:
            break
        known = count
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/pages")
