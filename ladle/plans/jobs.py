"""The jobs end to end: extract and land, load and index, search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.analysis import LIGHT_ENGLISH, Analyzer
from ladle.operators import segments
from ladle.operators.batching import batches
from ladle.operators.extract import RECIPE_SITE, Layout, extract_range
from ladle.operators.index import Index, ensure_index, open_index, place_index, refresh_index
from ladle.operators.search import TOP, search, with_documents
from ladle.operators.sizing import PIECE_BYTES, spread
from ladle.operators.upsert import documents, has_table, latest_settled, outcome, upsert
from ladle.session import settle
from ladle.sources.batches import (batch_results, parse_batches, quarantine, scan_text, successes,
                                   write_batches)
from ladle.sources.ledger import new_files, record


def extract_and_land(spark: SparkSession, start: int, end: int, pages: DataFrame, path: str,
                  url_prefix: str, source: str = "all-recipes", layout: Layout = RECIPE_SITE,
                  batch_size: int = 100, clean: bool = False, objects: bool = False) -> None:
    """Ids `[start, end)` -> results -> batches landed below `path`. An empty range lands nothing."""
    if end <= start:
        return
    results = extract_range(spark, start, end, spread(pages), url_prefix, layout)
    write_batches(batches(results, batch_size, start), path, source, clean, objects)


def index_all(spark: SparkSession, landed: str, base: str, recreate: bool = False,
              analyzer: Analyzer = LIGHT_ENGLISH, whole_files: bool = False) -> DataFrame:
    """Landed batches -> document table and index below `base`; returns the outcome per source.

    Files that cannot be read are written to `base/quarantine` and the load goes on.
    """
    parsed = settle(parse_batches(scan_text(spark, landed, whole_files)), "parsed")
    quarantine(parsed).write.mode("overwrite").parquet(f"{base}/quarantine")
    results = batch_results(parsed)
    report = settle(outcome(results), "outcome")
    docs, index = f"{base}/documents", f"{base}/index"
    fresh = successes(results)
    if recreate or not has_table(spark, docs):
        upsert(fresh, docs, recreate=True)
        ensure_index(documents(spark, docs), index, recreate=True, analyzer=analyzer)
    else:
        upsert(fresh, docs)
        if not has_table(spark, f"{index}/postings"):
            ensure_index(documents(spark, docs), index, analyzer=analyzer)
        else:
            refresh_index(documents(spark, docs), index, fresh.select("source").distinct(), analyzer)
    place_index(spark, index)
    return report


def index_new(spark: SparkSession, landed: str, base: str, analyzer: Analyzer = LIGHT_ENGLISH,
              whole_files: bool = False) -> DataFrame:
    """Files landed since the last call -> document table and segments below `base`; returns their outcome per source.

    Only those files are read, and only a new segment is written. Of a document that comes again the later load wins.
    A call that failed is made good by the next: its files are recorded last, and documents are replaced by id.
    """
    ledger = f"{base}/ledger"
    files = settle(new_files(spark, landed, ledger), "new-files")
    parsed = parse_batches(scan_text(spark, landed, whole_files, files))
    # Of a body that was read, nobody needs the text again. A row holds a batch of records, and rows of a group are read together.
    parsed = settle(parsed.withColumn("body", F.when(F.col("results").isNull(), F.col("body"))), "parsed", compression="zstd",
                    **{"parquet.block.size": str(PIECE_BYTES)})
    quarantine(parsed).write.mode("append").parquet(f"{base}/quarantine")
    results = batch_results(parsed)
    report = settle(outcome(results), "outcome")
    fresh = latest_settled(successes(results))
    if not fresh.isEmpty():
        upsert(fresh, f"{base}/documents", distinct=True)
        segments.add(fresh.drop("version"), f"{base}/segments", analyzer)
    record(files, ledger)
    return report


def search_documents(spark: SparkSession, queries: DataFrame, base: str, k: int = TOP,
                     analyzer: Analyzer = LIGHT_ENGLISH, **options) -> DataFrame:
    """Queries -> ranked documents from the tables that `index_all` wrote."""
    index: Index = open_index(spark, f"{base}/index")
    hits = search(queries, index, k=k, analyzer=analyzer, **options)
    return with_documents(hits, queries, documents(spark, f"{base}/documents"), k)
