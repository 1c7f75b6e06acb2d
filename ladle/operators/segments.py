"""The index as immutable segments: documents are added, replaced and deleted without rewriting what is indexed.

A commit may write a segment of postings, the keys of the documents that it ends (tombstones, which hold for all segments
before it), and how the statistics change (deltas, negative for ended documents). The last file of a commit is its
manifest, which names what is live: a commit that fails leaves nothing behind that is read. Readers sum the deltas
and leave ended documents out. Segments of about one size are merged once there are `FAN` of them, so a document is
rewritten a number of times that grows with the logarithm of the table.

Postings lie in folders by a hash of the document, so ending documents reads the folders of their ids only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.analysis import LIGHT_ENGLISH, Analyzer
from ladle.operators.index import FIELDS, Index, posting_rows
from ladle.operators.sizing import IN_PIECES, key_parts, within
from ladle.operators.upsert import FEW_FOLDERS, bucket_count, has_table, id_bucket
from ladle.session import passing, settings, settle

#: Segments of one tier that are merged; a tier holds segments up to `FAN` times as large as the one before.
FAN = 4
#: Documents per folder of a segment.
DOCS_PER_BUCKET = 1_000_000
#: Numbers of commits are written with so many digits, so their order is that of their names.
_DIGITS = 10

_POSTINGS = "source string, field string, term string, _id string, tf bigint, dl bigint"
_DEAD = "source string, _id string"
#: Row groups of a segment, and what a task reads of it to count: its terms are in memory together.
COUNTED_BYTES = 8 * 1024 * 1024
_DELTAS = "source string, field string, term string, df bigint, total_len bigint, documents bigint"
_MANIFEST = "segment int, kind string, documents bigint, buckets int"


@dataclass(frozen=True)
class Part:
    """What a commit wrote and is live: postings (`segment`), tombstones (`dead`) or statistics (`deltas`)."""

    segment: int
    kind: str
    documents: int = 0
    buckets: int = 1


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.option("basePath", f"{path}/commits").parquet(f"{path}/commits") if has_table(spark, f"{path}/commits") else None


def manifest(spark: SparkSession, path: str) -> tuple[int, list[Part]]:
    """Number of the last commit, 0 if there is none, and its live parts: a few for every tier."""
    commits = _commits(spark, path)
    if commits is None:
        return 0, []
    last = commits.agg(F.max("commit")).first()[0]
    rows = commits.where((F.col("commit") == last) & (F.col("segment") > 0)).collect()
    return last, sorted((Part(r["segment"], r["kind"], r["documents"], r["buckets"]) for r in rows), key=lambda p: (p.kind, p.segment))


def _commit(spark: SparkSession, path: str, number: int, parts: list[Part]) -> None:
    rows = [(p.segment, p.kind, p.documents, p.buckets) for p in parts] or [(0, "none", 0, 1)]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/commits/commit={number:0{_DIGITS}d}")


def _folder(path: str, kind: str, segment: int) -> str:
    return f"{path}/{kind}/{segment:0{_DIGITS}d}"


def _read(spark: SparkSession, path: str, kind: str, parts: list[Part], schema: str) -> DataFrame:
    """Rows of some parts, with the number of the `segment` they are from."""
    frames = [spark.read.schema(schema).parquet(_folder(path, kind, p.segment)).withColumn("segment", F.lit(p.segment))
              for p in parts if p.kind == kind]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], f"{schema}, segment int")


def _alive(rows: DataFrame, dead: DataFrame, newest: int) -> DataFrame:
    """Rows of documents that no later commit has ended. What is as new as the last tombstone is not joined."""
    if not newest:
        return rows
    ended = dead.select(F.col("segment").alias("ended"), F.col("source").alias("s"), F.col("_id").alias("i"))
    met = (F.col("source") == F.col("s")) & (F.col("_id") == F.col("i")) & (F.col("segment") < F.col("ended"))
    old = rows.where(F.col("segment") < newest)
    for part in key_parts(ended, ["s", "i"]) or [ended]:
        old = old.join(part, met, "left_anti")
    return old.unionByName(rows.where(F.col("segment") >= newest))


def _live(spark: SparkSession, path: str, parts: list[Part], kind: str, schema: str) -> DataFrame:
    dead = _read(spark, path, "dead", parts, _DEAD)
    newest = max((p.segment for p in parts if p.kind == "dead"), default=0)
    return _alive(_read(spark, path, kind, parts, schema), dead, newest)


def _write_segment(rows: DataFrame, docs: DataFrame, path: str, number: int, documents: int, sorted_runs: bool = False) -> Part:
    """`sorted_runs`: rows come in runs by source, field and term, and are written as they come, for few folders.

    Nothing is exchanged or sorted then, and a task holds one open file for each folder.
    """
    buckets = bucket_count(documents, DOCS_PER_BUCKET, 1)
    rows = rows.select("source", "field", "term", "_id", "tf", "dl").withColumn("id_bucket", id_bucket(buckets))
    if not sorted_runs:
        rows = rows.hint("rebalance", "id_bucket").sortWithinPartitions("id_bucket", "source", "field", "term")
    # Without open files for all folders, the writer sorts by folder.
    with passing(rows.sparkSession, spark__sql__maxConcurrentOutputFileWriters=str(FEW_FOLDERS if sorted_runs else 0), **IN_PIECES):
        (rows.write.partitionBy("id_bucket").mode("overwrite").option("compression", "zstd")
             .option("parquet.block.size", str(COUNTED_BYTES)).parquet(_folder(path, "segment", number)))
    docs.select("source", "_id").write.mode("overwrite").parquet(_folder(path, "documents", number))
    return Part(number, "segment", documents, buckets)


def _deltas(rows: DataFrame, docs: DataFrame, sign: int) -> DataFrame:
    """What each posting and document adds to the statistics: per term, per field (term ''), per source (field '')."""
    one, none = (F.lit(n).cast("bigint") for n in (sign, 0))
    terms = rows.select("source", "field", "term", one.alias("df"),
                        F.when(F.col("term") == "", sign * F.col("dl")).otherwise(none).alias("total_len"), none.alias("documents"))
    counts = docs.select("source", F.lit("").alias("field"), F.lit("").alias("term"), none.alias("df"), none.alias("total_len"),
                         one.alias("documents"))
    return terms.unionByName(counts)


def _ended(spark: SparkSession, path: str, parts: list[Part], keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings and keys of those of `keys` that are live."""
    known = _live(spark, path, [Part(p.segment, "documents") if p.kind == "segment" else p for p in parts], "documents", _DEAD)
    old = settle(known.join(keys, ["source", "_id"], "left_semi").select("source", "_id"), "ended")
    frames = []
    for p in (p for p in parts if p.kind == "segment"):
        # The bucket is a folder: those without any of the keys are not read.
        held = spark.read.schema(f"{_POSTINGS}, id_bucket int").parquet(_folder(path, "segment", p.segment))
        asked = old.withColumn("id_bucket", id_bucket(p.buckets))
        frames.append(within(held, asked, ["id_bucket", "source", "_id"]).drop("id_bucket").withColumn("segment", F.lit(p.segment)))
    if not frames:
        return spark.createDataFrame([], _POSTINGS), old
    dead = _read(spark, path, "dead", parts, _DEAD)
    newest = max((p.segment for p in parts if p.kind == "dead"), default=0)
    return _alive(reduce(DataFrame.unionByName, frames), dead, newest).drop("segment"), old


def add(recipes: DataFrame, path: str, analyzer: Analyzer = LIGHT_ENGLISH, fields: tuple[str, ...] = FIELDS,
        merging: bool = True) -> int:
    """Index `recipes` (one row per document); documents of the same source and id are replaced. Returns the commit."""
    spark = recipes.sparkSession
    last, parts = manifest(spark, path)
    number = last + 1
    docs = settle(recipes.select("source", F.col("_id").cast("string").alias("_id")), "added")
    documents = docs.count()
    few = bucket_count(documents, DOCS_PER_BUCKET, 1) <= FEW_FOLDERS and analyzer.lexicon is None
    with settings(spark, **IN_PIECES):
        counted = posting_rows(recipes, analyzer, fields, placing=not few)
    segment = _write_segment(counted, docs, path, number, documents, few)
    rows = spark.read.schema(_POSTINGS).parquet(_folder(path, "segment", number))
    deltas, ended = _deltas(rows, docs, 1), None
    if parts:
        gone, ended = _ended(spark, path, parts, docs)
        deltas = deltas.unionByName(_deltas(gone, ended, -1))
    _finish(spark, path, number, [*parts, segment], deltas, ended)
    return merge(spark, path) if merging else number


def delete(keys: DataFrame, path: str) -> int:
    """End the documents `keys(source, _id)`; unknown ones are ignored. Returns the commit."""
    spark = keys.sparkSession
    last, parts = manifest(spark, path)
    gone, ended = _ended(spark, path, parts, keys.select("source", F.col("_id").cast("string").alias("_id")).distinct())
    _finish(spark, path, last + 1, parts, _deltas(gone, ended, -1), ended)
    return last + 1


def _finish(spark: SparkSession, path: str, number: int, parts: list[Part], deltas: DataFrame, ended: DataFrame | None) -> None:
    _write_deltas(deltas, path, number)
    parts = [*parts, Part(number, "deltas")]
    if ended is not None and not ended.isEmpty():
        ended.write.mode("overwrite").parquet(_folder(path, "dead", number))
        parts.append(Part(number, "dead"))
    _commit(spark, path, number, parts)


def _write_deltas(deltas: DataFrame, path: str, number: int) -> None:
    # Tasks of one size, however large the segment is: the default follows the input up to 128 MB.
    with passing(deltas.sparkSession, **IN_PIECES | {"spark__sql__files__maxPartitionBytes": str(COUNTED_BYTES)}):
        (deltas.groupBy("source", "field", "term").agg(*(F.sum(c).alias(c) for c in ("df", "total_len", "documents")))
               .where("df <> 0 or total_len <> 0 or documents <> 0")
               .write.mode("overwrite").parquet(_folder(path, "deltas", number)))


def _tier(documents: int) -> int:
    return int(math.log(max(documents, 1), FAN))


def merge(spark: SparkSession, path: str, everything: bool = False) -> int:
    """Merge tiers that are full, or `everything` to one segment; returns the last commit."""
    last, parts = manifest(spark, path)
    while True:
        tiers: dict[int, list[Part]] = {}
        for p in parts:
            if p.kind == "segment":
                tiers.setdefault(0 if everything else _tier(p.documents), []).append(p)
        full = next((t for t in tiers.values() if len(t) >= (2 if everything else FAN)), None)
        dead = [p for p in parts if p.kind == "dead"]
        if full is None and everything and dead and len(tiers) == 1:
            full = tiers[0]  # one segment with ended documents
        if full is None:
            return last
        number, taken = last + 1, [*full, *dead]
        rows = _live(spark, path, taken, "segment", _POSTINGS)
        docs = settle(_live(spark, path, [Part(p.segment, "documents") if p.kind == "segment" else p for p in taken],
                            "documents", _DEAD), "merged")
        merged = _write_segment(rows, docs, path, number, docs.count())
        segments = [p for p in parts if p.kind == "segment" and p not in full] + [merged]
        # Tombstones that no older segment is left for, and deltas one by one, are not needed any more.
        oldest = min(p.segment for p in segments)
        kept = [p for p in dead if p.segment > oldest]
        _write_deltas(_read(spark, path, "deltas", parts, _DELTAS), path, number)
        parts = [*segments, *kept, Part(number, "deltas")]
        _commit(spark, path, number, parts)
        last = number


def open_segments(spark: SparkSession, path: str) -> Index:
    """The live documents as an index, for searches."""
    _, parts = manifest(spark, path)
    live = _live(spark, path, parts, "segment", _POSTINGS).drop("segment").withColumn("bucket", F.lit(0))
    stats = (_read(spark, path, "deltas", parts, _DELTAS).groupBy("source", "field", "term")
             .agg(*(F.sum(c).alias(c) for c in ("df", "total_len", "documents"))))
    corpus = (stats.where((F.col("term") == "") & (F.col("field") != "") & (F.col("df") > 0))
              .select("source", "field", F.col("df").alias("n_docs"), "total_len", F.lit(1).alias("buckets"),
                      (F.col("total_len") / F.col("df")).alias("avgdl")))
    return Index(
        postings=live.where("term <> ''"),
        doc_len=live.where("term = ''").select("source", "field", "_id", "dl"),
        term_stats=stats.where("term <> '' and df > 0").select("source", F.lit(0).alias("bucket"), "field", "term", "df"),
        corpus_stats=corpus,
        catalogue=stats.where("field = '' and documents > 0").select("source", "documents"),
        buckets=1,
        sources=corpus.select("source").distinct().count(),
    )
