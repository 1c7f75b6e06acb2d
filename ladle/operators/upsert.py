"""Upsert by document id: the last version of a document wins."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.functions.values import index_name
from ladle.operators.sizing import PIECE_BYTES, fits_broadcast, small, without
from ladle.schemas import RECIPE
from ladle.session import passing, settle

KEY = ("source", "_id")
# Documents per id bucket of one table: an upsert rewrites whole buckets.
DOCS_PER_BUCKET = 5_000_000
# Folders of a write whose rows are not brought together: each task may add a file to each.
FEW_FOLDERS = 4
BODY = [f for f in RECIPE.fieldNames() if f != "_id"]


def latest(recipes: DataFrame, version: str = "version") -> DataFrame:
    """One row per document. Ranks are cut before the shuffle (WindowGroupLimit), so a
    document rewritten many times costs one row per input partition."""
    last = Window.partitionBy(*KEY).orderBy(F.col(version).desc())
    return recipes.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank")


def latest_settled(recipes: DataFrame, version: str = "version") -> DataFrame:
    """`latest` of rows that are on disk. Keys are counted first: only documents that come more than once are exchanged whole."""
    again = settle(recipes.groupBy(*KEY).agg(F.count("*").alias("n")).where("n > 1").select(*(F.col(k).alias(f"_{k}") for k in KEY)), "again")
    if again.isEmpty():
        return recipes
    if not fits_broadcast(again):
        return latest(recipes, version)
    met = F.lit(True)
    for k in KEY:
        met = met & F.col(k).eqNullSafe(F.col(f"_{k}"))
    once, more = (recipes.join(F.broadcast(again), met, how) for how in ("left_anti", "left_semi"))
    return once.unionByName(latest(more, version))


def bucket_count(rows: int, per_bucket: int, least: int) -> int:
    """Buckets grow with the table, within what a file system lists quickly."""
    return max(least, min(1024, -(-rows // per_bucket)))


def id_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("_id"), F.lit(buckets)).cast("int")


def id_buckets(docs: DataFrame) -> int:
    """Bucket count of a written table: the same in every row, so one row tells it."""
    row = docs.select("id_buckets").first()
    return row["id_buckets"] if row else 1


def _write_documents(docs: DataFrame, path: str, replace_all: bool) -> None:
    """Rows of few folders are written by the tasks that read them, so that no text is exchanged; those of many meet first."""
    if docs.select("source", "id_bucket").distinct().limit(FEW_FOLDERS + 1).count() > FEW_FOLDERS:
        docs = docs.hint("rebalance", "source", "id_bucket")
    with passing(docs.sparkSession):
        (docs.sortWithinPartitions("source", "id_bucket", "_id")
             .write.mode("overwrite").option("partitionOverwriteMode", "static" if replace_all else "dynamic")
             .option("compression", "zstd").option("parquet.block.size", str(PIECE_BYTES))
             .partitionBy("source", "id_bucket").parquet(path))


def has_table(spark: SparkSession, path: str) -> bool:
    """Is there a table? A folder without files is none; one that cannot be read is an error."""
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def upsert(recipes: DataFrame, path: str, recreate: bool = False,
           buckets: int | None = None, distinct: bool = False) -> DataFrame:
    """Write the last version of `recipes(source, version, recipe fields)` into the table at
    `path`; returns `source, documents` written. `recreate` empties the table first. `distinct`
    says that `recipes` are on disk and hold a document once.

    Only the (source, id bucket) partitions of incoming ids are read and replaced. Their new
    content is settled in the shared folder first, so the table never reads from itself and
    the rows survive a failure between delete and rename.
    """
    spark = recipes.sparkSession
    fresh = recipes.select("source", "_id", *BODY)
    if not distinct:
        fresh = settle(latest(recipes).select(fresh.columns), "upsert-new", compression="zstd")
    merging = not recreate and has_table(spark, path)
    if merging:
        buckets = id_buckets(documents(spark, path))
    elif buckets is None:
        buckets = bucket_count(fresh.count(), DOCS_PER_BUCKET, 1)
    fresh = fresh.withColumn("id_bucket", id_bucket(buckets)).withColumn("id_buckets", F.lit(buckets))
    if merging:
        # One row per touched partition; DISTINCT is combined before its shuffle.
        touched = fresh.select("source", "id_bucket").distinct()
        kept = (documents(spark, path)
                .join(small(touched), ["source", "id_bucket"], "left_semi"))
        kept = without(kept, fresh.select(*KEY, "id_bucket"), [*KEY, "id_bucket"])
        merged = settle(kept.select(fresh.columns).unionByName(fresh), "upsert-merged", compression="zstd")
    else:
        merged = fresh
    _write_documents(merged, path, not merging)
    return docs_per_source(fresh)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """The table, with declared types: a source named 007 stays text."""
    schema = T.StructType([*RECIPE.fields, T.StructField("id_buckets", T.IntegerType()), 
                           T.StructField("source", T.StringType()),
                           T.StructField("id_bucket", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def docs_per_source(recipes: DataFrame) -> DataFrame:
    return (recipes.groupBy("source").agg(F.count("*").alias("documents"))
                   .withColumn("index_name", index_name(F.col("source"))))


def outcome(results: DataFrame) -> DataFrame:
    """Per source: documents accepted, records with errors, and whether all went well."""
    bad = (F.col("result.status") == "success") & (
        F.col("result.recipe").isNull() | F.col("result.recipe._id").isNull())
    return (results.groupBy("source").agg(
                F.count_if((F.col("result.status") == "success") & ~bad).alias("documents"),
                F.count_if(bad).alias("errors"))
            .withColumn("clean", F.col("errors") == 0))
