"""Inverted index as Parquet tables.

`postings(source, bucket, field, term, _id, tf, dl)` carries the field length beside the term
frequency, so scoring needs no join with document lengths. They are written as lists: one row holds the postings that
a term has in the documents of one batch. `bucket` is a hash of the term: as a
partition column it lets a search prune the scan to the terms it asks for. Bucket -1 holds one
row per document and field (`term = ''`), from which lengths and corpus statistics come
without a second pass over the text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.analysis import LIGHT_ENGLISH, Analyzer, bag_tokens, tokens
from ladle.functions.values import index_name, matches_pattern
from ladle.operators.counting import postings_of, term_lists, token_lists
from ladle.operators.placed import Placed, open_placed, place, unplace
from ladle.operators.sizing import IN_PIECES, PIECE_BYTES, piece_count, pieces, small, spread
from ladle.operators.upsert import bucket_count, has_table
from ladle.session import passing, settings, settle

FIELDS = ("title", "ingredient")
ALL_INDEXES = "recipes-from-*"
DOC_BUCKET = -1
# Documents per term bucket of an index.
DOCS_PER_BUCKET = 2_000_000

_LISTS = "field string, term string, ids array<string>, tfs array<int>, dls array<int>, source string, bucket int"
_TERMS = "field string, term string, df bigint, source string, bucket int"
_CATALOGUE = "documents bigint, source string"
_CORPUS = "field string, n_docs bigint, total_len bigint, buckets int, source string"


def term_bucket(term: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(term), buckets).cast("int")


def _bag(df: DataFrame, field: str) -> Column:
    kind = dict(df.dtypes)[field]
    return bag_tokens(F.col(field)) if kind.startswith("array") else tokens(F.col(field))


def field_tokens(recipes: DataFrame, fields: tuple[str, ...] = FIELDS,
                 analyzer: Analyzer = LIGHT_ENGLISH) -> DataFrame:
    """`source, _id, field, tokens` for every field that has any."""
    bags = F.array(*[F.struct(F.lit(f).alias("field"), analyzer.kept(_bag(recipes, f)).alias("tokens"))
                     for f in fields])
    return (recipes.select("source", F.col("_id").cast("string").alias("_id"), F.explode(bags).alias("b"))
                   .select("source", "_id", "b.field", "b.tokens")
                   .where(F.size("tokens") > 0))


def posting_rows(recipes: DataFrame, analyzer: Analyzer = LIGHT_ENGLISH,
                 fields: tuple[str, ...] = FIELDS, doc_rows: bool = True, placing: bool = True) -> DataFrame:
    """Term counts per document and field; `doc_rows` adds the document row with term ''."""
    lists = posting_lists(recipes, analyzer, fields, doc_rows, placing)
    return postings_of(lists, "source", "field", "term").select("source", "_id", "field", "dl", "term", "tf")


def term_totals(recipes: DataFrame, analyzer: Analyzer = LIGHT_ENGLISH, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """`field, term, n` over all documents.

    A list is summed where it was made. The sums meet in as many tasks as the text has pieces, so a task holds the terms
    of a piece's share; a number left to Spark would let it hold more the larger the input is.
    """
    parts = piece_count(recipes.select("source", "_id", *fields))
    lists = posting_lists(recipes, analyzer, fields, doc_rows=False, parts=parts)
    sums = lists.select("field", "term", F.aggregate("tfs", F.lit(0).cast("bigint"), lambda t, n: t + n).alias("n"))
    return sums.repartition(parts, "field", "term").groupBy("field", "term").agg(F.sum("n").alias("n"))


def posting_lists(recipes: DataFrame, analyzer: Analyzer = LIGHT_ENGLISH,
                  fields: tuple[str, ...] = FIELDS, doc_rows: bool = True, placing: bool = True,
                  parts: int | None = None) -> DataFrame:
    """The same as lists: `source, field, term, ids, tfs, dls`, one or more rows for a term of a field in a source.

    The short text is placed by document once, in pieces of one size however large the input is; a batch of documents
    is then tokenised, counted and analysed in its task, its distinct tokens once each. `placing=False` leaves documents
    in the tasks that read them: enough where what follows keeps no more than a batch. `parts` is the number of pieces, if
    it has been measured.
    """
    text = recipes.select("source", "_id", *fields)
    if placing:
        placed = text.repartition(parts, "source", "_id") if parts else pieces(text, "source", "_id")
    else:
        placed = spread(text)
    if analyzer.lexicon is not None:  # its join may exchange the tokens
        return _lists_by_rows(placed, analyzer, fields, doc_rows)
    bags = placed.select(F.col("source").cast("string").alias("source"), F.col("_id").cast("string").alias("_id"),
                         *(analyzer.kept(_bag(placed, f)).alias(f"bag_{i}") for i, f in enumerate(fields)))
    found = token_lists(bags, fields)
    return term_lists(found.withColumn("terms", analyzer.terms_of(F.col("tokens"))), fields, doc_rows)


def _lists_by_rows(placed: DataFrame, analyzer: Analyzer, fields: tuple[str, ...], doc_rows: bool) -> DataFrame:
    """Lists of one posting each."""
    bags = field_tokens(placed, fields, analyzer)
    bag = F.concat("tokens", F.array(F.lit(""))) if doc_rows else F.col("tokens")
    spread = bags.select("source", "_id", "field", F.size("tokens").alias("dl"), F.explode(bag).alias("token"))
    counted = (analyzer.terms(spread)
               .groupBy("source", "_id", "field", "dl", "term").agg(F.count("*").cast("int").alias("tf")))
    return counted.select("source", "field", "term", *(F.array(c).alias(l) for c, l in (("_id", "ids"), ("tf", "tfs"), ("dl", "dls"))))


@dataclass(frozen=True)
class Index:
    """Open index tables."""

    postings: DataFrame
    doc_len: DataFrame
    term_stats: DataFrame
    corpus_stats: DataFrame
    catalogue: DataFrame
    buckets: int
    sources: int
    #: The same postings by document, if they were placed.
    placed: Placed | None = None

    def names(self) -> DataFrame:
        """Index catalogue: one row per source, with all its documents, also those without a token."""
        return self.catalogue.withColumn("index_name", index_name(F.col("source")))


def index_view(docs: DataFrame, pattern: str = ALL_INDEXES, name: str | None = None) -> DataFrame:
    """Documents of all indexes whose name matches `pattern`, as one view.

    All indexes are one table, so the pattern becomes a filter on the partition column;
    `name` registers the view for SQL.
    """
    found = (docs.withColumn("index_name", index_name(F.col("source")))
                 .where(matches_pattern(index_name(F.col("source")), pattern)))
    if name:
        found.createOrReplaceTempView(name)
    return found


def _write(df: DataFrame, path: str, partition: list[str], order: list[str], replace_all: bool) -> None:
    """Rebalance splits a hot source over many tasks and merges small ones; rows are sorted by
    term inside every file so that row groups and pages of other terms are skipped."""
    with passing(df.sparkSession, **IN_PIECES):
        (df.hint("rebalance", *partition)
           .sortWithinPartitions(*partition, *order)
           .write.mode("overwrite")
           .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
           .option("compression", "zstd").option("parquet.block.size", str(PIECE_BYTES))
           .partitionBy(*partition).parquet(path))


def build_index(recipes: DataFrame, path: str, analyzer: Analyzer = LIGHT_ENGLISH,
                buckets: int | None = None, fields: tuple[str, ...] = FIELDS) -> Index:
    """Index all of `recipes` (one row per document) at `path`, replacing what is there."""
    if buckets is None:
        buckets = bucket_count(recipes.count(), DOCS_PER_BUCKET, 4)
    rows = _bucketed(_lists_as_read(recipes, analyzer, fields), buckets)
    _write_tables(recipes.sparkSession, rows, path, buckets, None)
    _write_catalogue(recipes, path, None)
    return open_index(recipes.sparkSession, path)


def refresh_index(recipes: DataFrame, path: str, sources: DataFrame,
                  analyzer: Analyzer = LIGHT_ENGLISH, fields: tuple[str, ...] = FIELDS) -> Index:
    """Re-index the given `sources(source)` from the document table; other sources stay."""
    spark = recipes.sparkSession
    buckets = open_index(spark, path).buckets
    touched = settle(sources.select("source").distinct(), "refresh")
    changed = recipes.join(small(touched), "source", "left_semi")
    rows = _bucketed(_lists_as_read(changed, analyzer, fields), buckets)
    _write_tables(spark, rows, path, buckets, touched)
    _write_catalogue(changed, path, touched)
    return open_index(spark, path)


def _lists_as_read(recipes: DataFrame, analyzer: Analyzer, fields: tuple[str, ...]) -> DataFrame:
    """Lists of batches of `PIECE_BYTES`, counted where they are read: the text is not exchanged, and a table that lies by
    source gives batches of one source, hence a term a few long lists in place of many short ones."""
    with settings(recipes.sparkSession, **IN_PIECES):
        return posting_lists(recipes, analyzer, fields, placing=analyzer.lexicon is not None)


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.when(F.col("term") == "", DOC_BUCKET)
                                      .otherwise(term_bucket(F.col("term"), F.lit(buckets))))


def _write_tables(spark: SparkSession, rows: DataFrame, path: str, buckets: int,
                  touched: DataFrame | None) -> None:
    everything = touched is None
    unplace(spark, path)
    if not everything:
        # A filler row in every bucket of a touched source makes the dynamic overwrite
        # replace buckets that no longer hold any term.
        filler = (touched.select("source", F.explode(F.sequence(F.lit(DOC_BUCKET), F.lit(buckets - 1))).alias("bucket"))
                         .select("source", "bucket", F.lit("").alias("field"), F.lit("").alias("term"),
                                 F.array().cast("array<string>").alias("ids"),
                                 *(F.array().cast("array<int>").alias(c) for c in ("tfs", "dls"))))
        rows = rows.unionByName(filler)
    _write(rows.select("source", "bucket", "field", "term", "ids", "tfs", "dls"), f"{path}/postings",
           ["source", "bucket"], ["field", "term"], everything)
    # Read back with the fillers, so that they reach the statistics tables too.
    written = spark.read.schema(_LISTS).parquet(f"{path}/postings")
    if not everything:
        written = written.join(small(touched), "source", "left_semi")
    terms = (written.where(F.col("bucket") != DOC_BUCKET)
                    .groupBy("source", "bucket", "field", "term")
                    .agg(F.sum(F.size("tfs")).alias("df")))
    _write(terms, f"{path}/term_stats", ["source", "bucket"], ["field", "term"], everything)
    corpus = (written.where(F.col("bucket") == DOC_BUCKET)
                     .groupBy("source", "field")
                     .agg(F.sum(F.size("dls")).alias("n_docs"),
                          F.sum(F.aggregate("dls", F.lit(0).cast("bigint"), lambda t, d: t + d)).alias("total_len"))
                     .withColumn("buckets", F.lit(buckets)))
    _write(corpus, f"{path}/corpus_stats", ["source"], ["field"], everything)


def _write_catalogue(recipes: DataFrame, path: str, touched: DataFrame | None) -> None:
    counted = recipes.groupBy("source").agg(F.count("*").alias("documents"))
    if touched is not None:  # a source that lost all documents replaces its row too
        none = touched.select("source", F.lit(0).cast("bigint").alias("documents"))
        counted = counted.unionByName(none).groupBy("source").agg(F.sum("documents").alias("documents"))
    _write(counted, f"{path}/catalogue", ["source"], [], touched is None)


def open_index(spark: SparkSession, path: str) -> Index:
    real = F.col("field") != ""
    lists = spark.read.schema(_LISTS).parquet(f"{path}/postings").where(real)
    corpus = (spark.read.schema(_CORPUS).parquet(f"{path}/corpus_stats").where(real)
                   .withColumn("avgdl", F.col("total_len") / F.col("n_docs")))
    buckets, sources = corpus.agg(F.max("buckets"), F.count_distinct("source")).first()
    return Index(
        postings=postings_of(lists.where(F.col("bucket") != DOC_BUCKET), "source", "bucket", "field", "term"),
        doc_len=postings_of(lists.where(F.col("bucket") == DOC_BUCKET), "source", "field").select("source", "field", "_id", "dl"),
        term_stats=spark.read.schema(_TERMS).parquet(f"{path}/term_stats").where(real),
        corpus_stats=corpus,
        catalogue=spark.read.schema(_CATALOGUE).parquet(f"{path}/catalogue").where("documents > 0"),
        buckets=buckets or 1,
        sources=sources,
        placed=open_placed(spark, path),
    )


def place_index(spark: SparkSession, path: str, shards: int | None = None) -> Index:
    """Place the postings of the index at `path` by document too; searches then use them."""
    index = open_index(spark, path)
    documents = index.catalogue.agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
    words = index.corpus_stats.agg(F.coalesce(F.sum("total_len"), F.lit(0))).first()[0]
    place(index.postings.select("source", "field", "term", "_id", "tf", "dl"), index.doc_len, path, documents, words, shards)
    return open_index(spark, path)



def ensure_index(recipes: DataFrame, path: str, recreate: bool = False, **options) -> Index:
    """Create the index; an existing one is kept unless `recreate`."""
    spark = recipes.sparkSession
    if not recreate and has_table(spark, f"{path}/postings"):
        return open_index(spark, path)
    return build_index(recipes, path, **options)
