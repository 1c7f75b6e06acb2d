"""Batch relevance search: BM25 per field, best field wins, top k per query."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ladle.functions.analysis import LIGHT_ENGLISH, Analyzer, tokens
from ladle.functions.values import index_name, matches_pattern
from ladle.operators.index import ALL_INDEXES, Index, term_bucket
from ladle.operators.placed import best, every
from ladle.operators.sizing import BROADCAST_ROWS, fits, fits_broadcast, measure, small
from ladle.operators.upsert import id_bucket, id_buckets
from ladle.session import settle

# Scoring constants and defaults of the search server.
K1, B = 1.2, 0.75
BOOSTS = {"title": 2.0, "ingredient": 1.0}
TOP = 10

# Up to this many query terms are also given to the scan as literals, so that Parquet skips the
# row groups and pages of all other terms.
FEW_TERMS = 100

# A term with more postings than this in one source is split over several join partitions.
HOT_POSTINGS = 1_000_000

# Where postings are placed by document, up to this many terms of queries travel with the search.
PLACED_TERMS = 100_000


def query_terms(queries: DataFrame, analyzer: Analyzer = LIGHT_ENGLISH) -> DataFrame:
    """`query_id, term, qtf`; null and empty queries give no rows, repeats raise `qtf`."""
    asked = queries.where(F.coalesce(F.col("query"), F.lit("")) != "")
    spread = asked.select("query_id", F.explode(analyzer.kept(tokens(F.col("query")))).alias("token"))
    return analyzer.terms(spread).groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def _idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def _weights(terms: DataFrame, index: Index, boosts: dict[str, float], scope: str,
             in_scope: Column, named: Column, few: bool) -> tuple[DataFrame, list[str]]:
    """Everything about a (query, term) that does not depend on the document. `few` says that
    the terms, once per field, were measured to fit a broadcast."""
    hinted = F.broadcast if few else (lambda df: df)
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(float(b)).alias("boost"))
                       for f, b in boosts.items()])
    asked = (terms.select("query_id", "term", "qtf", F.explode(fields).alias("f"))
                  .select("query_id", "term", "qtf", "f.field", "f.boost")
                  .withColumn("bucket", term_bucket(F.col("term"), F.lit(index.buckets)))
                  .where(F.col("qtf") > 0))
    stats = index.term_stats.where(in_scope & named)
    # One row per source and field.
    corpus = index.corpus_stats.where(in_scope)
    near = F.broadcast if index.sources * len(boosts) <= BROADCAST_ROWS // 10 else (lambda df: df)
    key = ["bucket", "field", "term"]
    if scope == "global":
        wanted = hinted(asked.select(key).distinct())
        stats = stats.join(wanted, key, "left_semi").groupBy(key).agg(F.sum("df").alias("df"))
        corpus = (corpus.groupBy("field")
                        .agg(F.sum("n_docs").alias("n_docs"),
                             (F.sum("total_len") / F.sum("n_docs")).alias("avgdl")))
        # As many rows as there are fields.
        found = stats.join(hinted(asked), key).join(F.broadcast(corpus), "field")
        join_key = key
    else:
        found = stats.join(hinted(asked), key).join(near(corpus.select("source", "field", "n_docs", "avgdl")),
                                                    ["source", "field"])
        join_key = ["source", *key]
    weight = F.col("boost") * F.col("qtf") * (K1 + 1) * _idf(F.col("n_docs"), F.col("df"))
    return found.select("query_id", *join_key, "df", "avgdl", weight.alias("weight")), join_key


def _match(postings: DataFrame, weights: DataFrame, key: list[str], broadcastable: bool) -> DataFrame:
    """Postings of the asked terms. The weights are broadcast when their size is proven;
    otherwise postings of terms that nobody asks for are dropped first (the distinct terms are far
    fewer than the weights), both sides shuffle, and hot terms are salted by document on both."""
    if not broadcastable:
        weights = settle(weights, "weights")
        broadcastable = fits_broadcast(weights)
    if broadcastable:
        return postings.join(F.broadcast(weights), key)
    postings = postings.join(small(settle(weights.select(key).distinct(), "asked")), key, "left_semi")
    slots = F.ceil(F.col("df") / F.lit(HOT_POSTINGS)).cast("int")
    hot = (weights.where(F.col("df") > HOT_POSTINGS)
                  .groupBy(key).agg(F.max(slots).alias("slots")))
    salted = (postings.join(small(hot), key, "left")
                      .withColumn("slot", F.coalesce(F.pmod(F.xxhash64("_id"), F.col("slots")), F.lit(0)).cast("int"))
                      .drop("slots"))
    copies = weights.withColumn("slot", F.explode(F.sequence(F.lit(0), F.greatest(slots, F.lit(1)) - 1)))
    return salted.join(copies, [*key, "slot"])


def scores(queries: DataFrame, index: Index, fields: dict[str, float] | None = None,
           scope: str = "index", pattern: str = ALL_INDEXES,
           analyzer: Analyzer = LIGHT_ENGLISH) -> DataFrame:
    """`query_id, source, _id, score` of every matching document; of postings placed by document no match is exchanged."""
    found = _placed_hits(queries, index, fields, None, scope, pattern, analyzer)
    if found is None:
        return _scores_by_term(queries, index, fields, scope, pattern, analyzer)
    return found.withColumn("score", F.round("score", 6))


def _scores_by_term(queries: DataFrame, index: Index, fields: dict[str, float] | None, scope: str, pattern: str,
                    analyzer: Analyzer) -> DataFrame:
    """The same from postings that lie by term: what matches meets by document."""
    boosts = _checked(fields)
    in_scope = matches_pattern(index_name(F.col("source")), pattern) & F.col("field").isin(*boosts)
    # Analysed once: what follows reads either a few rows that are at hand, or the written terms.
    terms = query_terms(queries, analyzer)
    at_hand = terms.limit(FEW_TERMS + 1).collect()
    named = F.lit(True)
    if len(at_hand) <= FEW_TERMS:
        terms = queries.sparkSession.createDataFrame(at_hand, terms.schema)
        named = F.col("term").isin(sorted({r["term"] for r in at_hand}))
        measured = len(at_hand), sum(64 + len(str(r).encode()) for r in at_hand)
    else:
        terms = settle(terms, "terms")
        measured = measure(terms)
    weights, key = _weights(terms, index, boosts, scope, in_scope, named, fits(measured, len(boosts)))
    # A query term meets each source at most once per field: a proven bound on the weights.
    times = len(boosts) * (index.sources if scope != "global" else 1)
    matched = _match(index.postings.where(in_scope & named), weights, key, fits(measured, max(times, 1)))
    norm = K1 * (1 - B + B * F.col("dl") / F.col("avgdl"))
    scored = matched.withColumn("part", F.col("weight") * F.col("tf") / (F.col("tf") + norm))
    # One aggregation: per-field sums side by side, then the best of them.
    sums = [F.sum(F.when(F.col("field") == f, F.col("part"))).alias(f"_s{i}") for i, f in enumerate(boosts)]
    per_doc = scored.groupBy("query_id", "source", "_id").agg(*sums)
    names = [f"_s{i}" for i in range(len(boosts))]
    best = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    return per_doc.select("query_id", "source", "_id", F.round(best, 6).alias("score"))


def search(queries: DataFrame, index: Index, fields: dict[str, float] | None = None, k: int = TOP,
           scope: str = "index", pattern: str = ALL_INDEXES,
           analyzer: Analyzer = LIGHT_ENGLISH) -> DataFrame:
    """Top `k` per query; equal scores are ordered by source and id.

    Equal query texts are scored once, under their lowest id, and their hits copied at the end:
    a text asked very often costs one query, not one pass over its postings per copy.
    """
    asked = queries.where(F.coalesce(F.col("query"), F.lit("")) != "").select("query_id", "query")
    # An id may be given to several texts: the text is part of what a query is known by.
    once = asked.groupBy("query").agg(F.min("query_id").alias("query_id")).select(
        "query", F.struct("query_id", F.xxhash64("query").alias("text")).alias("query_id"))
    found = _placed_hits(once, index, fields, k, scope, pattern, analyzer)
    if found is None:
        found = _scores_by_term(once, index, fields, scope, pattern, analyzer)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "source", "_id")
    hits = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    copies = asked.join(small(once.withColumnRenamed("query_id", "_asked_as")), "query").drop("query")
    hits = hits.withColumnRenamed("query_id", "_asked_as")
    return copies.join(_bounded_hits(hits, queries, k), "_asked_as").select(
        "query_id", "source", "_id", "score", "rank")


def _placed_hits(queries: DataFrame, index: Index, fields: dict[str, float] | None, k: int | None, scope: str,
                 pattern: str, analyzer: Analyzer) -> DataFrame | None:
    """`query_id, source, _id, score`, among which are the best `k` of each query (all matches if that is None); None where
    postings are not placed by document, or what the queries ask for is too much to send along."""
    boosts = _checked(fields)
    if index.placed is None:
        return None
    spark, counted = queries.sparkSession, query_terms(queries, analyzer)
    rows = counted.limit(PLACED_TERMS + 1).collect()
    terms = sorted({r["term"] for r in rows})
    size = sum(64 + len(t.encode()) for t in terms)
    # A term meets each source at most once per field: a proven bound on what is broadcast.
    times = len(boosts) * (index.sources if scope != "global" else 1)
    if len(rows) > PLACED_TERMS or not fits((len(terms), size), max(times, 1)):
        return None
    asked: dict = {}
    for r in rows:
        asked.setdefault(r["query_id"], {})[r["term"]] = r["qtf"]
    numbers = spark.createDataFrame(list(enumerate(asked)), StructType([StructField("asked", LongType()), counted.schema["query_id"]]))
    in_scope = matches_pattern(index_name(F.col("source")), pattern)
    named = F.col("field").isin(*boosts)
    if len(terms) <= FEW_TERMS:
        named = named & F.col("term").isin(terms)
    gains, key = _gains(spark, terms, index, boosts, scope, in_scope, named)
    if k is None:
        hits = every(index.placed, gains, key, list(asked.values()), boosts, K1, B, in_scope & named)
    else:
        hits = best(index.placed, gains, key, list(asked.values()), boosts, k, K1, B, in_scope & named)
    return hits.join(F.broadcast(numbers), "asked").select("query_id", "source", "_id", "score")


def _gains(spark, terms: list[str], index: Index, boosts: dict[str, float], scope: str,
           in_scope: Column, named: Column) -> tuple[DataFrame, list[str]]:
    """What a term is worth in a field of a source (or of all): idf times the boost, and the average length."""
    asked = F.broadcast(spark.createDataFrame([(t,) for t in terms], "term string").withColumn(
        "bucket", term_bucket(F.col("term"), F.lit(index.buckets))))
    key = ["field", "term"] if scope == "global" else ["source", "field", "term"]
    stats = index.term_stats.where(in_scope & named).join(asked, ["bucket", "term"]).groupBy(key).agg(F.sum("df").alias("df"))
    corpus = (index.corpus_stats.where(in_scope & F.col("field").isin(*boosts))
              .groupBy(key[:-1]).agg(F.sum("n_docs").alias("n_docs"), (F.sum("total_len") / F.sum("n_docs")).alias("avgdl")))
    boost = reduce(lambda c, f: c.when(F.col("field") == f, F.lit(float(boosts[f]))), boosts, F)
    return stats.join(corpus, key[:-1]).select(
        *key, (boost * (K1 + 1) * _idf(F.col("n_docs"), F.col("df"))).alias("gain"), "avgdl"), key


def _checked(fields: dict[str, float] | None) -> dict[str, float]:
    boosts = fields or BOOSTS
    if any(b < 0 for b in boosts.values()):
        raise ValueError("a boost below 0 has no meaning")
    return boosts


def _bounded_hits(hits: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Broadcast hits when `k` rows for every query are few."""
    few = measure(queries.select("query_id"))[0] * k <= BROADCAST_ROWS // 10
    return F.broadcast(hits) if few else hits


def search_one(text: str, index: Index, k: int = TOP, **options) -> DataFrame:
    """One query string: best `k` documents, ordered."""
    spark = index.postings.sparkSession
    queries = spark.createDataFrame([(0, text)], "query_id int, query string")
    if index.placed is not None:
        return (search(queries, index, k=k, **options).select("source", "_id", "score")
                .orderBy(F.col("score").desc(), "source", "_id"))
    return (scores(queries, index, **options).drop("query_id")
            .orderBy(F.col("score").desc(), "source", "_id").limit(k))


def no_results(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """Per query: was it searched without a hit?"""
    counts = hits.groupBy("query_id").agg(F.count("*").alias("hits"))
    return (queries.select("query_id").join(counts, "query_id", "left")
                   .select("query_id", F.col("hits").isNull().alias("no_results")))


def with_documents(hits: DataFrame, queries: DataFrame, documents: DataFrame, k: int = TOP) -> DataFrame:
    """Hits joined to their documents. A result has at most `k` rows per query, so its size is
    known from the queries alone."""
    key = ["source", "_id"]
    if "id_bucket" in documents.columns:
        hits = hits.withColumn("id_bucket", id_bucket(id_buckets(documents)))
        key.append("id_bucket")
    return documents.join(_bounded_hits(hits, queries, k), key)


def result_lines(recipes: DataFrame, keep: tuple[str, ...] = ("source", "_id")) -> DataFrame:
    """What a result page shows: title, ingredient lines, step lines, in order. One scan."""
    def section(name: str, items: Column) -> Column:
        return F.transform(items, lambda x, i: F.struct(
            F.lit(name).alias("section"), i.alias("line_no"), x.alias("line")))
    lines = F.concat(section("title", F.array("title")),
                     section("ingredient", F.coalesce("ingredient", F.array().cast("array<string>"))),
                     section("step", F.coalesce("steps", F.array().cast("array<string>"))))
    return recipes.select(*keep, F.inline(lines))
