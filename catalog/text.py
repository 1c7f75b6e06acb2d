"""Upsert, index tables, text analysis and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import (SQL_FIELDS, SQL_INDEX, SQL_RECIPES, bench_queries, built_index, recipes,
                            sql_finish, sql_term, sql_tokens, table)
from catalog.stems import sql_porter
from ladle.functions.analysis import ANALYZERS, LIGHT_ENGLISH, Analyzer
from ladle.operators import segments
from ladle.operators.batching import batches
from ladle.operators.index import field_tokens, index_view, term_totals
from ladle.operators.roots import validated_analyzer, validated_roots
from ladle.operators.search import (no_results, query_terms, result_lines, scores, search,
                                    with_documents)
from ladle.operators.sizing import spread
from ladle.operators.upsert import docs_per_source, documents, latest, outcome, upsert
from ladle.plans.jobs import index_new
from ladle.schemas import RECIPE
from ladle.session import scratch, settle
from ladle.sources.batches import write_batches


def _versions(spark, sf_dir):
    """Every document, and a second version of those that carry a label."""
    first = recipes(spark, sf_dir).withColumn("version", F.lit(1))
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("_id")).distinct()
    second = (first.join(labelled, "_id", "left_semi")
                   .withColumn("title", F.concat(F.lit("Again "), F.col("title")))
                   .withColumn("version", F.lit(2)))
    return first, second


def upsert_last_wins(spark, sf_dir):
    """Both versions in one load."""
    first, second = _versions(spark, sf_dir)
    return latest(second.unionByName(first)).select("source", "_id", "version", "title")


def upsert_table(spark, sf_dir):
    """The second versions merged into a written table."""
    first, second = _versions(spark, sf_dir)
    path = scratch(spark, "upsert")
    upsert(first, path)
    upsert(second, path)
    return documents(spark, path).select("source", "_id", "title")


def index_incremental(spark, sf_dir):
    """All documents with old titles, the labelled ones replaced, the toxic ones deleted, all merged: term statistics."""
    first, second = _versions(spark, sf_dir)
    path = scratch(spark, "segments")
    segments.add(first, path)
    segments.add(second, path)
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("_id"))
    segments.delete(first.join(toxic.distinct(), "_id", "left_semi"), path)
    segments.merge(spark, path, everything=True)
    return segments.open_segments(spark, path).term_stats.select("source", "field", "term", "df")


def index_segments(spark, sf_dir):
    """The same without the merge, by what searches read: postings of live documents."""
    first, second = _versions(spark, sf_dir)
    path = scratch(spark, "segments")
    segments.add(first, path)
    segments.add(second, path, merging=False)
    return segments.open_segments(spark, path).postings.select("source", "field", "term", "_id", "tf", "dl")


def landed_incremental(spark, sf_dir):
    """Every document landed and loaded; then the labelled ones landed again with another title, and only those loaded."""
    first, second = _versions(spark, sf_dir)
    landed, base = scratch(spark, "landed"), scratch(spark, "loaded")
    for version in (first, second):
        recipe = F.struct(*(F.col(f) for f in RECIPE.fieldNames()))
        results = version.select((F.col("_id").cast("bigint") + 1).cast("int").alias("id"), F.lit("u").alias("source"),
                                 F.lit("success").alias("status"), F.lit(None).cast("string").alias("html"), recipe.alias("recipe"))
        write_batches(batches(results), landed, "all-recipes")
        report = index_new(spark, landed, base)
    # Documents of the last load stand beside the table, so that a load that read too much shows.
    loaded = report.agg(F.sum("documents")).first()[0]
    return documents(spark, f"{base}/documents").select("source", "_id", "title", F.lit(loaded).cast("bigint").alias("last_load"))


def index_catalogue(spark, sf_dir):
    index, _ = built_index(spark, sf_dir)
    return index.names()


def docs_per_index(spark, sf_dir):
    _, docs = built_index(spark, sf_dir)
    return docs_per_source(documents(spark, docs))


def bad_rows_report(spark, sf_dir):
    """Outcome per source when documents of unlabelled quality carry no recipe."""
    good = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").cast("string").alias("_id")).agg(
        F.max("quality").alias("quality"))
    recipe = F.struct("_id", "title", "summary", "ingredient", "steps", "images")
    rows = recipes(spark, sf_dir).join(good, "_id", "left").select("source", F.struct(
        F.lit("success").alias("status"),
        F.when(F.col("quality").isNotNull(), recipe).alias("recipe")).alias("result"))
    return outcome(rows)


def token_counts(spark, sf_dir):
    found = field_tokens(spread(recipes(spark, sf_dir))).select("field", F.explode("tokens").alias("token"))
    return found.groupBy("field", "token").agg(F.count("*").alias("n"))


def _term_counts(spark, sf_dir, analyzer):
    return term_totals(recipes(spark, sf_dir), analyzer)


def analyzed_terms(spark, sf_dir):
    return _term_counts(spark, sf_dir, LIGHT_ENGLISH)


def lowercase_first_terms(spark, sf_dir):
    return _term_counts(spark, sf_dir, Analyzer(lowercase_first=True))


def stopword_terms(spark, sf_dir):
    return _term_counts(spark, sf_dir, ANALYZERS["light_english_stopped"])


def english_terms(spark, sf_dir):
    return _term_counts(spark, sf_dir, ANALYZERS["english"])


def validated_terms(spark, sf_dir):
    """Term counts with roots that the corpus itself holds at least twice."""
    found = field_tokens(spread(recipes(spark, sf_dir))).select(F.explode("tokens").alias("token"))
    return _term_counts(spark, sf_dir, validated_analyzer(settle(validated_roots(found), "roots")))


def analyzed_queries(spark, sf_dir):
    return query_terms(bench_queries(spark, sf_dir))


def postings(spark, sf_dir):
    index, _ = built_index(spark, sf_dir)
    return index.postings.select("source", "field", "term", "_id", "tf", "dl")


def doc_len(spark, sf_dir):
    return built_index(spark, sf_dir)[0].doc_len


def term_stats(spark, sf_dir):
    return built_index(spark, sf_dir)[0].term_stats.select("source", "field", "term", "df")


def corpus_stats(spark, sf_dir):
    return built_index(spark, sf_dir)[0].corpus_stats.select(
        "source", "field", "n_docs", F.round("avgdl", 6).alias("avgdl"))


def search_one_query(spark, sf_dir):
    """The longest benchmark text as one query: best ten documents."""
    queries = bench_queries(spark, sf_dir).orderBy(F.length("query").desc(), "query_id").limit(1)
    index, _ = built_index(spark, sf_dir)
    return (scores(queries, index).select("source", "_id", "score")
            .orderBy(F.col("score").desc(), "source", "_id").limit(10))


def _hits(spark, sf_dir, **options):
    index, _ = built_index(spark, sf_dir)
    return search(bench_queries(spark, sf_dir), index, **options).select(
        "query_id", "rank", "source", "_id", "score")


def search_batch(spark, sf_dir):
    return _hits(spark, sf_dir)


def search_title_only(spark, sf_dir):
    return _hits(spark, sf_dir, fields={"title": 2.0})


def search_best_fields(spark, sf_dir):
    """All matches, not only the top: the best field decides each score."""
    index, _ = built_index(spark, sf_dir)
    return scores(bench_queries(spark, sf_dir), index)


def search_wildcard(spark, sf_dir):
    return _hits(spark, sf_dir, pattern="recipes-from-src1*")


def search_global_scope(spark, sf_dir):
    return _hits(spark, sf_dir, scope="global")


def _guard_queries(spark, sf_dir):
    """Every benchmark text, and for each one an empty, a null and a punctuation query."""
    base = bench_queries(spark, sf_dir)
    variants = F.array(F.col("query"), F.lit(""), F.lit(None).cast("string"), F.lit("... !"))
    return base.select("query_id", F.posexplode(variants).alias("v", "query")).select(
        (F.col("query_id") * 4 + F.col("v")).alias("query_id"), "query")


def search_no_hits(spark, sf_dir):
    index, _ = built_index(spark, sf_dir)
    queries = _guard_queries(spark, sf_dir)
    return no_results(queries, search(queries, index))


def search_documents(spark, sf_dir):
    index, docs = built_index(spark, sf_dir)
    queries = bench_queries(spark, sf_dir)
    found = with_documents(search(queries, index), queries, documents(spark, docs))
    return found.select("query_id", "rank", "source", "_id", "title",
                        F.size("ingredient").alias("n_ingredients"))


def result_page(spark, sf_dir):
    return result_lines(recipes(spark, sf_dir)).select("source", "_id", "section", "line_no", "line")


def wildcard_indexes(spark, sf_dir):
    """Documents behind an index pattern."""
    _, docs = built_index(spark, sf_dir)
    return index_view(documents(spark, docs), "recipes-from-src1*").select("index_name", "_id")


QUERIES = {
    "upsert_last_wins": upsert_last_wins,
    "upsert_table": upsert_table,
    "index_catalogue": index_catalogue,
    "index_incremental": index_incremental,
    "index_segments": index_segments,
    "landed_incremental": landed_incremental,
    "docs_per_index": docs_per_index,
    "bad_rows_report": bad_rows_report,
    "tokens": token_counts,
    "analyzed_terms": analyzed_terms,
    "lowercase_first_terms": lowercase_first_terms,
    "stopword_terms": stopword_terms,
    "english_terms": english_terms,
    "validated_terms": validated_terms,
    "analyzed_queries": analyzed_queries,
    "postings": postings,
    "doc_len": doc_len,
    "term_stats": term_stats,
    "corpus_stats": corpus_stats,
    "search_one": search_one_query,
    "search_batch": search_batch,
    "search_title_only": search_title_only,
    "search_best_fields": search_best_fields,
    "search_wildcard": search_wildcard,
    "search_global_scope": search_global_scope,
    "search_no_hits": search_no_hits,
    "search_documents": search_documents,
    "result_lines": result_page,
    "wildcard_indexes": wildcard_indexes,
}

# -- SQL ------------------------------------------------------------------------------

# The default English stop-word set of the search server, written out for the check.
_STOPS = """'a', 'an', 'and', 'are', 'as', 'at', 'be', 'but', 'by', 'for', 'if', 'in', 'into', 'is', 'it', 'no', 'not',
  'of', 'on', 'or', 'such', 'that', 'the', 'their', 'then', 'there', 'these', 'they', 'this', 'to', 'was', 'will', 'with'"""
_TOKENS = f"""with {SQL_RECIPES}, {SQL_FIELDS},
  t as (select field, {sql_tokens('txt')} as token from fields)"""

_STATS = {
    "index": """stats as (select d.source, d.field, d.term, d.df, c.n_docs, c.avgdl
      from dfs d join corpus c on c.source = d.source and c.field = d.field)""",
    "global": """stats as (select s.source, s.field, d.term, d.df, c.n_docs, c.avgdl
      from (select distinct source, field from corpus) s
      join (select field, term, sum(df) as df from dfs group by all) d on d.field = s.field
      join (select field, count(*) as n_docs, avg(dl) as avgdl from dl group by all) c on c.field = s.field)""",
}
_QUERIES = "asked as (select item_id as query_id, text as query from benchmark)"


def _scored(scope: str = "index", asked: str = _QUERIES, boosts: str = "('title', 2.0), ('ingredient', 1.0)",
            where: str = "true") -> str:
    return f"""with {SQL_INDEX}, {asked},
      qt as (select query_id, {sql_term('tok')} as term, count(*) as qtf
             from (select query_id, {sql_tokens('query')} as tok from asked) group by all),
      boosts(field, boost) as (values {boosts}),
      {_STATS[scope]},
      parts as (select q.query_id, t.source, t._id, t.field, sum(b.boost * q.qtf * 2.2
            * ln(1 + (s.n_docs - s.df + 0.5) / (s.df + 0.5)) * t.tf
            / (t.tf + 1.2 * (1 - 0.75 + 0.75 * l.dl / s.avgdl))) as score
          from qt q join boosts b on true join tf t on t.term = q.term and t.field = b.field
          join stats s on s.source = t.source and s.field = t.field and s.term = t.term
          join dl l on l.source = t.source and l.field = t.field and l._id = t._id
          where {where} group by all),
      scored as (select query_id, source, _id, round(max(score), 6) as score from parts group by all),
      ranked as (select *, row_number() over (partition by query_id order by score desc, source, _id) as rank
                 from scored)"""


_TOP = "select query_id, cast(rank as integer) as rank, source, _id, score from ranked where rank <= 10"
_GUARDS = """asked as (select item_id * 4 + v as query_id,
      case v when 0 then text when 1 then '' when 2 then null else '... !' end as query
    from benchmark, (select unnest(range(4)) as v))"""
_LONGEST = """asked as (select item_id as query_id, text as query from benchmark
    order by length(text) desc, item_id limit 1)"""

ORACLES = {
    "upsert_last_wins": f"""with {SQL_RECIPES} select source, _id,
        case when l.doc_id is null then 1 else 2 end as version,
        case when l.doc_id is null then title else 'Again ' || title end as title
        from recipes left join (select distinct doc_id from labels) l on cast(l.doc_id as varchar) = _id""",
    "upsert_table": f"""with {SQL_RECIPES} select source, _id,
        case when l.doc_id is null then title else 'Again ' || title end as title
        from recipes left join (select distinct doc_id from labels) l on cast(l.doc_id as varchar) = _id""",
    "index_incremental": f"""with documents as (select doc_id, source, case when doc_id in (select doc_id from labels)
          then 'Again ' || text else text end as text from documents
          where doc_id not in (select doc_id from labels where toxic = 1)), {SQL_INDEX}
        select source, field, term, df from dfs""",
    "index_segments": f"""with documents as (select doc_id, source, case when doc_id in (select doc_id from labels)
          then 'Again ' || text else text end as text from documents), {SQL_INDEX}
        select t.source, t.field, t.term, t._id, t.tf, l.dl from tf t
        join dl l on l.source = t.source and l.field = t.field and l._id = t._id""",
    "landed_incremental": f"""with {SQL_RECIPES}, l as (select distinct doc_id from labels)
        select 'all-recipes' as source, _id, case when l.doc_id is null then title else 'Again ' || title end as title,
          cast((select count(*) from documents join l using (doc_id)) as bigint) as last_load
        from recipes left join l on cast(l.doc_id as varchar) = _id""",
    "index_catalogue": """select source, count(*) as documents, 'recipes-from-' || source as index_name
        from documents group by source""",
    "docs_per_index": """select source, count(*) as documents, 'recipes-from-' || source as index_name
        from documents group by source""",
    "bad_rows_report": """with r as (select source, l.doc_id is not null as ok from documents d
          left join (select distinct doc_id from labels) l on l.doc_id = d.doc_id)
        select source, count(*) filter (where ok) as documents, count(*) filter (where not ok) as errors,
          count(*) filter (where not ok) = 0 as clean from r group by source""",
    "tokens": f"{_TOKENS} select field, token, count(*) as n from t group by all",
    "analyzed_terms": f"{_TOKENS} select field, {sql_term('token')} as term, count(*) as n from t group by all",
    "lowercase_first_terms": f"""{_TOKENS}, l as (select field, lower(token) as token from t)
        select field, {sql_term('token')} as term, count(*) as n from l group by all""",
    "stopword_terms": f"""{_TOKENS} select field, {sql_term('token')} as term, count(*) as n from t
        where lower(token) not in ({_STOPS}) group by all""",
    "english_terms": f"""{_TOKENS}, e as (select field, {sql_finish('token')} as term from t
          where lower(token) not in ({_STOPS})), {sql_porter('e')}
        select field, coalesce(stem, e.term) as term, count(*) as n from e left join stems on stems.term = e.term
        group by all""",
    "validated_terms": f"""{_TOKENS}, v as (select token, count(*) as n from t
          where regexp_full_match(token, '[a-z]{{3,}}') group by token),
        e(rank, ending, put, kind) as (values (0, 'ies', 'y', 0), (1, 's', '', 0), (2, 'es', '', 0), (3, 'ied', 'y', 1),
          (4, 'ed', 'e', 1), (5, 'ed', '', 1), (6, 'ing', 'e', 1), (7, 'ing', '', 1)),
        c as (select token, rank, kind, left(token, length(token) - length(ending)) || put as root from v, e
            where ends_with(token, ending) and not ends_with(token, 'us') and not ends_with(token, 'ss') and length(token) > 3
          union all select token, 8 + d, 1, left(token, length(token) - length(x) - 1) from v, (values (0, 'ed'), (1, 'ing')) w(d, x)
            where ends_with(token, x) and length(token) > length(x) + 1 and token[-length(x) - 1] = token[-length(x) - 2]
              and token[-length(x) - 1] not in ('a', 'e', 'i', 'o', 'u', 'y')),
        r as (select c.token, c.root, kind, row_number() over (partition by c.token order by v.n desc, rank) as place
          from c join v on v.token = c.root where v.n >= 2 and length(root) >= 3 and regexp_matches(root, '[aeiouy]')),
        b as (select token, root, kind from r where place = 1),
        l as (select b.token, case when b.kind = 0 then coalesce(f.root, b.root) else b.root end as root
          from b left join b f on f.token = b.root and f.kind = 1),
        s as (select field, coalesce(root, t.token) as word from t left join l on l.token = t.token)
        select field, {sql_finish('word')} as term, count(*) as n from s group by all""",
    "analyzed_queries": f"""with {_QUERIES} select query_id, {sql_term('tok')} as term, count(*) as qtf
        from (select query_id, {sql_tokens('query')} as tok from asked) group by all""",
    "postings": f"""with {SQL_INDEX} select t.source, t.field, t.term, t._id, t.tf, l.dl from tf t
        join dl l on l.source = t.source and l.field = t.field and l._id = t._id""",
    "doc_len": f"with {SQL_INDEX} select source, field, _id, dl from dl",
    "term_stats": f"with {SQL_INDEX} select source, field, term, df from dfs",
    "corpus_stats": f"""with {SQL_INDEX} select source, field, n_docs, round(avgdl, 6) as avgdl from corpus""",
    "search_one": f"""{_scored(asked=_LONGEST)} select source, _id, score from ranked where rank <= 10""",
    "search_batch": f"{_scored()} {_TOP}",
    "search_title_only": f"{_scored(boosts='(' + chr(39) + 'title' + chr(39) + ', 2.0)')} {_TOP}",
    "search_best_fields": f"{_scored()} select query_id, source, _id, score from scored",
    "search_wildcard": f"{_scored(where=chr(39) + 'recipes-from-' + chr(39) + ' || t.source like ' + chr(39) + 'recipes-from-src1%' + chr(39))} {_TOP}",
    "search_global_scope": f"{_scored(scope='global')} {_TOP}",
    "search_no_hits": f"""{_scored(asked=_GUARDS)} select query_id,
        query_id not in (select query_id from ranked) as no_results from asked""",
    "search_documents": f"""{_scored()} select query_id, cast(rank as integer) as rank, r.source, r._id, d.title,
        cast(case when d.ingredient is null then 0 else d.n end as integer) as n_ingredients
        from ranked r join (select source, _id, title, ingredient, n from recipes
          join (select cast(doc_id as varchar) as nid, len(string_split(text, chr(10))) - 1 as n from documents)
          on nid = _id) d on d.source = r.source and d._id = r._id where rank <= 10""",
    "result_lines": """with l as (select source, cast(doc_id as varchar) as _id,
          string_split(text, chr(10)) as lines from documents),
        e as (select source, _id, unnest(range(len(lines))) as i, unnest(lines) as line from l)
        select source, _id, case when i = 0 then 'title' else 'ingredient' end as section,
          cast(case when i = 0 then 0 else i - 1 end as integer) as line_no, line from e""",
    "wildcard_indexes": """select 'recipes-from-' || source as index_name, cast(doc_id as varchar) as _id
        from documents where 'recipes-from-' || source like 'recipes-from-src1%'""",
}
