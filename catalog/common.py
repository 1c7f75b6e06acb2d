"""Given tables seen as the engine's inputs, and SQL fragments shared by the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.operators import select as s
from ladle.operators.extract import Layout
from ladle.operators.index import Index, build_index, open_index, place_index
from ladle.operators.sizing import spread
from ladle.operators.tree import Wanted
from ladle.operators.upsert import documents, upsert
from ladle.session import scratch

URL_PREFIX = "https://pages.example/recipe/"
TITLE_SUFFIX = "."

# Where the given pages keep their fields.
GIVEN_LAYOUT = Layout(
    ingredients=lambda n: s.descendants(n, s.select(n, s.is_tag("nav")), s.is_tag("a")),
    steps=lambda n: s.select(n, s.both(s.is_tag("p"), s.child_of(n, s.is_tag("article")))),
    images=lambda n: s.descendants(n, s.select(n, s.has_class("ad")), s.is_tag("img")),
    container=lambda n: s.select(n, s.is_tag("footer")),
    summary=lambda n: s.select(n, s.has_class("ad", "advert")),
    title_suffix=TITLE_SUFFIX,
    wanted=Wanted(("nav", "a", "p", "article", "img", "footer"), ("ad", "advert"), attrs=("src",)),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def given_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages for heavy per-row work."""
    return spread(table(spark, sf_dir, "pages"))


def recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as recipes: the first line is the title, the others are ingredients."""
    lines = F.split("text", "\n")
    empty = F.array().cast("array<string>")
    return table(spark, sf_dir, "documents").select(
        "source", F.col("doc_id").cast("string").alias("_id"),
        F.get(lines, F.lit(0)).alias("title"), F.lit(None).cast("string").alias("summary"),
        F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))).alias("ingredient"),
        empty.alias("steps"), empty.alias("images"))


def numbered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages under the URL of their id, as if fetched by id."""
    return given_pages(spark, sf_dir).withColumn(
        "url", F.concat(F.lit(URL_PREFIX), F.col("page_id").cast("string")))


def last_id(spark: SparkSession, sf_dir: str) -> int:
    return table(spark, sf_dir, "pages").agg(F.max("page_id")).first()[0]


_BUILT: dict[tuple[str, str], tuple[str, str]] = {}


def built_index(spark: SparkSession, sf_dir: str) -> tuple[Index, str]:
    """Index and document table of the given documents, written once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        base = scratch(spark, "catalog")
        upsert(recipes(spark, sf_dir).withColumn("version", F.lit(0)), f"{base}/documents")
        build_index(documents(spark, f"{base}/documents"), f"{base}/index")
        place_index(spark, f"{base}/index")
        _BUILT[key] = (f"{base}/documents", f"{base}/index")
    docs, index = _BUILT[key]
    return open_index(spark, index), docs


def bench_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"))


# -- SQL ------------------------------------------------------------------------------

# Un-escape the entities the given pages use, '&amp;' last.
def sql_unescape(x: str) -> str:
    for entity, char in (("&quot;", '"'), ("&#x27;", "''"), ("&lt;", "<"), ("&gt;", ">"),
                         ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


SQL_RECIPES = """recipes as (
  select source, cast(doc_id as varchar) as _id,
         string_split(text, chr(10))[1] as title,
         array_to_string(string_split(text, chr(10))[2:], chr(10)) as ingredient
  from documents)"""

SQL_TOKEN = r"(?:[\p{L}\p{M}_]+(?:[.''’:·][\p{L}\p{M}_]+)*|[\p{N}_]+(?:[.,;''’][\p{N}_]+)*)+"


def sql_tokens(text: str) -> str:
    return f"unnest(list_filter(regexp_extract_all({text}, '{SQL_TOKEN}'), lambda t: replace(t, '_', '') <> ''))"


def sql_light_stem(t: str) -> str:
    return f"""case when not regexp_matches({t}, '^[a-z]+$') then {t}
      when regexp_matches({t}, '(us|ss)$') or not regexp_matches({t}, '^.{{2,}}s$') then {t}
      when regexp_matches({t}, '[^ae]ies$') then left({t}, length({t}) - 3) || 'y'
      when regexp_matches({t}, '[iaoe]es$') then {t}
      else left({t}, length({t}) - 1) end"""


def sql_finish(t: str) -> str:
    out = f"regexp_replace({t}, '[''’＇][sS]$', '')"
    out = f"lower({out})"
    return (f"replace(translate({out}, 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ’', "
            f"'aaaaaaceeeeiiiinooooouuuuyy'''), 'ß', 'ss')")


def sql_term(t: str) -> str:
    return sql_finish(f"({sql_light_stem(t)})")


SQL_FIELDS = """fields as (
  select source, _id, 'title' as field, title as txt from recipes
  union all select source, _id, 'ingredient', ingredient from recipes)"""

SQL_TERMS = f"""terms as (
  select source, _id, field, {sql_term('tok')} as term
  from (select source, _id, field, {sql_tokens('txt')} as tok from fields))"""

SQL_TF = "tf as (select source, _id, field, term, count(*) as tf from terms group by all)"
SQL_DL = "dl as (select source, _id, field, cast(sum(tf) as bigint) as dl from tf group by all)"
SQL_DF = "dfs as (select source, field, term, count(*) as df from tf group by all)"
SQL_CORPUS = "corpus as (select source, field, count(*) as n_docs, avg(dl) as avgdl from dl group by all)"
SQL_INDEX = ",\n".join([SQL_RECIPES, SQL_FIELDS, SQL_TERMS, SQL_TF, SQL_DL, SQL_DF, SQL_CORPUS])
