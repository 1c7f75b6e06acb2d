"""Pages -> typed results with a status (jobs over trees; no shuffle before the final join)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladle.functions.urls import document_id, recipe_url, url_key
from ladle.functions.values import (clean_title, collapse_space, keep_not_blank, retryable,
                                    trim_space)
from ladle.operators import select as s
from ladle.operators.tree import Wanted, parse_pages
from ladle.schemas import RECIPE
from ladle.sources.ids import id_range
from ladle.sources.pages import of_keys, with_url_key

Finder = Callable[[Column], Column]


@dataclass(frozen=True)
class Layout:
    """Where a site keeps its fields. Each finder maps the `nodes` array to matching nodes.

    `wanted` lists the tags and classes that the finders name, so that no other element is passed on; without it
    all are.
    """

    ingredients: Finder
    steps: Finder
    images: Finder
    container: Finder
    summary: Finder
    title_suffix: str = ""
    wanted: Wanted | None = None


# Class names of the two page layouts and the title suffix of the site.
RECIPE_SITE = Layout(
    ingredients=lambda n: s.select(n, s.has_class("ingredients-item-name", "recipe-ingred_txt")),
    steps=lambda n: s.select(n, s.either(
        s.both(s.has_class("section-body"), s.child_of(n, s.has_class("instructions-section-item"))),
        s.has_class("recipe-directions__list--item"))),
    images=lambda n: s.descendants(
        n, s.descendants(n, s.select(n, s.has_class("image-slide")), s.is_tag("noscript")), s.is_tag("img")),
    container=lambda n: s.select(n, s.has_class("recipe-container", "recipe-container-outer")),
    summary=lambda n: s.select(n, s.has_class("recipe-summary")),
    title_suffix=" | Allrecipes",
    wanted=Wanted(("noscript", "img"), (
        "ingredients-item-name", "recipe-ingred_txt", "section-body", "instructions-section-item",
        "recipe-directions__list--item", "image-slide", "recipe-container", "recipe-container-outer",
        "recipe-summary"), attrs=("src",)),
)


def document_title(text: Column, nodes: Column) -> Column:
    """Text of the first title element, white space collapsed; null without one."""
    found = s.select(nodes, s.is_tag("title"))
    return s.of_first(found, lambda n: collapse_space(s.text_of(text, n)))


def extract_fields(pages: DataFrame, layout: Layout) -> DataFrame:
    """Raw fields of every page, beside all page columns but its markup."""
    keep = [c for c in pages.columns if c != "html"]
    nodes, text, html = F.col("nodes"), F.col("text"), F.col("html")
    # The title is read whatever the layout.
    wanted = layout.wanted.with_tags("title") if layout.wanted else None
    return parse_pages(pages, wanted).select(
        *keep,
        s.of_first(layout.container(nodes), lambda n: trim_space(s.inner_html(html, n))).alias("html"),
        clean_title(document_title(text, nodes), layout.title_suffix).alias("title"),
        s.of_first(layout.summary(nodes), lambda n: trim_space(s.text_of(text, n))).alias("summary"),
        keep_not_blank(s.texts(text, layout.ingredients(nodes))).alias("ingredient"),
        keep_not_blank(s.texts(text, layout.steps(nodes))).alias("steps"),
        keep_not_blank(s.attr_values(layout.images(nodes), "src")).alias("images"),
    )


def status_of(http_status: Column, ingredient: Column, steps: Column) -> Column:
    """Ordered rules; a null `http_status` means that nothing was fetched."""
    return (F.when(http_status.isNull() | (http_status != 200), "networkFailure")
             .when(F.size(ingredient) == 0, "parseFailure")
             .when(F.size(steps) == 0, "parseFailure")
             .otherwise("success"))


def with_http_status(pages: DataFrame) -> DataFrame:
    """Stored pages without a status column were fetched successfully."""
    if "http_status" in pages.columns:
        return pages
    return pages.withColumn("http_status", F.lit(200))


def newest_per_key(df: DataFrame, key: str = "url_key", version: str = "page_id") -> DataFrame:
    """One row per key: the highest version. Ranks are cut inside each input partition before
    the shuffle, so many copies under one key never meet in one task."""
    rank = Window.partitionBy(key).orderBy(F.col(version).desc())
    return df.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank")


def lookup_pages(keys: DataFrame, pages: DataFrame) -> DataFrame:
    """One row per key; `page_id` and `html` are null where no page is stored.

    Few keys are broadcast to the page scan, so only wanted pages are shuffled.
    """
    wanted = keys.withColumn("url_key", url_key(F.col("url")))
    stored = of_keys(with_http_status(pages), wanted).select("url_key", "page_id", "html", "http_status")
    return wanted.join(newest_per_key(stored), "url_key", "left")


def extract(ids: DataFrame, pages: DataFrame, layout: Layout = RECIPE_SITE,
            narrowed: bool = False) -> DataFrame:
    """Results for `ids(recipe_id, url)`: every id gives a row, with or without a page.

    Pages are parsed where they lie and only the extracted fields travel to the join.
    `narrowed` says that `pages` holds no page outside `ids`.
    """
    wanted = ids.withColumn("url_key", url_key(F.col("url")))
    stored = with_http_status(pages)
    stored = with_url_key(stored) if narrowed else of_keys(stored, wanted)
    stored = stored.select("url_key", "page_id", "html", "http_status")
    fields = newest_per_key(extract_fields(stored, layout))
    return classify(wanted.join(fields, "url_key", "left"))


def pages_of_range(pages: DataFrame, start: int, end: int, prefix: str) -> DataFrame:
    """Pages whose URL is `prefix` and an id in `[start, end)`: told from the URL alone, so a
    range of any size needs no join to pick its pages."""
    # As a value, the prefix reaches the reader of stored pages, whose files are sorted by key.
    head = F.lit(pages.sparkSession.range(1).select(url_key(F.lit(prefix))).first()[0])
    pages, key = with_url_key(pages), F.col("url_key")
    number = F.try_to_number(F.substr(key, F.length(head) + 1), F.lit("9" * 19)).cast("bigint")
    return (pages.where(key.startswith(head)).withColumn("_id", number)
                 .where(F.col("_id").between(start, end - 1)
                        & (key == url_key(recipe_url(prefix, F.col("_id")))))
                 .drop("_id"))


def extract_range(spark: SparkSession, start: int, end: int, pages: DataFrame, prefix: str,
                  layout: Layout = RECIPE_SITE) -> DataFrame:
    """Results for the ids `[start, end)` under a URL prefix; no rows for an empty range."""
    return extract(id_range(spark, start, end, prefix), pages_of_range(pages, start, end, prefix),
                   layout, narrowed=True)


def classify(assembled: DataFrame) -> DataFrame:
    """Status, and the recipe exactly where the status is success."""
    status = status_of(F.col("http_status"), F.col("ingredient"), F.col("steps"))
    recipe = F.struct(
        document_id(F.col("url"), F.col("recipe_id")).alias("_id"),
        "title", "summary", "ingredient", "steps", "images").cast(RECIPE)
    return assembled.withColumn("status", status).select(
        (F.col("recipe_id") + 1).alias("id"),
        "recipe_id",
        F.col("url").alias("source"),
        "status",
        F.when(F.col("status") != "networkFailure", F.col("html")).alias("html"),
        F.when(F.col("status") == "success", recipe).alias("recipe"),
        F.coalesce(retryable(F.col("http_status")), F.lit(False)).alias("retryable"),
    )


def status_summary(results: DataFrame) -> DataFrame:
    size = lambda field: F.coalesce(F.sum(F.size(F.col(f"recipe.{field}"))), F.lit(0))
    return results.groupBy("status").agg(
        F.count("*").alias("n"),
        size("ingredient").alias("ingredients"),
        size("steps").alias("steps"))
