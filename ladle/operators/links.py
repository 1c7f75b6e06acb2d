"""Links of pages: anchors with a target, resolved against their page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.functions.urls import is_absolute, resolve, url_key
from ladle.operators import select as s
from ladle.operators.extract import newest_per_key
from ladle.operators.tree import Wanted, parse_pages

ANCHORS = Wanted(tags=("a",), attrs=("href",), text=False)


def links(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), newest: bool = False) -> DataFrame:
    """One row per anchor: page columns, `pre`, `href`, absolute `link` and its `link_key`.

    Nothing but anchors leaves the parser, so `pre` is the place among them.
    `newest` keeps only the latest stored page of each URL key.
    """
    anchors = s.select(F.col("nodes"), s.both(s.is_tag("a"), s.has_attr("href")))
    needed = [c for c in dict.fromkeys([*keep, "url", *(["page_id"] if newest else [])])]
    per_page = parse_pages(pages.select(*needed, "html"), ANCHORS).select(
        *needed, F.transform(anchors, lambda n: F.struct(
            n["pre"].alias("pre"), n["attrs"]["href"].alias("href"))).alias("anchors"))
    if newest:
        per_page = newest_per_key(per_page.withColumn("url_key", url_key(F.col("url"))))
    linked = (per_page.select(*keep, F.col("url").alias("_base"), F.explode("anchors").alias("a"))
                      .select(*keep, "a.pre", "a.href", resolve(F.col("_base"), F.col("a.href")).alias("link")))
    return linked.where(is_absolute(F.col("link"))).withColumn("link_key", url_key(F.col("link")))


def distinct_links(found: DataFrame) -> DataFrame:
    """One row per page and link key; the first spelling in document order stays."""
    return (found.groupBy("page_id", "link_key")
                 .agg(F.min(F.struct("pre", "link")).alias("_first"))
                 .select("page_id", "link_key", "_first.pre", "_first.link"))


def unvisited(found: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct link keys that `visited(url_key)` does not hold.

    Keys are made distinct first: a link that fills a third of all pages is one row per
    input partition when it reaches the shuffle.
    """
    fresh = (found.groupBy(F.col("link_key").alias("url_key"))
                  .agg(F.min("link").alias("url")))
    return fresh.join(visited.select("url_key"), "url_key", "left_anti")
