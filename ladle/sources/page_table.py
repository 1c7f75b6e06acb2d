"""Stored pages as a table bucketed by URL key: lookups by key move only the keys asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.operators.extract import newest_per_key, with_http_status
from ladle.sources.keyed import Keyed
from ladle.sources.pages import keyed_pages

PAGES_PER_BUCKET = 20_000
_COLUMNS = ("page_id bigint, url string, html string, http_status int, host string, url_key string, store_key string")


def page_table(path: str, pages_per_bucket: int = PAGES_PER_BUCKET) -> Keyed:
    return Keyed(path, "url_key", _COLUMNS, rows_per_bucket=pages_per_bucket)


def store_page_table(pages: DataFrame, path: str, load: int, pages_per_bucket: int = PAGES_PER_BUCKET) -> None:
    """Write `pages(page_id, url, html [, http_status])` as load `load`; the newest copy of each URL key stays.

    A URL that fills a third of the pages is cut to one row per input partition before anything is exchanged.
    Earlier loads are put together, into more buckets if there are too many pages for them.
    """
    spark = pages.sparkSession
    table = page_table(path, pages_per_bucket)
    table.tidy(spark, load)
    table.write(newest_per_key(keyed_pages(with_http_status(pages))), load,
                0 if table.buckets(spark) else pages.count())


def read_page_table(spark: SparkSession, path: str, only_host: str | None = None) -> DataFrame:
    """The page of each key's last load. Files are sorted by key, so the pages of `only_host` lie together
    and the statistics of the row groups skip the others."""
    stored = page_table(path).newest(spark).drop("load")
    return stored if only_host is None else stored.where(F.col("host") == only_host)
