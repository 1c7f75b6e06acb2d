"""Crawl: reachability and its streaming twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.common import given_pages, sql_unescape, table
from ladle.functions.urls import url_key
from ladle.operators.links import links
from ladle.operators.reach import crawl, reach
from ladle.session import scratch, settle
from ladle.sources.ids import sequence_ids
from ladle.streaming.frontier import FRONTIER, crawl_step, crawl_until_idle, first_seen
from ladle.streaming.seen import first_seen_for

def crawl_reach(spark, sf_dir):
    """Orders and parts as a graph, to the fixpoint; seeds are the parts of the highest price."""
    items = table(spark, sf_dir, "lineitem")
    order = F.concat(F.lit("o"), F.col("l_orderkey").cast("string"))
    part = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    there = items.select(order.alias("src"), part.alias("dst"))
    back = items.select(part.alias("src"), order.alias("dst"))
    edges = there.unionByName(back)
    parts = table(spark, sf_dir, "part")
    best = parts.agg(F.max("p_retailprice").alias("p_retailprice"))
    seeds = parts.join(best, "p_retailprice", "left_semi").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("node"))
    return reach(seeds, edges)


def page_crawl(spark, sf_dir):
    """All pages as seeds: their links are one hop away."""
    pages = given_pages(spark, sf_dir)
    return crawl(pages.select(url_key(F.col("url")).alias("url_key")), pages)


def deep_crawl(spark, sf_dir):
    """Pages under the URLs of the links found on them, so that a crawl goes on from page to page.

    Links are numbered in order and dealt to the pages by id; where pages outnumber links, the newest
    copy under a URL counts. The first page is the seed.
    """
    pages = given_pages(spark, sf_dir)
    found = settle(links(pages).select("link_key").distinct(), "link-keys")
    numbered = sequence_ids(found, ["link_key"], start=-1).withColumnRenamed("id", "n")
    moved = pages.drop("url").withColumn("n", F.col("page_id") % found.count()).join(numbered, "n").select(
        "page_id", F.col("link_key").alias("url"), "html")
    return crawl(numbered.where("n = 0").select(F.col("link_key").alias("url_key")), moved)


def stream_dedupe(spark, sf_dir):
    """Every URL of the page table twice through the streaming dedupe."""
    source, out = scratch(spark, "stream-in"), scratch(spark, "stream-out")
    urls = table(spark, sf_dir, "pages").select("url")
    urls.unionAll(urls).write.parquet(source)
    stream = spark.readStream.schema("url string").parquet(source)
    query = (first_seen(stream).writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", scratch(spark, "stream-checkpoint"))
             .trigger(availableNow=True).start(out))
    query.awaitTermination()
    return spark.read.schema("url string, url_key string").parquet(out).select("url_key")


def stream_dedupe_state(spark, sf_dir):
    """Every URL of the page table twice, in two runs on one checkpoint, through the dedupe with state of its own."""
    source, out, checkpoint = (scratch(spark, f"stream-{name}") for name in ("in", "out", "checkpoint"))
    urls = table(spark, sf_dir, "pages").select("url")
    for _ in range(2):
        urls.write.mode("append").parquet(source)
        stream = spark.readStream.schema("url string").parquet(source)
        query = (first_seen_for(stream, buckets=64).writeStream.format("parquet").outputMode("append")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out))
        query.awaitTermination()
    return spark.read.schema("url string, url_key string").parquet(out).select("url_key")


def stream_crawl(spark, sf_dir):
    """The streaming crawl from all page URLs until no new URL appears."""
    pages = table(spark, sf_dir, "pages")
    found = crawl_until_idle(spark, pages.select("url"), pages, scratch(spark, "stream-crawl"))
    return found.select("url_key", "status", F.length("html").alias("html_chars"))


def replayed_batch(spark, sf_dir):
    """One micro-batch of all page URLs, run twice as after a failure: what stands in the frontier, and rows in its tables."""
    pages = table(spark, sf_dir, "pages")
    base = scratch(spark, "replayed")
    batch = pages.groupBy(url_key(F.col("url")).alias("url_key")).agg(F.min("url").alias("url"))
    for _ in range(2):
        crawl_step(batch, 0, pages, f"{base}/out", f"{base}/frontier")
    tables = [spark.read.parquet(f"{base}/out/{name}").agg(F.count("*").alias(name)) for name in ("visited", "pages")]
    sent = spark.read.schema(FRONTIER).parquet(f"{base}/frontier/batch-0")
    # Both tables are one row each.
    return sent.withColumn("visited", F.lit(tables[0].first()[0])).withColumn("stored", F.lit(tables[1].first()[0]))


QUERIES = {
    "crawl_reach": crawl_reach,
    "page_crawl": page_crawl,
    "deep_crawl": deep_crawl,
    "stream_dedupe": stream_dedupe,
    "stream_dedupe_state": stream_dedupe_state,
    "stream_crawl": stream_crawl,
    "replayed_batch": replayed_batch,
}

_KEY = "regexp_replace(url, '#.*$', '')"
_LINKS = f"""links as (select distinct regexp_replace(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || {sql_unescape('raw')}, '#.*$', '') as url_key
    from (select url, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1)) as raw
      from pages where page_id in (select max(page_id) from pages group by regexp_replace(url, '#.*$', ''))))"""

_ALL_LINKS = f"""links as (select distinct regexp_replace(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || {sql_unescape('raw')}, '#.*$', '') as url_key
    from (select url, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1)) as raw from pages))"""

ORACLES = {
    "replayed_batch": f"""with seeds as (select distinct {_KEY} as url_key from pages),
      found as (select regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || {sql_unescape('raw')} as link
        from (select url, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1)) as raw
          from pages where page_id in (select max(page_id) from pages group by {_KEY})))
      select min(link) as url, (select count(*) from seeds) as visited, (select count(*) from seeds) as stored from found
      where regexp_replace(link, '#.*$', '') not in (select url_key from seeds) group by regexp_replace(link, '#.*$', '')""",
    "crawl_reach": """with recursive edges as (
        select 'o' || l_orderkey as src, 'p' || l_partkey as dst from lineitem
        union select 'p' || l_partkey, 'o' || l_orderkey from lineitem),
      walk(node, depth) using key (node) as (
        select 'p' || p_partkey, 0 from part where p_retailprice = (select max(p_retailprice) from part)
        union
        select distinct e.dst, w.depth + 1 from walk w join edges e on e.src = w.node
          where e.dst not in (select node from recurring.walk))
      select node, cast(depth as integer) as depth from walk""",
    "page_crawl": f"""with {_LINKS}, seeds as (select distinct {_KEY} as url_key from pages)
      select url_key, cast(0 as integer) as depth from seeds union all
      select url_key, cast(1 as integer) from links where url_key not in (select url_key from seeds)""",
    "deep_crawl": f"""with recursive {_ALL_LINKS},
      numbered as (select url_key, row_number() over (order by url_key) - 1 as n from links),
      moved as (select page_id, url_key as url, html from pages
        join numbered on n = page_id % (select count(*) from numbered)),
      newest as (select url, html from moved where page_id in (select max(page_id) from moved group by url)),
      found as (select url, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1)) as raw from newest),
      edges as (select distinct url as src, regexp_replace(regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)
          || {sql_unescape('raw')}, '#.*$', '') as dst from found),
      walk(url_key, depth) using key (url_key) as (
        select url_key, 0 from numbered where n = 0
        union
        select distinct e.dst, w.depth + 1 from walk w join edges e on e.src = w.url_key
          where e.dst not in (select url_key from recurring.walk))
      select url_key, cast(depth as integer) as depth from walk""",
    "stream_dedupe": f"select distinct {_KEY} as url_key from pages",
    "stream_dedupe_state": f"select distinct {_KEY} as url_key from pages",
    "stream_crawl": f"""with {_LINKS}, seeds as (select {_KEY} as url_key, max_by(html, page_id) as html from pages group by 1)
      select url_key, 'success' as status, cast(length(html) as integer) as html_chars from seeds union all
      select url_key, 'networkFailure', null from links where url_key not in (select url_key from seeds)""",
}
