import warnings

import pytest
from pyspark.sql import functions as F

from ladle.operators.index import open_index
from ladle.operators.reach import Unfinished, crawl, reach
from ladle.operators.search import result_lines
from ladle.plans.jobs import extract_and_land, index_all, search_documents
from ladle.operators.upsert import upsert
from ladle.streaming.frontier import crawl_step, crawl_until_idle, first_seen

PAGES = "page_id bigint, url string, html string"
RECIPE_DDL = ("_id string, title string, summary string, ingredient array<string>, steps array<string>, "
              "images array<string>")
PREFIX = "https://www.site.example/recipe/"


def graph_pages(spark):
    """a -> b -> a (cycle), b -> c (no page), c unreachable pair x <-> y."""
    return spark.createDataFrame([
        (1, "http://g.example/a", '<a href="b">b</a><a href="/b#part">again</a>'),
        (2, "http://g.example/b", '<a href="a">a</a><a href="http://G.example:80/c">c</a>'),
        (3, "http://g.example/x", '<a href="y">y</a>'),
        (4, "http://g.example/y", '<a href="x">x</a>')], PAGES)


def test_reach(spark, rows):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 4), (8, 9), (None, 5)], "src int, dst int")
    seeds = spark.createDataFrame([(1,), (1,), (None,)], "node int")
    assert rows(reach(seeds, edges, 10)) == [(1, 0), (2, 1), (3, 2), (4, 3)]
    assert rows(reach(seeds, edges, 2)) == [(1, 0), (2, 1), (3, 2)]
    assert rows(reach(seeds.where("node > 5"), edges, 2)) == []


def test_crawl_batch_and_stream_agree(spark, tmp_path, rows):
    pages = graph_pages(spark)
    batch = crawl(spark.createDataFrame([("http://g.example/a",)], "url_key string"), pages, 10)
    assert rows(batch) == [("http://g.example/a", 0), ("http://g.example/b", 1), ("http://g.example/c", 2)]
    seeds = spark.createDataFrame([("http://G.example/a#top",)], "url string")
    stored = crawl_until_idle(spark, seeds, pages, str(tmp_path / "crawl"))
    assert rows(stored, "url_key", "status") == [
        ("http://g.example/a", "success"), ("http://g.example/b", "success"), ("http://g.example/c", "networkFailure")]
    # Starting again on the same checkpoint finds nothing new.
    again = crawl_until_idle(spark, seeds, pages, str(tmp_path / "crawl"))
    assert again.count() == 3


def test_stream_dedupe_with_a_hot_key(spark, tmp_path, rows):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("http://hot.example/",)] * 500 + [(f"http://h.example/{i % 50}#f{i}",) for i in range(500)],
                          "url string").write.parquet(source)
    query = (first_seen(spark.readStream.schema("url string").parquet(source)).writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out))
    query.awaitTermination()
    got = spark.read.schema("url string, url_key string").parquet(out)
    assert got.count() == 51 and got.select("url_key").distinct().count() == 51


def test_bounded_dedupe(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.sql("""select 'http://h.example/#' || id as url, timestamp'2024-01-01' + make_dt_interval(0, 0, id) as ts
                 from range(5)""").write.parquet(source)
    stream = spark.readStream.schema("url string, ts timestamp").parquet(source)
    query = (first_seen(stream, horizon="1 hour").writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(out))
    query.awaitTermination()
    assert spark.read.schema("url string, ts timestamp, url_key string").parquet(out).count() == 1


def page(i, title):
    return (i, PREFIX + str(i), f"<title>{title} | Allrecipes</title><b class=recipe-ingred_txt>{title} flour</b>"
                                "<b class=recipe-directions__list--item>Bake.</b>")


def test_jobs_end_to_end(spark, tmp_path, rows):
    landed, base = str(tmp_path / "landed"), str(tmp_path / "base")
    pages = spark.createDataFrame([page(i, f"Pie{i}") for i in range(1, 121)], PAGES)
    extract_and_land(spark, 5, 5, pages, landed, PREFIX)
    assert not (tmp_path / "landed").exists()
    extract_and_land(spark, 1, 131, pages, landed, PREFIX)
    (tmp_path / "landed" / "source=all-recipes" / "bad.txt").write_text("<html>")
    report = index_all(spark, landed, base, recreate=True)
    assert rows(report) == [("all-recipes", 120, 0, True)]
    assert rows(spark.read.parquet(f"{base}/quarantine"), "body") == [("<html>",)]
    queries = spark.createDataFrame([(1, "pie7"), (2, "flour")], "query_id int, query string")
    hits = search_documents(spark, queries, base)
    assert rows(hits.where("query_id = 1"), "_id", "title") == [("www.site.example-7", "Pie7")]
    assert hits.where("query_id = 2").count() == 10
    assert rows(result_lines(hits.where("query_id = 1")), "section", "line") == [
        ("ingredient", "Pie7 flour"), ("step", "Bake."), ("title", "Pie7")]
    # A later run rewrites one page and adds another; the rest stays.
    extract_and_land(spark, 7, 8, spark.createDataFrame([page(7, "Cake7")], PAGES), landed, PREFIX)
    index_all(spark, landed, base)
    titles = search_documents(spark, queries, base).where("query_id = 1")
    assert titles.count() == 0
    cake = spark.createDataFrame([(1, "cake7")], "query_id int, query string")
    assert rows(search_documents(spark, cake, base), "_id") == [("www.site.example-7",)]


def test_a_cut_crawl_is_reported(spark, tmp_path, rows):
    edges = spark.createDataFrame([(i, i + 1) for i in range(12)], "src int, dst int")
    seeds = spark.createDataFrame([(0,)], "node int")
    assert reach(seeds, edges).count() == 13
    with pytest.warns(Unfinished):
        assert reach(seeds, edges, 3).count() == 4
    with warnings.catch_warnings():
        warnings.simplefilter("error", Unfinished)
        reach(seeds, edges, 13)
    start = spark.createDataFrame([("http://g.example/a",)], "url string")
    with pytest.raises(RuntimeError):
        crawl_until_idle(spark, start, graph_pages(spark), str(tmp_path / "cut"), max_runs=1)
    done = crawl_until_idle(spark, start, graph_pages(spark), str(tmp_path / "cut"))
    assert done.count() == 3


def test_later_seeds_are_crawled(spark, tmp_path, rows):
    pages, base = graph_pages(spark), str(tmp_path / "crawl")
    for seed in ("http://g.example/a", "http://g.example/x"):
        found = crawl_until_idle(spark, spark.createDataFrame([(seed,)], "url string"), pages, base)
    assert rows(found, "url_key") == [(f"http://g.example/{p}",) for p in "abcxy"]


def test_a_replayed_batch_leaves_the_same_tables(spark, tmp_path, rows):
    out, frontier = str(tmp_path / "out"), str(tmp_path / "frontier")
    batch = spark.createDataFrame([("http://g.example/a", "http://g.example/a")], "url string, url_key string")
    kept = []
    for _ in range(2):
        crawl_step(batch, 0, graph_pages(spark), out, frontier)
        kept.append([rows(spark.read.parquet(f"{out}/{t}/batch=0")) for t in ("visited", "pages", "links")]
                    + [rows(spark.read.parquet(f"{frontier}/batch-0"))])
    assert kept[0] == kept[1] and kept[0][-1] == [("http://g.example/b",)]


def test_index_all_builds_a_missing_index(spark, tmp_path):
    landed, base = str(tmp_path / "landed"), str(tmp_path / "base")
    pages = spark.createDataFrame([(1, f"{PREFIX}1", "<title>Pie</title>")], PAGES)
    extract_and_land(spark, 1, 2, pages, landed, PREFIX)
    upsert(spark.createDataFrame([("all-recipes", 0, "x-1", "Pie", None, ["apple"], ["bake"], [])],
                                 f"source string, version int, {RECIPE_DDL}"), f"{base}/documents")
    index_all(spark, landed, base)
    assert open_index(spark, f"{base}/index").names().first()["documents"] == 1


def test_many_edges_are_not_exchanged_again(spark, rows, monkeypatch, tmp_path):
    # With a frontier over the broadcast limit, every level shuffled all edges.
    from ladle.operators import reach as module
    from ladle.operators import sizing

    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(module, "EDGES_PER_BUCKET", 4)
    pairs = [(i, 2 * i) for i in range(1, 12)] + [(i, 2 * i + 1) for i in range(1, 12)] + [(9, 1), (50, 1)]
    edges = spark.createDataFrame(pairs, "src long, dst long")
    stored = module._by_source(edges)
    frontier = spark.createDataFrame([(i,) for i in range(9)], "src long")
    plan = stored.join(frontier.hint("merge"), "src")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    found = rows(module.reach(spark.createDataFrame([(1,)], "node long"), edges))
    assert found == sorted(((n, n.bit_length() - 1) for n in range(1, 24)), key=repr)
