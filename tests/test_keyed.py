"""Tables bucketed by key: loads, generations, and joins that leave the stored side where it is."""

import pytest
from pyspark.sql import functions as F

from ladle.operators.extract import lookup_pages
from ladle.operators.links import unvisited
from ladle.sources.keyed import MERGED, Keyed
from ladle.sources.page_table import page_table, read_page_table, store_page_table

COLUMNS = "k string, v int"


def keyed(tmp_path, **options):
    return Keyed(str(tmp_path / "table"), "k", COLUMNS, **options)


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), COLUMNS)


def moved_scans(df):
    """Bucketed scans, and those of them that an exchange lies above."""
    found, moved, todo = 0, 0, [(df._jdf.queryExecution().executedPlan(), False)]
    while todo:
        node, below = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append((node.initialPlan(), below))
            continue
        if name.startswith("Scan") and "Bucketed: true" in node.toString():
            found, moved = found + 1, moved + below
        children = node.children()
        todo += [(children.apply(i), below or name == "Exchange") for i in range(children.size())]
    return found, moved


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_loads_replace_themselves(spark, tmp_path, rows):
    table = keyed(tmp_path)
    assert rows(table.read(spark)) == [] and table.read(spark).columns == ["k", "v", "load"]
    assert not table.tidy(spark, 1) and table.buckets(spark) is None
    table.write(frame(spark, ("a", 1), ("b", 2), (None, 9)), 0)
    table.write(frame(spark, ("b", 3), ("c", 4)), 1)
    table.write(frame(spark, ("b", 5)), 1)
    assert rows(table.read(spark)) == [("a", 1, 0), ("b", 2, 0), ("b", 5, 1), (None, 9, 0)]
    assert rows(table.newest(spark), "k", "v") == [("a", 1), ("b", 5), (None, 9)]


def test_a_load_may_read_the_table(spark, tmp_path, rows):
    table = keyed(tmp_path)
    table.write(frame(spark, ("a", 1)), 0)
    for _ in range(2):
        new = frame(spark, ("a", 7), ("b", 2)).join(table.read(spark).where("load < 1").select("k"), "k", "left_anti")
        table.write(new, 1)
    assert rows(table.read(spark)) == [("a", 1, 0), ("b", 2, 1)]


def test_an_application_that_did_not_write_it(spark, tmp_path, rows):
    table = keyed(tmp_path)
    table.write(frame(spark, ("a", 1)), 0)
    table.write(frame(spark, ("b", 2)), 1)
    name = [t.name for t in spark.catalog.listTables() if t.name == table._name(table._shape(spark))]
    spark.sql(f"drop table {name[0]}")
    assert rows(table.read(spark)) == [("a", 1, 0), ("b", 2, 1)]
    table.write(frame(spark, ("c", 3)), 2)
    assert rows(table.newest(spark), "k") == [("a",), ("b",), ("c",)]


def test_tidy_merges_and_grows(spark, tmp_path, rows):
    table = keyed(tmp_path, rows_per_bucket=2, most_loads=3)
    for load in range(4):
        table.write(frame(spark, ("same", load), (f"k{load}", load)), load)
    first = table.buckets(spark)
    assert not table.tidy(spark, 3) and table.tidy(spark, 4)
    assert rows(table.read(spark)) == [("k0", 0, MERGED), ("k1", 1, MERGED), ("k2", 2, MERGED), ("k3", 3, MERGED),
                                       ("same", 3, MERGED)]
    many = spark.range(60).select(F.concat(F.lit("n"), "id").alias("k"), F.col("id").cast("int").alias("v"))
    table.write(many, 4)
    # Too full for its buckets; the load that may be written again stays apart.
    assert table.tidy(spark, 4) and table.buckets(spark) > first
    assert rows(table.read(spark).groupBy("load").count()) == [(MERGED, 5), (4, 60)]
    assert table.read(spark).inputFiles() and not table.tidy(spark, 4)


def test_a_failed_tidy_leaves_the_table(spark, tmp_path, rows, monkeypatch):
    table = keyed(tmp_path, most_loads=1)
    for load in range(2):
        table.write(frame(spark, ("a", load), (f"k{load}", load)), load)
    before = rows(table.read(spark))
    with monkeypatch.context() as patched:
        patched.setattr(Keyed, "_record", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.tidy(spark, 2)
    assert rows(table.read(spark)) == before
    assert table.tidy(spark, 2) and rows(table.read(spark), "k", "v") == [("a", 1), ("k0", 0), ("k1", 1)]


def test_stored_side_is_not_exchanged(spark, tmp_path, no_broadcast):
    table = Keyed(str(tmp_path / "visited"), "url_key", "url_key string, url string", load="batch")
    for load in range(2):
        table.write(spark.range(50).selectExpr(f"'http://h/' || (id + {50 * load}) as url_key", "'u' as url"), load)
    found = spark.range(200).selectExpr("'http://h/' || id as link_key", "'http://h/' || id as link")
    fresh = unvisited(found, table.read(spark))
    assert moved_scans(fresh) == (1, 0) and fresh.count() == 100
    assert moved_scans(table.newest(spark)) == (1, 0)


def pages(spark, first, last, mark):
    return spark.range(first, last).selectExpr("id as page_id", "'http://h.example/' || id % 20 as url",
                                               f"'{mark}' || id as html")


def test_page_table(spark, tmp_path, rows, no_broadcast):
    path = str(tmp_path / "pages")
    # Every URL comes several times in a load; the highest page_id stays.
    store_page_table(pages(spark, 0, 60, "old"), path, 0)
    store_page_table(pages(spark, 60, 65, "new"), path, 1)
    stored = read_page_table(spark, path)
    assert stored.count() == 20 and page_table(path).read(spark).count() == 25
    ids = spark.range(30).selectExpr("'http://h.example/' || id as url")
    found = lookup_pages(ids, stored)
    assert moved_scans(found) == (1, 0)
    assert rows(found.where("html is not null"), "html") == sorted(
        [(f"new{60 + i}",) for i in range(5)] + [(f"old{40 + i}",) for i in range(5, 20)])
    assert found.where("html is null").count() == 10
    assert rows(read_page_table(spark, path, only_host="h.example").agg(F.count("*"))) == [(20,)]
    assert rows(read_page_table(spark, path, only_host="other")) == []


def test_empty_page_table(spark, tmp_path):
    path = str(tmp_path / "pages")
    assert read_page_table(spark, path).count() == 0
    store_page_table(pages(spark, 0, 0, "x"), path, 0)
    assert read_page_table(spark, path).count() == 0
