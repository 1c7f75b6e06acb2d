import pytest
from pyspark.sql import functions as F

from ladle.operators import select as s
from ladle.operators.extract import RECIPE_SITE, document_title, extract, lookup_pages, pages_of_range, status_summary
from ladle.operators.links import distinct_links, links, unvisited
from ladle.operators.markup import Page, attribute_text
from ladle.operators.tree import node_rows, parse_pages
from ladle.sources.ids import id_range, sequence_ids
from ladle.sources.pages import read_pages, store_pages

PREFIX = "https://www.site.example/recipe/"
PAGES = "page_id bigint, url string, html string"

NEW = """<html><head><title> Pie | Allrecipes </title></head><body>
<div class="recipe-container big"> <p class="recipe-summary"> Good. </p>
<ul><li><span class="ingredients-item-name"> 2 eggs </span><li><span class="ingredients-item-name">&nbsp;</span></ul>
<div class="instructions-section-item"><div class="section-body">Mix.</div>
<div><div class="section-body">Not a step</div></div></div>
<div class="image-slide"><noscript><p><img src="a.jpg"></p><img><img src=" "></noscript></div><img src="no.jpg">
</div></body></html>"""
OLD = """<title>Old</title><section class="recipe-container-outer"><span class="recipe-ingred_txt">salt</span>
<ol><li class="recipe-directions__list--item">Wait <b>long</b></ol></section>"""
BOTH = """<span class="recipe-ingred_txt ingredients-item-name">one</span><i class="ingredients-item-name">two</i>
<li class="recipe-directions__list--item">go</li>"""
BLANK = '<div class="recipe-container">x<span class="recipe-ingred_txt"> </span></div>'
NO_STEPS = '<div class="recipe-container">x</div><span class="recipe-ingred_txt">a</span>'
MANY_SUFFIX = ("<title>A | Allrecipes | Allrecipes</title><b class=recipe-ingred_txt>x</b>"
               "<b class=recipe-directions__list--item>y</b>")


@pytest.fixture(scope="module")
def results(spark):
    texts = {0: NEW, 1: OLD, 2: BOTH, 3: BLANK, 4: NO_STEPS, 5: MANY_SUFFIX, 7: NEW}
    pages = spark.createDataFrame([(i, PREFIX + str(i), h, 404 if i == 7 else 200) for i, h in texts.items()],
                                  PAGES + ", http_status int")
    out = extract(id_range(spark, 0, 8, PREFIX), pages).cache()
    return {r["recipe_id"]: r for r in out.collect()}, out


def test_status_per_case(results):
    found, _ = results
    assert {i: r["status"] for i, r in found.items()} == {
        0: "success", 1: "success", 2: "success", 3: "parseFailure", 4: "parseFailure", 5: "success",
        6: "networkFailure", 7: "networkFailure"}
    for r in found.values():
        assert (r["status"] == "success") == (r["recipe"] is not None)
        assert r["id"] == r["recipe_id"] + 1 and r["source"] == PREFIX + str(r["recipe_id"])


def test_new_layout(results):
    r = results[0][0]["recipe"]
    assert r["_id"] == "www.site.example-0" and r["title"] == "Pie" and r["summary"] == "Good."
    assert r["ingredient"] == [" 2 eggs "]
    assert r["steps"] == ["Mix."]
    assert r["images"] == ["a.jpg"]
    assert results[0][0]["html"].startswith('<p class="recipe-summary">')


def test_other_layouts(results):
    found, _ = results
    assert found[1]["recipe"]["steps"] == ["Wait long"] and found[1]["recipe"]["summary"] is None
    assert found[2]["recipe"]["ingredient"] == ["one", "two"]
    assert found[2]["html"] is None and found[2]["recipe"]["title"] == ""
    assert found[5]["recipe"]["title"] == "A"
    assert found[3]["html"].startswith("x<span") and found[4]["html"] == "x"
    assert found[6]["html"] is None and found[7]["html"] is None


def test_status_summary(results, rows):
    assert rows(status_summary(results[1])) == [
        ("networkFailure", 2, 0, 0), ("parseFailure", 2, 0, 0), ("success", 4, 5, 4)]


def tags(markup):
    p = Page(markup)
    return [(t, p.parent[i], p.post[i]) for i, t in enumerate(p.tag)], p.text


@pytest.mark.parametrize("markup, nodes, text", [
    ("<p>a<p>b", [("p", -1, 0), ("p", -1, 1)], "ab"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", [("ul", -1, 4), ("li", 0, 3), ("ul", 1, 3), ("li", 2, 3), ("li", 0, 4)], "abc"),
    ('<script>var t="</p>";</script>x', [("script", -1, 0)], 'var t="</p>";x'),
    ("<!-- <p> -->a<!>b<?x>c</>d", [], "abcd"),
    ("<br>a<img src=x>b", [("br", -1, 0), ("img", -1, 1)], "ab"),
    ("a < b &amp; c &lt;d", [], "a < b & c <d"),
    ("<title>a <b>x</b> &amp;</title>", [("title", -1, 0)], "a <b>x</b> &"),
    ("<div>a</span>b</div>c", [("div", -1, 0)], "abc"),
    ("<b><p>x</b>y</p>", [("b", -1, 1), ("p", 0, 1)], "xy"),
    ("<noscript><img></noscript>", [("noscript", -1, 1), ("img", 0, 1)], ""),
    ("<table><tr><td>1<td>2<tr><td>3</table>",
     [("table", -1, 5), ("tr", 0, 3), ("td", 1, 2), ("td", 1, 3), ("tr", 0, 5), ("td", 4, 5)], "123"),
    ("</p>a", [("p", -1, 0)], "a"),
    ("<a href=1>x<a href=2>y</a>", [("a", -1, 0), ("a", -1, 1)], "xy"),
    ('<a title="un', [], ""),
    ("<svg><path/><g>t</g></svg>", [("svg", -1, 2), ("path", 0, 1), ("g", 0, 2)], "t"),
    ("x\r\ny", [], "x\ny"),
])
def test_tree(markup, nodes, text):
    assert tags(markup) == (nodes, text)


def test_attributes():
    p = Page("""<A HREF='x?a=1&copy=2&amp;b' class="b  a b" data-x id=u title>t</A>""")
    assert p.attrs[0] == {"href": "x?a=1&copy=2&b", "class": "b  a b", "data-x": "", "id": "u", "title": ""}
    assert attribute_text("&eacute; &copy &bogus &#65;") == "é © &bogus A"


def test_deep_nesting_is_linear():
    p = Page("<div>" * 50_000 + "x")
    assert len(p.tag) == 50_000 and p.post[0] == 49_999


def test_descendants_meet_each_node_once(spark):
    html = "<div class=a>" * 30 + "<i></i>" + "</div>" * 30 + "<i></i><div class=a><i></i></div>"
    tree = parse_pages(spark.createDataFrame([(1, "u", html)], PAGES))
    n = F.col("nodes")
    found = tree.select(F.size(s.descendants(n, s.select(n, s.has_class("a")), s.is_tag("i"))),
                        F.size(s.descendants(n, s.select(n, s.has_class("zz")), s.is_tag("i")))).first()
    assert tuple(found) == (2, 0)


def test_node_rows_and_title(spark, rows):
    tree = parse_pages(spark.createDataFrame([(1, "u", "<title> a\n b </title><p>x<b>y</b></p>")], PAGES))
    assert rows(node_rows(tree), "pre", "tag", "node_text") == [(0, "title", " a\n b "), (1, "p", "xy"), (2, "b", "y")]
    assert tree.select(document_title(F.col("text"), F.col("nodes"))).first()[0] == "a b"


def test_links(spark, rows):
    html = ('<a href="/x">1</a><a>none</a><a href="/x#f">2</a><a href="mailto:m@x">3</a><a href="">4</a>'
            '<area href="/no">')
    pages = spark.createDataFrame([(1, "http://H.example/p?q", html)], PAGES)
    found = links(pages)
    assert rows(found, "link_key") == [("http://h.example/p?q",), ("http://h.example/x",), ("http://h.example/x",),
                                       ("mailto:m@x",)]
    first = {r["link_key"]: r["link"] for r in distinct_links(found).collect()}
    assert first["http://h.example/x"] == "http://H.example/x" and len(first) == 3
    visited = spark.createDataFrame([("http://h.example/x",)], "url_key string")
    assert rows(unvisited(found, visited), "url_key") == [("http://h.example/p?q",), ("mailto:m@x",)]


def test_lookup_takes_newest_copy_and_keeps_missing(spark, rows):
    pages = spark.createDataFrame(
        [(i, "http://a/x", f"v{i}") for i in range(50)] + [(99, "http://b/y", "other")], PAGES)
    keys = spark.createDataFrame([("http://A/x#f",), ("http://c/",)], "url string")
    assert rows(lookup_pages(keys, pages), "url", "html") == [("http://A/x#f", "v49"), ("http://c/", None)]


def test_id_range_guard(spark):
    assert id_range(spark, 5, 5, PREFIX).count() == 0
    assert id_range(spark, 9, 3, PREFIX).count() == 0


def test_sequence_ids(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).repartition(5)
    got = sequence_ids(df, ["v"], start=10).orderBy("id").collect()
    assert [(r["id"], r["v"]) for r in got] == [(i + 11, i) for i in range(1000)]


def test_store_pages(spark, tmp_path, rows):
    pages = spark.createDataFrame([(1, "http://A.example/p?q", "x"), (2, "http://b.example", "y")], PAGES)
    store_pages(pages, str(tmp_path / "p"))
    assert rows(read_pages(spark, str(tmp_path / "p")), "page_id", "host", "store_key") == [
        (1, "a.example", "http://a.example/p?q//p"), (2, "b.example", "http://b.example///")]
    assert rows(read_pages(spark, str(tmp_path / "p"), only_host="b.example"), "page_id") == [(2,)]


@pytest.mark.parametrize("spans", [[], [(0, 500), (1, 9), (501, 501), (502, 900)],
                                   [(i, i) for i in range(300)], [(0, 999)] + [(i, i) for i in range(1, 200)],
                                   [(i, i + 5 if i % 10 == 0 else i) for i in range(400)]])
def test_outermost_intervals(spark, spans):
    found = spark.createDataFrame([(spans,)], "found array<struct<pre:int,post:int>>")
    kept, reach = [], -1
    for pre, post in spans:
        if pre > reach:
            kept.append((pre, post))
            reach = post
    assert [tuple(x) for x in found.select(s.outermost(F.col("found"))).first()[0]] == kept


def test_stored_pages_are_pruned_by_key(spark, tmp_path, capsys, rows):
    pages = spark.createDataFrame([(i, f"http://h{i}.example/p", f"v{i}") for i in range(60)], PAGES)
    store_pages(pages, str(tmp_path / "p"))
    stored = read_pages(spark, str(tmp_path / "p"))
    keys = spark.createDataFrame([("http://H7.example/p#f",), ("http://none.example/",)], "url string")
    found = lookup_pages(keys, stored)
    assert rows(found, "url", "html") == [("http://H7.example/p#f", "v7"), ("http://none.example/", None)]
    found.explain("formatted")
    plan = capsys.readouterr().out
    assert "host_bucket#" in plan.split("PartitionFilters")[1].split("\n")[0]
    pages_of_range(stored, 1, 5, "http://h1.example/").explain("formatted")
    assert "StringStartsWith(url_key,http://h1.example/)" in capsys.readouterr().out
