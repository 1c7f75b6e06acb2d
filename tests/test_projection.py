import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ladle.operators import select as s
from ladle.operators.extract import RECIPE_SITE, extract_fields
from ladle.operators.links import ANCHORS, links
from ladle.operators.markup import Page
from ladle.operators.tree import Wanted, _parse_batches, _project, parse_pages

PAGES = "page_id bigint, url string, html string"
HTML = ('<title>T</title><nav class="top x"><ul><li><a href="/1">one</a></li><li><b><a href="/2">two</a></b></li></ul></nav>'
        '<article><p>a<p>b<div class=x><p>c</div></article><div class="ad x"><img src=i.png><span><img src=j.png></span></div>'
        '<a name=n>none</a>')


def markup():
    tag = st.sampled_from(["a", "b", "p", "div class=x", "div", "li", "ul", "/div", "/a", "/ul", "img src=1", "p class='x y'"])
    return st.lists(st.one_of(tag.map("<{}>".format), st.sampled_from(["t", " "])), max_size=40).map("".join)


@settings(max_examples=300, deadline=None)
@given(markup())
def test_projection_against_the_whole_tree(html):
    """Kept elements stand as in the whole tree: ancestors among them, children of their own parent only."""
    whole, part = Page(html), _project(Page(html), Wanted(("a", "ul"), ("x",)))
    kept = [i for i, t in enumerate(whole.tag) if t in ("a", "ul") or "x" in whole.attrs[i].get("class", "").split()]
    assert part.tag == [whole.tag[i] for i in kept] and part.text_to == [whole.text_to[i] for i in kept]
    for i, node in enumerate(kept):
        assert part.parent[i] == (kept.index(whole.parent[node]) if whole.parent[node] in kept else -1)
        below = [j for j, other in enumerate(kept) if node < other <= whole.post[node]]
        assert list(range(i + 1, part.post[i] + 1)) == below


SELECTORS = {
    "tag": lambda n: s.select(n, s.is_tag("p")),
    "class": lambda n: s.select(n, s.has_class("x")),
    "child": lambda n: s.select(n, s.both(s.is_tag("p"), s.child_of(n, s.is_tag("article")))),
    "chain": lambda n: s.select(n, s.both(s.is_tag("a"), s.child_of(n, s.both(s.is_tag("li"), s.child_of(n, s.is_tag("ul")))))),
    "below": lambda n: s.descendants(n, s.select(n, s.has_class("ad", "top")), s.is_tag("img", "a")),
}


def test_selectors_give_the_same(spark):
    pages = spark.createDataFrame([(1, "u", HTML), (2, "u", ""), (3, "u", None)], PAGES)
    n, text, html = F.col("nodes"), F.col("text"), F.col("html")
    columns = [F.array_join(F.transform(find(n), lambda e: F.concat(s.text_of(text, e), F.lit("|"), s.inner_html(html, e),
                                                                    F.coalesce(e["attrs"]["src"], F.lit("-")))), "\n").alias(name)
               for name, find in SELECTORS.items()]
    wanted = Wanted(("p", "a", "article", "li", "ul", "img"), ("x", "ad", "top"))
    whole, part = (parse_pages(pages, w).select("page_id", *columns).orderBy("page_id").collect() for w in (None, wanted))
    assert whole == part and all(whole[0][name] for name in SELECTORS)


def test_only_anchors_leave_the_parser():
    batch = pa.RecordBatch.from_pydict({"html": [HTML * 20, None, ""]})
    whole, part = (next(_parse_batches(iter([batch]), w)) for w in (None, ANCHORS))
    count = lambda b: len(b.column("nodes").flatten())
    assert (count(whole), count(part)) == (20 * 18, 20 * 3)
    assert set(part.column("nodes").flatten().field("tag").to_pylist()) == {"a"}
    added = lambda b: b.column("nodes").nbytes + b.column("text").nbytes
    assert added(part) < added(whole) / 4
    assert part.column("text").null_count == 3


def test_links_are_numbered_among_anchors(spark, rows):
    pages = spark.createDataFrame([(1, "http://h.example/", HTML)], PAGES)
    assert rows(links(pages), "pre", "link") == [(0, "http://h.example/1"), (1, "http://h.example/2")]


@pytest.mark.parametrize("html", [
    '<title>P | Allrecipes</title><div class="recipe-container"><span class=ingredients-item-name>flour</span>'
    '<ul><li class=instructions-section-item><div class=section-body>Bake.</div><p><b class=section-body>no</b></p></li></ul>'
    '<div class=image-slide><p><noscript><img src=a.png></noscript></p></div><div class=recipe-summary> s </div></div>',
    "<p>nothing</p>", None])
def test_the_site_layout_names_all_it_reads(spark, html):
    pages = spark.createDataFrame([(1, "u", html)], PAGES)
    whole = RECIPE_SITE.__class__(**{**RECIPE_SITE.__dict__, "wanted": None})
    assert extract_fields(pages, RECIPE_SITE).collect() == extract_fields(pages, whole).collect()
