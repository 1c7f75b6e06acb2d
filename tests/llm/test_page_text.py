"""Main text of pages, and templates found by counting."""

import pytest

from ladle.llm import page_text
from ladle.llm.page_text import Outline, page_texts

PAGES = "page_id long, url string, html string"


def texts(spark, rows, **options):
    got = page_texts(spark.createDataFrame(rows, PAGES), **options)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = sorted(got.collect(), key=lambda r: (r["page_id"] is None, r["page_id"] or 0, r["text"]))
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    return [(r["page_id"], r["text"]) for r in out]


def alone(html):
    import numpy as np

    return Outline("http://h/", html).text(np.empty(0, np.int64))


def paragraph(i):
    return " ".join(f"word{i}x{j}" for j in range(30))


@pytest.mark.parametrize("html, text", [
    ("", ""), ("<nav>menu</nav>", ""), ("plain &amp;amp; text", "plain &amp; text"),
    ("<body><header>Site</header><article><header><h1>Title</h1></header><p>One\n two&nbsp;three<br>four</p></article>"
     "<footer>f</footer>", "Title\nOne two three four"),
    ("<article><p>a<script>var x='</p>'</script>b</p><style>p{}</style><form><input><p>mail</p></form><aside><p>x</p></aside>"
     "<!-- note --><p>c<p>d", "ab\nc\nd"),
    ("<body><div id='cookie-notice'><p>We use cookies</p></div><main><p>Main</p><section class='post comments'><h2>Comments</h2>"
     "<article class='comment'><p>First!</p></article></section></main><div class='ad'>Buy</div>", "Main"),
    ("<article><ul><li>a</li><li>b <b>c</b></li></ul><table><tr><td>d</td><td>e</td></tr></table></article>", "a\nb c\nd\ne"),
    ("<body><form id='aspnetForm'><h1>T</h1><p>x</p></form></body>", "T\nx"),
    ("<body class='no-sidebar'><div class='content with-sidebar'><article class='post'><p>x</p></article></div></body>", "x"),
    ("<article><p hidden>no</p><p style='display: none'>no</p><p aria-hidden=true>no</p><p>yes</p></article>", "yes"),
    ("<article>one</article><p>between</p><article>two</article>", "one\ntwo"),
    ("<article></article><main></main><p>left", "left"),
    ("<title>t</title><p>&copy; &#x41;&#66; &lt;b&gt;", "© AB <b>"),
])
def test_one_page(html, text):
    assert alone(html) == text


def test_templates_without_names(spark):
    """Boilerplate that no tag or class names, deleted because many pages of the site share it, and only there."""
    same = "<div><b>Follow us everywhere</b> and win</div>"
    rows = [(i, f"http://a.example/{i}", f"<body>{same}<div><p>{paragraph(i)}</p></div><ul><li>up</li></ul></body>") for i in range(12)]
    rows += [(100 + i, f"https://B.example:80/{i}", f"<body>{same}<div><p>{paragraph(i)}</p></div></body>") for i in range(5)]
    expected = [(i, paragraph(i)) for i in range(12)] + [(100 + i, f"Follow us everywhere and win\n{paragraph(i)}") for i in range(5)]
    assert texts(spark, rows) == [(i, t) for i, t in expected]
    # More templates than may be held: by an exchange, with the same result.
    assert texts(spark, rows, broadcast_bytes=0) == expected


def test_copies_are_no_templates(spark):
    """An article on many pages, each with another menu, stays; so does a sentence that many articles end with."""
    copy = "<div><p>" + paragraph("copy") + "</p><p>second part</p></div>"
    rows = [(i, "http://a.example/", f"<ul><li>menu {i}</li></ul>{copy}") for i in range(40)]
    rows += [(100 + i, "http://a.example/", f"<article><h1>{paragraph(i)}</h1><p>All rights reserved.</p><div>Share this</div></article>")
             for i in range(20)]
    got = dict(texts(spark, rows))
    assert all(paragraph("copy") in got[i] and "second part" in got[i] for i in range(40))
    assert all(got[100 + i] == f"{paragraph(i)}\nAll rights reserved." for i in range(20))


def test_hard_rows(spark):
    deep = "<div>" * 20_000 + "deep" + "</div>" * 20_000
    rows = [(1, None, None), (1, None, None), (None, "x", ""), (2, "not a url", "<p>a</p>"), (2, "not a url", "<p>a</p>"),
            (3, "http://h/", "<article>" + "<p>word " * 50_000), (4, "http://[::1]:8/x", deep), (5, "//h", "\x00<\x1c>&#0;")]
    got = texts(spark, rows)
    assert [i for i, _ in got] == [1, 1, 2, 2, 3, 4, 5, None]
    assert dict(got)[3] == "\n".join(["word"] * 50_000) and dict(got)[4] == "deep" and dict(got)[None] == ""


def test_extra_columns_and_empty_table(spark):
    rows = spark.createDataFrame([(1, "http://h/", "<article>x</article>")], PAGES)
    for name in ("text", "page", "own", "host", "subtree", "main", "n_chars", "n", "of"):
        rows = rows.selectExpr("*", f"'x' as {name}")
    assert [tuple(r) for r in page_texts(rows, broadcast_bytes=0).collect()] == [(1, "http://h/", "x", 1)]
    assert page_texts(spark.createDataFrame([], PAGES)).count() == 0


def test_host():
    assert [page_text.host_of(u) for u in ("HTTP://U:p@Ex.Org:80/a", "//x/y", "x/y", None, "http://[::1]:8/", "http:///a")] == [
        "ex.org", "x", "", "", "[::1]", ""]
