"""Main text of web pages: the templates of a site are found by counting its element subtrees, and deleted.

Every page is parsed to its elements; a subtree is hashed by its host, its tags and its text, from the leaves up. Spark
counts per host the subtrees that stand on pages whose paragraphs and headings differ: copies of one article, however
many, are one such page, so what they share is not taken for a template. A subtree on `least` of them or more, and on
the share `share` of its host's, is a template, and is deleted wherever it stands on that host. The rest is read in
page order.

On hosts with too few pages to count, the markup itself tells: elements for navigation, forms, scripts and the like, and
elements whose class, id or role names an advert, a notice, a sidebar, a comment section, unless they hold the article
or the page's first heading. Where a page declares its article (else its main part), only that is read; in it,
subtrees that hold paragraphs or headings are the author's and no templates, however often they recur. A subtree with
over half of the page's text is never a template.

A block is the text between two boundaries of block elements. White space in it (Unicode's) becomes one space; `br` is
white space. Character references are decoded once.

Defined results: a null or empty page, and one that is all template, has the text ''. Every row gives one row, also
where ids or URLs repeat or are null; pages without a host count as those of one host. An empty table gives no rows.
Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ladle.llm.mapping import chunks
from ladle.operators.markup import HEADINGS, Page
from ladle.operators.sizing import BROADCAST_BYTES
from ladle.session import settle, ship_package

#: A template stands on at least so many pages of its host that differ in what they say, and on that share of them.
MANY_PAGES, MANY_SHARE = 8, 0.005
#: Pages handed to the parser at once, in bytes.
CHUNK = 4 << 20


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Categories of the HTML standard.
BLOCK = _words(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul")
INVISIBLE = _words("script style title template noscript iframe object svg math canvas audio video map")
NEVER_ARTICLE = _words("nav header footer aside form menu button select textarea input dialog search datalist")
PROSE = _words("p blockquote pre") | HEADINGS
# Words in class, id and role that name what is no article.
BOILERPLATE = _words(
    "ad ads advert advertisement adverts sponsor sponsored promo promotion banner breadcrumb breadcrumbs menu navbar nav "
    "navigation sidebar comment comments disqus reply replies respond cookie cookies consent notice gdpr popup modal overlay "
    "newsletter subscribe signup share sharing social related recommended header footer masthead pagination pager skip "
    "toolbar contentinfo complementary alertdialog dialog search widget")
_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HOST = re.compile(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:\s]*)")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)

SUBTREES = StructType([StructField(c, LongType()) for c in ("host", "subtree", "main", "page")])
TEXTS = StructType([StructField("page_id", LongType()), StructField("url", StringType()), StructField("text", StringType()),
                    StructField("n_chars", LongType())])

Range = tuple[int, int]


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found.group(1).lower() if found else ""


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def _minus(ranges: list[Range], cut: list[Range]) -> Iterator[Range]:
    """`ranges` without `cut`; both are disjoint and in order."""
    ends = [z for _, z in cut]
    for a, z in ranges:
        i = bisect_right(ends, a)
        while i < len(cut) and cut[i][0] < z:
            if cut[i][0] > a:
                yield a, cut[i][0]
            a, i = max(a, cut[i][1]), i + 1
        if a < z:
            yield a, z


class Outline:
    """A parsed page: its elements as ranges of its text, and where its article stands."""

    def __init__(self, url: str | None, html: str):
        self.host = host_of(url)
        self.page = page = Page(html)
        self.size = len(page.tag)
        named = [self._named(i) for i in range(self.size)]
        articles = [t == "article" and not named[i] for i, t in enumerate(page.tag)]
        mains = [t == "main" or page.attrs[i].get("role", "").lower() == "main" for i, t in enumerate(page.tag)]
        core = self._running(articles[i] or mains[i] or t == "h1" for i, t in enumerate(page.tag))
        sections = self._ranges(i for i in range(self.size) if articles[i] or mains[i])
        #: Elements that are no part of an article, by their markup.
        self.barred = [self._barred(i, named[i], core, sections) for i in range(self.size)]
        barred = self._ranges(i for i in range(self.size) if self.barred[i])
        visible = list(_minus([(0, len(page.text))], self._ranges(i for i, t in enumerate(page.tag) if t in INVISIBLE)))
        self._starts = [a for a, _ in visible]
        self._visible = visible
        self._before = [0]
        for a, z in visible:
            self._before.append(self._before[-1] + z - a)
        #: Where the main text stands: the articles, else the declared main part, else anywhere.
        self.roots, self.declared = [(0, len(page.text))], False
        for kind in (articles, mains):
            found = [r for r in self._ranges(i for i in range(self.size) if kind[i]) if not self._within(r, barred)]
            if found:
                self.roots, self.declared = found, True
                break
        prose = self._ranges(i for i, t in enumerate(page.tag) if t in PROSE)
        said = [self._spoken(*r) for r in prose if self._within(r, self.roots)] or [self._spoken(*r) for r in self.roots]
        self.main = _hash("main", *said)

    def _named(self, i: int) -> bool:
        """True if class, id or role name something that is no article."""
        attrs = self.page.attrs[i]
        names = " ".join(attrs[a] for a in ("class", "id", "role") if a in attrs)
        return bool(names) and any(w.lower() in BOILERPLATE for w in _NAMES.findall(names))

    def _barred(self, i: int, named: bool, core: list[int], sections: list[Range]) -> bool:
        tag, attrs = self.page.tag[i], self.page.attrs[i]
        if tag in INVISIBLE or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(attrs.get("style", "")):
            return True
        if tag in ("html", "body", "main") or not (named or tag in NEVER_ARTICLE):
            return False
        if tag == "header" and not named and self._within((self.page.text_from[i], self.page.text_to[i]), sections):
            return False  # the heading of the article itself
        return tag == "article" or core[self.page.post[i] + 1] == core[i + 1]

    def _running(self, flags: Iterable[bool]) -> list[int]:
        out = [0]
        for flag in flags:
            out.append(out[-1] + flag)
        return out

    def _ranges(self, nodes: Iterable[int]) -> list[Range]:
        """Text ranges of the outermost of some elements, which come in document order."""
        out: list[Range] = []
        for i in nodes:
            a, z = self.page.text_from[i], self.page.text_to[i]
            if z > a and (not out or a >= out[-1][1]):
                out.append((a, z))
        return out

    @staticmethod
    def _within(r: Range, ranges: list[Range]) -> bool:
        i = bisect_right(ranges, (r[0], float("inf"))) - 1
        return i >= 0 and r[1] <= ranges[i][1]

    def _visible_to(self, p: int) -> int:
        """Visible characters before a place."""
        i = bisect_right(self._starts, p) - 1
        return 0 if i < 0 else self._before[i] + min(p, self._visible[i][1]) - self._starts[i]

    def _spoken(self, a: int, z: int) -> str:
        return " ".join(self.page.text[a:z].split())

    def _digests(self) -> list[int]:
        """Hash of every element by tag, own text and children, the invisible ones left out; 0 if it says nothing."""
        page, children = self.page, [[] for _ in range(self.size)]
        out = [0] * self.size
        for i in range(self.size - 1, -1, -1):
            if page.parent[i] >= 0:
                children[page.parent[i]].append(i)
            if page.tag[i] in INVISIBLE:
                continue
            parts, at, says = [page.tag[i]], page.text_from[i], False
            for c in reversed(children[i]):
                own = self._spoken(at, page.text_from[c])
                says = says or bool(own) or out[c] != 0
                parts += (own, str(out[c]))
                at = page.text_to[c]
            own = self._spoken(at, page.text_to[i])
            if says or own:
                out[i] = _hash(*parts, own)
        return out

    def subtrees(self) -> dict[int, int]:
        """Hashes of the elements that may be a template, by element."""
        page, out = self.page, {}
        total, prose = self._visible_to(len(page.text)), self._running(t in PROSE for t in page.tag)
        digests = self._digests()
        for i, tag in enumerate(page.tag):
            a, z = page.text_from[i], page.text_to[i]
            if tag not in BLOCK or not digests[i] or 2 * (self._visible_to(z) - self._visible_to(a)) > total:
                continue
            if self.declared and prose[page.post[i] + 1] > prose[i] and self._within((a, z), self.roots):
                continue
            out[i] = _hash(self.host, str(digests[i]))
        return out

    def text(self, templates: np.ndarray) -> str:
        """Main text without the elements whose hash is in `templates` (sorted) and without those the markup bars."""
        page, hashes = self.page, self.subtrees()
        deleted = set()
        if hashes and len(templates):
            asked = np.fromiter(hashes.values(), np.int64, len(hashes))
            near = np.minimum(np.searchsorted(templates, asked), len(templates) - 1)
            deleted = {i for i, yes in zip(hashes, (templates[near] == asked).tolist()) if yes}
        cut = self._ranges(i for i in range(self.size) if i in deleted or self.barred[i])
        # Places where a block begins or ends (1), and where only a `br` stands (0).
        marks = {page.text_from[i]: 0 for i, t in enumerate(page.tag) if t == "br"}
        for i, t in enumerate(page.tag):
            if t in BLOCK:
                marks[page.text_from[i]] = marks[page.text_to[i]] = 1
        places = sorted(marks)
        blocks, held, at = [], [], 0

        def pass_marks(upto: int) -> None:
            nonlocal at
            while at < len(places) and places[at] <= upto:
                if marks[places[at]]:
                    if words := " ".join("".join(held).split()):
                        blocks.append(words)
                    held.clear()
                else:
                    held.append(" ")
                at += 1

        for a, z in _minus(self.roots, cut):
            pass_marks(a)
            while at < len(places) and places[at] < z:
                held.append(page.text[a:places[at]])
                a = places[at]
                pass_marks(a)
            held.append(page.text[a:z])
        pass_marks(len(page.text))
        if words := " ".join("".join(held).split()):
            blocks.append(words)
        return "\n".join(blocks)


def _keyed(pages: DataFrame) -> DataFrame:
    """The columns in use, and a hash of what the text depends on."""
    url, html = F.col("`url`").cast("string"), F.col("`html`").cast("string")
    return pages.select(F.col("`page_id`").cast("long").alias("page_id"), url.alias("url"), html.alias("html"),
                        F.xxhash64(url, html).alias("page"))


def subtree_rows(pages: DataFrame) -> DataFrame:
    """(host, subtree, main, page) as hashes: the subtrees of each page that may be templates, and the page itself as
    the subtree 0."""
    ship_package(pages.sparkSession)
    arrow = to_arrow_schema(SUBTREES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 2, CHUNK):
                rows: list[tuple[int, int, int, int]] = []
                for url, html, page in zip(*(part.column(i).to_pylist() for i in (1, 2, 3))):
                    outline = Outline(url, html or "")
                    host = _hash("host", outline.host)
                    rows += ((host, s, outline.main, page) for s in {0, *outline.subtrees().values()})
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=arrow)

    return _keyed(pages).mapInArrow(run, SUBTREES)


def site_templates(rows: DataFrame, least: int = MANY_PAGES, share: float = MANY_SHARE) -> DataFrame:
    """(host, subtree): subtrees that recur on many pages of their host."""
    # The main part is among the keys of the first grouping, so a host, however large, is spread over all tasks; the
    # second grouping counts on the map side first.
    # Settled, because it is read twice and the pages behind it should be parsed once.
    counts = settle(rows.select("host", "subtree", "main").distinct().groupBy("host", "subtree")
                    .agg(F.count("*").alias("n")).where((F.col("n") >= least) | (F.col("subtree") == 0)), "subtrees")
    hosts = counts.where("subtree = 0").select("host", F.col("n").alias("of"))
    return (counts.where("subtree <> 0").join(hosts, "host").where(F.col("n") >= share * F.col("of"))
            .select("host", "subtree"))


def page_texts(pages: DataFrame, least: int = MANY_PAGES, share: float = MANY_SHARE,
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages` (page_id, url, html)."""
    rows = subtree_rows(pages)
    found = settle(site_templates(rows, least, share), "templates")
    arrow = to_arrow_schema(TEXTS)
    held = None
    if 8 * found.count() <= broadcast_bytes:  # eight bytes a template: the size is known from the count
        held = pages.sparkSession.sparkContext.broadcast(
            np.sort(found.select("subtree").toPandas()["subtree"].to_numpy(dtype=np.int64)))
        read = _keyed(pages).withColumn("own", F.lit(None).cast("array<bigint>"))
    else:
        # Too many to hold: each page is given its own, by an exchange on the page's hash.
        own = rows.join(found, ["host", "subtree"]).groupBy("page").agg(F.collect_set("subtree").alias("own"))
        read = _keyed(pages).join(own, "page", "left")
    read = read.select("page_id", "url", "html", "own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 2, CHUNK):
                texts = [Outline(url, html or "").text(np.sort(np.array(own or [], np.int64)) if held is None else held.value)
                         for url, html, own in zip(*(part.column(i).to_pylist() for i in (1, 2, 3)))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], schema=arrow)

    return read.mapInArrow(run, TEXTS)
