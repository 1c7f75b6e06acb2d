"""Pages -> trees: one row per page with its elements as an array in document order.

An element is an interval (`pre` = array position, `post` = last position of its subtree)
and a range of the page's text, so every selector in `ladle.operators.select` is an
expression on the row. A page is parsed once and never leaves its partition.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.operators.markup import Page
from ladle.schemas import NODE
from ladle.session import ship_package

# Input characters per output batch: bounds what a Python worker holds at once.
_FLUSH_CHARS = 4_000_000


@dataclass(frozen=True)
class Wanted:
    """The elements that a query's selectors name, by tag or by class; no others leave the parser.

    What stays is numbered anew. An element is the child of its own parent only: where that one was not asked for,
    no selector can name it, and `parent` is -1. So selectors give what they give on the whole tree, as long as
    every tag and class in them is listed. `attrs` are the attributes kept beside (all by default); `class` always
    reaches `classes`. Without `text` the page text is null and text ranges mean nothing.
    """

    tags: tuple[str, ...] = ()
    classes: tuple[str, ...] = ()
    attrs: tuple[str, ...] | None = None
    text: bool = True

    def with_tags(self, *tags: str) -> Wanted:
        return Wanted((*self.tags, *tags), self.classes, self.attrs, self.text)


def _project(page: Page, wanted: Wanted) -> Page:
    """Leave the wanted elements of `page`, in time linear in the page but for one search per kept element."""
    tags, classes = frozenset(wanted.tags), frozenset(wanted.classes)
    kept = [i for i, tag in enumerate(page.tag)
            if tag in tags or classes and not classes.isdisjoint(page.attrs[i].get("class", "").split())]
    place = {node: i for i, node in enumerate(kept)}
    page.parent = [place.get(page.parent[i], -1) for i in kept]
    page.post = [bisect_right(kept, page.post[i]) - 1 for i in kept]
    for name in ("tag", "attrs", "text_from", "text_to", "inner_from", "inner_to"):
        values = getattr(page, name)
        setattr(page, name, [values[i] for i in kept])
    return page


def _arrow_type(dt: T.DataType) -> pa.DataType:
    if isinstance(dt, T.ArrayType):
        return pa.list_(_arrow_type(dt.elementType))
    if isinstance(dt, T.MapType):
        return pa.map_(_arrow_type(dt.keyType), _arrow_type(dt.valueType))
    return {T.IntegerType: pa.int32(), T.StringType: pa.string()}[type(dt)]


def _ints(values: Iterable[int]) -> pa.Array:
    return pa.array(values, pa.int32())


def _offsets(lengths: Iterable[int]) -> pa.Array:
    total, out = 0, [0]
    for n in lengths:
        total += n
        out.append(total)
    return _ints(out)


def _node_array(pages: list[Page], named: tuple[str, ...] | None = None) -> pa.ListArray:
    flat = lambda name: [x for p in pages for x in getattr(p, name)]
    attrs = flat("attrs")
    classes = [list(dict.fromkeys(a["class"].split())) if a.get("class") else [] for a in attrs]
    if named is not None:
        attrs = [{k: a[k] for k in named if k in a} for a in attrs]
    columns = {
        "pre": _ints([i for p in pages for i in range(len(p.tag))]),
        "post": _ints(flat("post")),
        "parent": _ints(flat("parent")),
        "tag": pa.array(flat("tag"), pa.string()),
        "classes": pa.ListArray.from_arrays(
            _offsets(map(len, classes)), pa.array([c for cs in classes for c in cs], pa.string())),
        "attrs": pa.MapArray.from_arrays(
            _offsets(map(len, attrs)),
            pa.array([k for a in attrs for k in a], pa.string()),
            pa.array([v for a in attrs for v in a.values()], pa.string())),
        "text_from": _ints(flat("text_from")),
        "text_to": _ints(flat("text_to")),
        "inner_from": _ints(flat("inner_from")),
        "inner_to": _ints(flat("inner_to")),
    }
    fields = [pa.field(f.name, _arrow_type(f.dataType)) for f in NODE.fields]
    nodes = pa.StructArray.from_arrays([columns[f.name] for f in fields], fields=fields)
    return pa.ListArray.from_arrays(_offsets(len(p.tag) for p in pages), nodes)


def _parse_batches(batches: Iterator[pa.RecordBatch], wanted: Wanted | None = None) -> Iterator[pa.RecordBatch]:
    named = wanted.attrs if wanted else None
    for batch in batches:
        at = batch.schema.get_field_index("html")
        start = 0
        pages: list[Page] = []
        chars = 0
        for i in range(batch.num_rows):
            markup = batch.column(at)[i].as_py() or ""
            page = Page(markup)
            pages.append(_project(page, wanted) if wanted else page)
            chars += len(markup)
            if chars >= _FLUSH_CHARS or i == batch.num_rows - 1:
                part = batch.slice(start, len(pages))
                texts = [p.text if wanted is None or wanted.text else None for p in pages]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string()), _node_array(pages, named)],
                    names=[*part.schema.names, "text", "nodes"])
                start, pages, chars = i + 1, [], 0


def parse_pages(pages: DataFrame, wanted: Wanted | None = None) -> DataFrame:
    """Add `text` and `nodes` to every page; all other columns are kept. `wanted` names the elements asked for."""
    ship_package(pages.sparkSession)
    schema = T.StructType([*pages.schema.fields,
                           T.StructField("text", T.StringType()),
                           T.StructField("nodes", T.ArrayType(NODE))])
    return pages.mapInArrow(partial(_parse_batches, wanted=wanted), schema)


def node_rows(trees: DataFrame, nodes: Column | None = None, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Relational view: one row per element (or per element of `nodes`), its text included."""
    found = F.col("nodes") if nodes is None else nodes
    return (trees.select(*keep, "text", F.explode(found).alias("n"))
                 .select(*keep, "n.pre", "n.post", "n.parent", "n.tag", "n.classes", "n.attrs",
                         F.substr("text", F.col("n.text_from") + 1,
                                  F.col("n.text_to") - F.col("n.text_from")).alias("node_text")))
