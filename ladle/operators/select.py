"""Selectors over a page's `nodes` array, as Column expressions.

`select(nodes, pred)` keeps document order and meets each node once, so a selector union is
an OR of predicates. Nothing here shuffles: elements never leave their page's row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.functions.binding import let

Predicate = Callable[[Column], Column]


def has_class(*names: str) -> Predicate:
    if len(names) == 1:
        return lambda n: F.array_contains(n["classes"], names[0])
    wanted = F.array(*[F.lit(x) for x in names])
    return lambda n: F.arrays_overlap(n["classes"], wanted)


def is_tag(*names: str) -> Predicate:
    return lambda n: n["tag"].isin(*names)


def has_attr(name: str) -> Predicate:
    return lambda n: F.map_contains_key(n["attrs"], name)


def both(*preds: Predicate) -> Predicate:
    def test(n: Column) -> Column:
        out = preds[0](n)
        for p in preds[1:]:
            out = out & p(n)
        return out
    return test


def either(*preds: Predicate) -> Predicate:
    def test(n: Column) -> Column:
        out = preds[0](n)
        for p in preds[1:]:
            out = out | p(n)
        return out
    return test


def child_of(nodes: Column, parent: Predicate) -> Predicate:
    """Direct child: the parent is looked up by its array position, an equi-join in place."""
    return lambda n: (n["parent"] >= 0) & parent(F.get(nodes, F.greatest(n["parent"], F.lit(0))))


def select(nodes: Column, pred: Predicate) -> Column:
    return F.filter(nodes, pred)


# A fold copies the array it grows at every step, so it is kept to so many elements.
_FOLD = 64


def outermost(found: Column) -> Column:
    """Intervals of `found` that lie in no other: disjoint, in document order.

    Folded in slices, each from the furthest reach of the slices before it: linear in the
    elements, but for one small fold over the slices.
    """
    kept = "array<struct<pre:int,post:int>>"

    def fold(part: Column, reach: Column) -> Column:
        def step(acc: Column, n: Column) -> Column:
            grown = F.struct(n["post"].alias("reach"),
                             F.concat(acc["kept"], F.array(F.struct(n["pre"].alias("pre"),
                                                                    n["post"].alias("post")))).alias("kept"))
            return F.when(n["pre"] <= acc["reach"], acc).otherwise(grown)
        start = F.struct(reach.alias("reach"), F.array().cast(kept).alias("kept"))
        return F.aggregate(part, start, step, lambda acc: acc["kept"])

    def reaches(parts: Column) -> Column:
        """The furthest `post` before each slice."""
        furthest = F.transform(parts, lambda p: F.array_max(F.transform(p, lambda n: n["post"])))
        return F.aggregate(furthest, F.array(F.lit(-1)), lambda acc, m: F.concat(
            acc, F.array(F.greatest(m, F.element_at(acc, -1)))))

    slices = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(found) - 1, F.lit(0)) / _FOLD).cast("int")),
                         lambda i: F.slice(found, i * _FOLD + 1, F.lit(_FOLD)))
    return let(slices, lambda parts: let(reaches(parts), lambda before: F.flatten(F.transform(
        parts, lambda p, i: fold(p, F.get(before, i))))))


def descendants(nodes: Column, ancestors: Column, pred: Predicate) -> Column:
    """Nodes below any of `ancestors` that satisfy `pred`.

    Subtrees are array slices; taking only the outermost ancestors makes the slices
    disjoint, so the cost is the size of the page and no pair of nodes is formed.
    """
    return F.flatten(F.transform(
        outermost(ancestors),
        lambda a: F.filter(F.slice(nodes, a["pre"] + 2, a["post"] - a["pre"]), pred)))


def text_of(text: Column, node: Column) -> Column:
    """All text below the node, in order: a range of the page text."""
    return F.substr(text, node["text_from"] + 1, node["text_to"] - node["text_from"])


def texts(text: Column, found: Column) -> Column:
    return F.transform(found, lambda n: text_of(text, n))


def attr_values(found: Column, name: str) -> Column:
    """Attribute per node, null where absent."""
    return F.transform(found, lambda n: n["attrs"][name])


def inner_html(html: Column, node: Column) -> Column:
    return F.substr(html, node["inner_from"] + 1, node["inner_to"] - node["inner_from"])


def of_first(found: Column, value: Callable[[Column], Column]) -> Column:
    """`value` of the first match in document order, null when there is none."""
    return F.get(F.transform(F.slice(found, 1, 1), value), F.lit(0))
