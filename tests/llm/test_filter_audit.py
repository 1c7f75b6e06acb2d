"""The audit against a walk through every order, document by document."""

from itertools import permutations

import pytest
from hard_rows import HARD

from ladle.llm import filter_audit
from ladle.llm.filter_audit import filter_audit as audit

LABELS = "doc_id long, quality int, toxic int"
LONG = " ".join(f"w{i}" for i in range(250))


def fails(text, first):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": not first}


def brute(rows, labels):
    """rows of (doc_id, text, part); one walk per order."""
    known = {}
    for i, quality, toxic in labels:
        good, bad = known.get(i, (0, 0))
        known[i] = (max(good, int(quality == 1)), max(bad, int(toxic == 1)))
    seen = []
    for i, t, p in rows:
        smaller = i is not None and any(j is not None and j < i and (u or "") == (t or "") for j, u, _ in rows)
        seen.append((p or "", fails(t or "", not smaller), known.get(i, (0, 0)) if i is not None else (0, 0)))
    out, shapley = [], {}
    for part in {p for p, _, _ in seen}:
        mine = [s for s in seen if s[0] == part]
        for order in permutations("ABCDE"):
            alive = list(mine)
            for step, f in enumerate(order):
                lost = [s for s in alive if s[1][f]]
                alive = [s for s in alive if not s[1][f]]
                failing = sum(s[1][f] for s in mine)
                alone = sum(s[1][f] and sum(s[1].values()) == 1 for s in mine)
                shapley[part, f] = shapley.get((part, f), 0) + len(lost)
                out.append([part, "".join(order), step + 1, len(alive), len(lost), failing - len(lost), alone,
                            sum(s[2][0] for s in lost), sum(s[2][1] for s in lost), f])
    return sorted((tuple(r[:-1]) + (shapley[r[0], r[-1]],) for r in out), key=repr)


ROWS = ([(i, t, "hard") for i, t in HARD]
        + [(100 + i, LONG + (" $" if i % 2 else "") + (" ABC" * 100 if i % 3 == 0 else ""), f"p{i % 2}") for i in range(12)]
        + [(200, "same " * 300, None), (201, "same " * 300, ""), (199, "same " * 300, "p0"), (199, "same " * 300, "p0"),
           (None, LONG, "p1"), (90, LONG, "p1"), (300, "\x0b".join("abcdefghij") + "\x1c x", "p1"), (301, "É" * 50, "p1")])
TRUTH = [(100, 1, 0), (101, 0, 1), (101, 1, 0), (102, 1, 1), (199, 1, 0), (200, None, 1), (2, 0, 1), (None, 1, 1), (77, 1, 1), (5, 1, 1)]


@pytest.mark.parametrize("extra", [False, True])
def test_against_walks(spark, rows_of, extra):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    if extra:
        for name in ("id", "part", "body", "digest", "bits", "first", "good", "toxic", "cell", "cells", "quality"):
            docs = docs.selectExpr("*", f"'x' as {name}")
    got = audit(docs, spark.createDataFrame(TRUTH, LABELS))
    assert got.columns == filter_audit.SCHEMA.names
    assert rows_of(got) == brute(ROWS, TRUTH)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    none = spark.createDataFrame([], LABELS)
    assert audit(docs, none).count() == 0
    assert audit(spark.createDataFrame([(1, None, None)], docs.schema), none).count() == 600


def test_many_copies_of_one_text(spark):
    """A third of all rows are one text: one row of it is the first, wherever the others lie."""
    rows = [(i, LONG if i % 3 else f"{LONG} {i}", f"p{i % 5}") for i in range(3000)]
    got = audit(spark.createDataFrame(rows, "doc_id long, text string, source string"), spark.createDataFrame([], LABELS))
    last = got.where("filter_order = 'ABCDE' and step = 5").groupBy().sum("kept", "removed").first()
    assert tuple(last) == (1001, 1999)
