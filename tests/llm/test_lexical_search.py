"""The ranking against scores computed document by document."""

import math
import random
import re

import pytest
from hard_rows import HARD

from ladle.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    bags = [(i, terms(t)) for i, t in docs if terms(t)]
    n_docs, total = len(bags), sum(len(b) for _, b in bags)
    out = []
    for item, text in items:
        asked, scored = terms(text), []
        for i, bag in bags:
            m, score = 25 + 75 * len(bag) * n_docs // total, 0
            for t in asked:
                tf, df = bag.count(t), sum(t in b for _, b in bags)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += w * (10 ** 9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k])]
    return sorted(out, key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "日本", "Zz9", "a_b", "ſ", "İ"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 40)))) for i in range(n)]


@pytest.fixture
def small_segments(monkeypatch):
    """Many segments and short blocks, so that bounds and heaps are at work on little data."""
    monkeypatch.setattr(ls, "SEGMENT_DOCS", 40)
    monkeypatch.setattr(ls, "BLOCK", 4)


@pytest.mark.parametrize("extra", [False, True])
def test_against_brute_force(spark, rows_of, extra, small_segments):
    docs = corpus(1, 300) + HARD + [(None, "w1 w2 w40"), (3, "w1 w2 w40"), (3, "w1 w2 w40")]
    items = [(1, "w1 W2 w40 w40"), (2, None), (3, "..."), (None, "É ſ İ"), (1, "w1 W2 w40 w40"), (4, "unknown"),
             (5, "zz9 a b a_b"), (6, " ".join(f"w{i}" for i in range(60))), (7, "word same line of words")]
    table, asked = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)
    if extra:
        for name in ("docs", "ids", "rank", "score", "asked", "row", "term", "df", "item_id"):
            table = table.selectExpr("*", f"'x' as {name}")
        asked = asked.selectExpr("*", "'x' as doc_id", "'x' as rank", "'x' as asked", "'x' as row")
    assert rows_of(ls.ranked_search(table, asked)) == brute(docs, items)


def test_all_terms_indexed_and_queries_in_blocks(spark, rows_of, small_segments, monkeypatch):
    monkeypatch.setattr(ls, "QUERY_BYTES", 200)
    monkeypatch.setattr(ls, "WANTED_BYTES", 100)
    docs, items = corpus(2, 150), [(i, t) for i, t in corpus(3, 8)]
    got = ls.ranked_search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k=3)
    assert rows_of(got) == brute(docs, items, 3)


def test_empty_tables(spark):
    none, docs = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a"), (2, None)], DOCS)
    assert ls.ranked_search(none, spark.createDataFrame([(1, "a")], ITEMS)).count() == 0
    assert ls.ranked_search(docs, spark.createDataFrame([], ITEMS)).count() == 0
    assert ls.ranked_search(docs, spark.createDataFrame([(1, None)], ITEMS)).columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_skipped():
    """Lists that cannot win alone are looked up by block, and most of their blocks stay compressed."""
    segment = ls._Segment(None)
    for i in range(20_000):
        segment.add(i, b"common " * (1 + i % 3) + (b"rare rare rare" if i % 2000 == 7 else b"other") + b" pad" * (i % 50))
    row = dict(zip(ls.SEGMENTS.names, segment.row()))
    reader = ls._Reader(row, row["docs"], row["length"], {b"common", b"rare"})
    docs, scores = reader.best({b"rare": 5000, b"common": 3}, 10, 3 * 1_000_000)
    blocks = len(reader.blocks)
    assert len(reader.held) < blocks / 10
    whole = ls._Reader(row, row["docs"], row["length"], {b"common", b"rare"})
    all_docs, all_scores = whole.best({b"rare": 5000, b"common": 3}, 10, 0)
    assert len(whole.held) > 100
    top = sorted(zip(all_scores.tolist(), all_docs.tolist()), reverse=True)[:10]
    assert sorted(zip(scores.tolist(), docs.tolist()), reverse=True)[:10] == top


def test_terms_of_a_long_text():
    text = ("Ab1é-" * 700_000).encode()
    runs = list(ls.terms_of(text))
    assert len(runs) > 2 and sum(len(r) for r in runs) == 700_000
    assert {t for r in runs for t in r} == {"ab1é".encode()}
