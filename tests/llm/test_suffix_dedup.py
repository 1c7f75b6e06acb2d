"""Against a brute-force version: every string of 100 bytes and where it occurs first."""

import hashlib
import random

import numpy as np
import pytest

from ladle.llm import suffix_dedup as s
from hard_rows import HARD


def brute(rows):
    def place(i, start):
        return i is not None, i or 0, start
    first, out = {}, []
    for i, t in rows:
        raw = (t or "").encode()
        for at in range(len(raw) - 99):
            key = raw[at:at + 100]
            first[key] = min(first.get(key, place(i, at)), place(i, at))
    for i, t in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw) + 1)
        for at in range(len(raw) - 99):
            if first[raw[at:at + 100]] < place(i, at):
                gone[at:at + 100] = b"\1" * 100
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(gone[j] > gone[j - 1] for j in range(len(raw)))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdé ") for _ in range(rnd.randint(2, 9))) for _ in range(200)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passages = [prose(rnd.randint(10, 60)) for _ in range(8)]
    rows = []
    for i in range(60):
        text = ""
        for _ in range(rnd.randint(0, 5)):
            kind = rnd.random()
            if kind < 0.4:
                p = rnd.choice(passages)
                a = rnd.randint(0, len(p) // 2)
                text += p[a:rnd.randint(a, len(p))]
            else:
                text += rnd.choice("ab") * rnd.randint(1, 300) if kind < 0.55 else prose(rnd.randint(1, 50))
        rows.append((i * 3 - 50, text))
    return rows + [(1000 + i, rows[7][1]) for i in range(15)]


@pytest.mark.parametrize("block", [1 << 20, 700])
def test_against_brute_force(table, rows_of, monkeypatch, block):
    monkeypatch.setattr(s, "BLOCK", block)
    rows = corpus(block) + [(i, t) for i, t in HARD if i != 6]
    assert rows_of(s.suffix_dedup(table(rows, extra=True))) == brute(rows)


def test_one_passage_in_every_document_spans_buckets(table, rows_of, spark):
    rnd = random.Random(3)
    line = "".join(rnd.choice("abcdefgh ") for _ in range(150))
    rows = [(i, f"{rnd.random()} {line} {rnd.random()}" * (1 + i % 2)) for i in range(150)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert rows_of(s.suffix_dedup(table(rows))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_empty_table(table):
    assert s.suffix_dedup(table([])).collect() == []


def test_multikey_sort_orders_by_all_tokens():
    rnd = np.random.default_rng(1)
    columns = [rnd.integers(0, 3, 500) for _ in range(4)]
    order, run = s.multikey_sort([lambda rows, c=c: c[rows] for c in columns], 500)
    want = sorted(zip(*(c.tolist() for c in columns)))
    got = list(zip(*(c[order].tolist() for c in columns)))
    assert got == want
    assert run.tolist() == [sorted(set(want)).index(w) for w in want]


def test_rows_that_share_an_id_are_told_apart(table, rows_of):
    """One of many rows of an id holds a passage of another document; the others hold something else in its place."""
    rnd = random.Random(12)
    letters = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = letters(203)
    rows = [(1, letters(40) + passage + letters(60))]
    rows += [(i, letters(140) + (passage if j == 7 else letters(203)) + letters(140)) for i in (2, None) for j in range(2500)]
    rows += [(None, rows[3000][1])] * 20 + [(2, rows[8][1])] * 3
    assert rows_of(s.suffix_dedup(table(rows))) == brute(rows)
