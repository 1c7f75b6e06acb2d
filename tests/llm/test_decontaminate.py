import random

import numpy as np

from ladle.llm import decontaminate as d
from hard_rows import HARD


def prose(rnd, n):
    return [f"{rnd.choice('abcdefg')}{rnd.randint(0, 999)}" for _ in range(n)]


def test_planted_passages(table, spark):
    rnd = random.Random(4)
    items = [prose(rnd, n) for n in (8, 15, 40, 60)] + [prose(rnd, 5), prose(rnd, 3)]
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(90, None), (None, "")],
                                      "item_id long, text string")
    rows, want = [], {}

    def plant(i, words, item):
        rows.append((i, " ".join(prose(rnd, 50) + words + prose(rnd, 50))))
        want[i] = item is not None
    plant(1, items[0], 0)
    plant(2, [w.upper() + "," for w in items[1]], 1)
    substituted = list(items[2])
    substituted[5::9] = ["other"] * len(substituted[5::9])
    plant(3, substituted, 2)
    plant(4, items[3][20:40], 3)
    plant(5, items[3][20:28], None)  # half an overlap
    plant(6, items[4], 4)  # a short item, as it is
    plant(9, items[4][:2] + ["other"] + items[4][3:], None)
    plant(10, items[5], None)  # an item that is too short to tell
    plant(7, [], None)
    half = list(items[2])
    half[::2] = ["other"] * len(half[::2])
    plant(8, half, None)
    rows += [(i, t) for i, t in HARD if i not in want] + [(None, " ".join(items[3]))]
    docs = table(rows, extra=True)
    got = d.decontamination(docs, benchmark).collect()
    assert len(got) == len(rows)
    flagged = {r["doc_id"] for r in got if r["contaminated"]}
    assert flagged == {i for i, x in want.items() if x} | {None}
    kept = d.clean_documents(table(rows), benchmark)
    stay = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert {i for i, _ in stay} == {i for i, _ in rows} - flagged | {None}
    # Of the rows without an id only the contaminated one goes.
    assert {t for i, t in stay if i is None} == {t for i, t in HARD if i is None}
    spans = [tuple(r) for r in d.contaminations(docs, benchmark).where("doc_id = 4").collect()]
    assert spans == [(4, 3, 50, 70)]


def test_empty_tables(table, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in d.decontamination(table(HARD), none).collect())
    some = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert d.decontamination(table([]), some).collect() == []


def test_seeds_ignore_what_masks_leave_out():
    rnd = random.Random(8)
    words = prose(rnd, d.SPAN)
    for m, mask in enumerate(d.MASKS):
        for at, bit in enumerate(mask):
            other = words[:at] + ["other"] + words[at + 1:]
            same = d.seeds(d.token_hashes(" ".join(words)))[m] == d.seeds(d.token_hashes(" ".join(other)))[m]
            assert same.tolist() == [bit == "0"]


def brute(doc, item):
    """Every window of every diagonal, trimmed, merged."""
    size = min(d.WINDOW, len(item))
    allowed = size // d.ONE_IN if size >= d.LEAST else 0
    covered = [False] * (len(doc) + 1)
    for i in range(len(doc) - size + 1):
        for j in range(len(item) - size + 1):
            equal = [doc[i + k] == item[j + k] for k in range(size)]
            if sum(equal) >= size - allowed:
                first, last = equal.index(True), size - equal[::-1].index(True)
                covered[i + first:i + last] = [True] * (last - first)
    edges = [p for p in range(len(doc) + 1) if covered[p] != (covered[p - 1] if p else False)]
    return list(zip(edges[::2], edges[1::2]))


def test_overlaps_against_brute_force(monkeypatch):
    rnd = random.Random(5)
    for tile in (8, 40, 1024):
        monkeypatch.setattr(d, "TILE", tile)
        for case in range(60):
            letters = rnd.choice((2, 5, 60))
            item = [rnd.randrange(letters) for _ in range(rnd.choice((3, 4, 7, 8, 12, 16, 17, 40)))]
            doc = [rnd.randrange(letters) for _ in range(rnd.randrange(60))]
            for _ in range(2):
                at = rnd.randrange(len(doc) + 1)
                doc[at:at] = [t if rnd.random() < 0.85 else 99 for t in item]
            got = d.overlaps(np.array(doc, np.uint32), np.array(item, np.uint32))
            assert got == (brute(doc, item) if len(item) >= d.SHORTEST else []), (tile, case)


def test_a_million_repeats_in_bounded_memory():
    import resource
    import time

    before, start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.perf_counter()
    assert d.overlaps(np.full(1_000_000, 7, np.uint32), np.full(500, 7, np.uint32)) == [(0, 1_000_000)]
    assert time.perf_counter() - start < 90
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000  # kB
