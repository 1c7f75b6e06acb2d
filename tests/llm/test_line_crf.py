import itertools
import zlib

import numpy as np
import pytest

from ladle.llm import line_crf as c
from hard_rows import HARD


def test_marginals_against_all_labellings():
    rnd = np.random.default_rng(5)
    for n in (1, 2, 5):
        unary, stay = rnd.normal(size=n), 0.7
        weights = {y: np.exp(sum(u for u, v in zip(unary, y) if v) + stay * sum(a == b for a, b in zip(y, y[1:])))
                   for y in itertools.product((0, 1), repeat=n)}
        want = [sum(w for y, w in weights.items() if y[i]) / sum(weights.values()) for i in range(n)]
        assert c.marginals(unary, stay) == pytest.approx(want)
        good, equal = c._expected(unary[:, None], stay, np.ones((n, 1)))
        assert good[:, 0] == pytest.approx(want)
        pairs = [sum(w for y, w in weights.items() if y[i] == y[i + 1]) / sum(weights.values()) for i in range(n - 1)]
        assert equal[:, 0] == pytest.approx(pairs)


def texts(n):
    good = [(i, "\n".join(f"A fine line number {i * 7 + j} of some words, here." for j in range(4))) for i in range(0, n, 2)]
    bad = [(i, "\n".join(f"BUY!! NOW!! {i * 3 + j}!! CHEAP!! CHEAP!!" for j in range(3))) for i in range(1, n, 2)]
    return good + bad


def test_held_out_accuracy_and_folds(table, spark):
    rows = texts(240)
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in rows], "doc_id long, quality int")
    got = c.quality_scores(table(rows, extra=True), labels).collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _ in rows}
    held = [r for r in got if r["held_out"]]
    assert len(held) > 40 and all(r["predicted"] == 1 - r["doc_id"] % 2 for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_held_out_labels_teach_nothing(table, spark):
    rows = texts(120)
    honest = [(i, 1 - i % 2) for i, _ in rows]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in honest]
    scores = [sorted(map(tuple, c.quality_scores(table(rows), spark.createDataFrame(x, "doc_id long, quality int")).collect()))
              for x in (honest, turned)]
    assert scores[0] == scores[1]


def test_hard_rows_and_no_labels(table, spark):
    labels = spark.createDataFrame([(1, None), (None, 1), (99, 0)], "doc_id long, quality int")
    got = c.quality_scores(table(HARD), labels).collect()
    assert len(got) == len(HARD) and all(r["score"] == 0.5 for r in got)
    assert c.quality_scores(table([]), labels).collect() == []


def test_late_lines_teach(table, spark):
    """Bad documents that begin well: what follows the first lines is learnt from, and calibrated on."""
    head = [f"A fine line number {j} of some words, here." for j in range(20)]
    good = [(i, "\n".join(head + [f"A fine line number {i * 7 + j} of some words, here." for j in range(20)])) for i in range(0, 160, 2)]
    bad = [(i, "\n".join(head + [f"BUY!! NOW!! {i * 3 + j}!! CHEAP!! CHEAP!!" for j in range(40)])) for i in range(1, 160, 2)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in good + bad], "doc_id long, quality int")
    got = c.quality_scores(table(good + bad), labels, lines=8).collect()
    assert sum(r["predicted"] == 1 - r["doc_id"] % 2 for r in got) > 0.95 * len(got)
