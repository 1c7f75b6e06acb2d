import re
from collections import Counter

import pytest

from ladle.llm import quality_rules as q
from hard_rows import HARD


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def test_counts_against_brute_force(table, rows_of, spark):
    rows = HARD + [(20, "a b c a b c x a b"), (21, "a a a a"), (22, "#|x\n\n#|x\n y"), (23, "a b a b a b")]
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = rows_of(q.quality_rules(table(rows, extra=True).drop("quality"), labels))
    want = []
    for i, t in rows:
        c = brute(t or "")
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        want.append((i, *c, failed, not failed))  # without labels no cutoff is certified
    assert got == sorted(want, key=repr)
    assert q.quality_rules(table([]), labels).collect() == []


def test_cutoffs_reject_the_bad_and_keep_their_promise(table, spark):
    good = [(i, " ".join(f"w{(i * 31 + j * j) % 997}x{j}" for j in range(60))) for i in range(0, 2000, 2)]
    bad = [(i, " ".join(f"w{(i + j * j) % 997}#|x{j}" for j in range(60))) for i in range(1, 600, 2)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (5, None)],
                                   "doc_id long, quality int")
    kept = {r["doc_id"]: r["kept"] for r in q.quality_rules(table(good + bad), labels).collect()}
    assert sum(not kept[i] for i, _ in good) <= 0.02 * len(good)
    assert sum(kept[i] for i, _ in bad) <= 0.02 * len(bad)


def test_binomial_tail_is_exact():
    assert q.binomial_tail(0, 10, 0.1) == pytest.approx(0.9 ** 10)
    assert q.binomial_tail(2, 5, 0.5) == pytest.approx(0.5)
    assert q.binomial_tail(5, 5, 0.5) == 1.0
    assert q.certified(0, 219, 0.02, 0.05 / 4) and not q.certified(0, 200, 0.02, 0.05 / 4)
    assert not q.certified(0, 0, 0.02, 0.05)
