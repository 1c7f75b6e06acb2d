"""Quality rules whose cutoffs carry a guarantee.

A rule rejects a document when one of its signals lies above a cutoff; a stratum (language) has a cutoff
for each rule. A fourth of the labelled documents proposes, for each rule and stratum, the cutoff that
best tells bad from good. The others are the holdout. The proposals together, and the same ones slackened
by one grid step, two steps and so on, are a sequence of ever more lenient verdicts. From the most
lenient on, an exact binomial test on the holdout's good documents asks whether a verdict rejects at most
`risk` of the stratum's good documents; the sequence ends at the first that fails, and the strictest one
before it is used. Testing in a fixed order needs no correction within a stratum, and the level is
divided by the number of strata: with probability 1 - `error` no stratum loses more than `risk` of its
good documents. A stratum with too few labels gets no cutoff and loses nothing.

Defined results: a null text has no words and fails the base rule; a null language is a stratum of its
own; labels that are null teach nothing; repeated rows are answered one by one; other columns of the
input are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from math import exp, lgamma, log, log1p

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ladle.llm.mapping import map_texts
from ladle.operators.sizing import small
from ladle.session import settle

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Signals, and the cutoffs tried for each; larger is worse.
GRID: dict[str, tuple[float, ...]] = {
    "symbols": (0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3),
    "dup_lines": (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7),
    "repeats": (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.45),
    "upper": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7),
    "marks": (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.8),
    "long_words": (7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0),
    "one_word": (0.1, 0.15, 0.2, 0.3, 0.4, 0.6),
}

#: In a proposal, a share of good documents lost weighs as so many times that share of bad ones caught.
WORTH = 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURED = StructType(
    [StructField("doc_id", LongType()), StructField("stratum", StringType()),
     *(StructField(c, LongType()) for c in COUNTS), *(StructField(s, DoubleType()) for s in GRID)])


def repeated(words: list) -> int:
    """Words inside 3-word windows that occur twice or more, first occurrences included."""
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    covered, last = 0, -1
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered += i + 2 - max(last, i - 1)
            last = i + 2
    return covered


def measure_text(text: str) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The counts and the signals of a text."""
    words = text.encode().split()  # bytes: splits at space and \x09-\x0d only
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    again = len(lines) - len(set(lines))
    repeat = repeated(words)
    top = Counter(words).most_common(1)[0][1] if n else 0
    upper = sum(map(bytes.isupper, words))
    at_least = max(n, 1)
    return (n, chars, symbols, again, repeat), (
        symbols / max(chars, 1), again / max(len(lines), 1), repeat / at_least, upper / at_least,
        min(text.count("!") / at_least, 1.0), chars / at_least, top / at_least)


def measured(docs: DataFrame, stratum: str = "lang", text: str = "text") -> DataFrame:
    def kernel(ids: list, strata: list, texts: list) -> list:
        found = [measure_text(t or "") for t in texts]
        return [ids, strata, *zip(*(c + s for c, s in found), strict=True)]
    return map_texts(docs, kernel, MEASURED, text, ("doc_id", stratum))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(at most k of n), exactly, term by term."""
    if k >= n:
        return 1.0
    terms = (exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p))
             for i in range(k + 1))
    return min(1.0, sum(terms))


def certified(k: int, n: int, risk: float, level: float) -> bool:
    """k of n good documents rejected: is the rate at most `risk`, with error at most `level`?"""
    return n > 0 and k < risk * n and binomial_tail(k, n, risk) <= level


def cell(name: str):
    """How many of a signal's cutoffs it lies above."""
    return sum(((F.col(name) > c).cast("int") for c in GRID[name]), F.lit(0))


def base_failed():
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


_RULES = tuple(GRID)
_PROPOSED = "of string, " + ", ".join(f"at_{r} int" for r in _RULES)


def proposals(marked: DataFrame) -> DataFrame:
    """One row per stratum: for each rule the place of its cutoff in the grid, null if it does not help."""
    cells = [F.struct(F.lit(r).alias("rule"), cell(r).alias("cell")) for r in _RULES]
    counted = (marked.select("stratum", "quality", F.inline(F.array(*cells)))
               .groupBy("stratum", "rule", "cell", "quality").count())

    def choose(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
        """A stratum's counts: at most rules x cells x two labels."""
        def above(rule: str, quality: int) -> np.ndarray:
            some = counts[(counts["rule"] == rule) & (counts["quality"] == quality)]
            cells = np.bincount(some["cell"], some["count"], len(GRID[rule]) + 1)
            total = np.cumsum(cells[::-1])[::-1]
            return total[1:] / max(total[0], 1)

        gains = [above(r, 0) - WORTH * above(r, 1) for r in _RULES]
        # The most lenient of the best; a rule that gains less than 1 % stays unused.
        best = [len(g) - 1 - int(g[::-1].argmax()) if g.max() >= 0.01 else None for g in gains]
        return pd.DataFrame([(key[0], *best)], columns=["of", *(f"at_{r}" for r in _RULES)])

    return counted.groupBy("stratum").applyInPandas(choose, _PROPOSED)


def cutoffs(rows: DataFrame, labels: DataFrame, risk: float, error: float) -> DataFrame:
    """Per stratum (`of`): the proposed places and the `slack` added to them, null if none is certified.

    Only counts are gathered: of grid cells, and of the slack that spares a document.
    """
    labels = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
              .where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality")))
    marked = settle(rows.where(~base_failed()).join(labels, "doc_id")
                    .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(4))), "marked")
    proposed = settle(proposals(marked.where("fold = 0")), "proposed")
    strata = proposed.count()
    # A verdict slackened by j steps rejects what lies j cells or more behind one of the proposed cutoffs.
    behind = F.greatest(F.lit(0), *(F.coalesce(cell(r) - F.col(f"at_{r}"), F.lit(0)) for r in _RULES))
    counted = (marked.where("fold > 0 and quality = 1")
               .join(small(proposed), F.col("stratum").eqNullSafe(F.col("of")))
               .groupBy("of", behind.alias("behind")).count())
    steps = max(map(len, GRID.values()))

    def test(key: tuple, counts: pd.DataFrame) -> pd.DataFrame:
        cells = np.bincount(counts["behind"], counts["count"], steps + 1).astype(int)
        rejected = np.cumsum(cells[::-1])[::-1]  # by a verdict of slack j: those more than j behind
        slack = None
        for j in range(steps - 1, -1, -1):
            if not certified(int(rejected[j + 1]), int(rejected[0]), risk, error / max(1, strata)):
                break
            slack = j
        return pd.DataFrame([(key[0], slack)], columns=["of", "slack"])

    slacks = counted.groupBy("of").applyInPandas(test, "of string, slack int").withColumnRenamed("of", "tested")
    return proposed.join(slacks, F.col("of").eqNullSafe(F.col("tested")), "left").drop("tested")


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05,
                  stratum: str = "lang", text: str = "text") -> DataFrame:
    """doc_id, the counts, base_failed, and kept: false if the base rule or a certified cutoff rejects."""
    rows = settle(measured(docs, stratum, text), "measured")
    chosen = small(settle(cutoffs(rows, labels, risk, error), "cutoffs"))
    over = F.lit(False)
    for rule in _RULES:
        over = over | F.coalesce(cell(rule) - F.col(f"at_{rule}") > F.col("slack"), F.lit(False))
    return rows.join(chosen, F.col("stratum").eqNullSafe(F.col("of")), "left").select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & ~over).alias("kept"))
