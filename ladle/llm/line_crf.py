"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's features and those of its neighbours give its potentials, and two
neighbours' labels a transition; forward and backward sums give each line's marginal of being good. The
score of a document is the length-weighted mean of its marginals, calibrated on the labelled sample.

The labels of the tables mark documents, so in training each line has its document's label. The field
is fitted on the driver, on a bounded sample of labelled documents: the `SAMPLE` first by hash, and of
each at most `SAMPLE_LINES` lines side by side, at a place that hashes of the id choose, as numbers computed
on the executors. Calibration and scoring read whole texts.

Defined results: a null text is an empty one; an empty text is one empty line and scores like any other;
repeated rows are answered one by one; labels that are null, or that name no document, teach nothing;
without labels of both kinds every score is 0.5; other columns of the input are not looked at; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField,
                               StructType)

from ladle.llm.mapping import map_texts, sliced, unused
from ladle.session import settle

#: Labelled documents, and lines of each, that training reads at most.
SAMPLE, SAMPLE_LINES = 4000, 128

_REST = re.compile(r"[\w\s]+")
_ENDS = frozenset(".!?:;\"'»”)")


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x features, length of each line). Nothing but the text is looked at."""
    lines = text.split("\n")
    seen: set[str] = set()
    rows, lengths = [], []
    for line in lines:
        n = len(line)
        words = line.split()
        k = len(words)
        lengths.append(n + 1)
        if not k:
            rows.append((1.0,) + (0.0,) * 13)
            continue
        distinct = len(set(words))
        again = sum(map(str.__eq__, words, words[1:]))
        signs = _REST.sub("", line)
        upper = sum(map(str.isupper, words))
        rows.append((
            0.0, min(n, 400) / 400, min(k, 60) / 60, min(n / k, 20) / 20, distinct / k, again / k,
            upper / k, min(len(signs) / n, 0.5) * 2, min(signs.count("!") / k, 1.0),
            min(sum(map(signs.count, "#*$%&|<>{}=\\/@^~_")) / k, 1.0),
            float(line.rstrip()[-1] in _ENDS), float(words[0][0].isupper()), float(line in seen),
            float(k < 4)))
        seen.add(line)
    return np.array(rows), np.array(lengths, float)


WIDTH = 14


def with_neighbours(rows: np.ndarray) -> np.ndarray:
    """A line's features beside those of the lines before and after it, and a constant."""
    none = np.zeros((1, rows.shape[1]))
    return np.hstack([rows, np.vstack([none, rows[:-1]]), np.vstack([rows[1:], none]), np.ones((len(rows), 1))])


class Field(NamedTuple):
    """`weights`: of the good label's potential against the bad one's; `stay`: of equal neighbours;
    `slope` and `shift`: from mean marginals to scores."""

    weights: np.ndarray
    stay: float
    slope: float = 1.0
    shift: float = 0.0


def marginals(unary: np.ndarray, stay: float) -> np.ndarray:
    """P(good) of each line. `unary`: log potentials of good (bad has 0), lines or (lines, chains).

    A chain is summed in the log odds of its messages: m' = log((e^(m+stay) + 1) / (e^m + e^stay)).
    """
    n = len(unary)
    before, after = np.zeros_like(unary), np.zeros_like(unary)
    m = np.zeros(unary.shape[1:])
    for i in range(1, n):
        x = m + unary[i - 1]
        before[i] = m = np.logaddexp(x + stay, 0) - np.logaddexp(x, stay)
    m = np.zeros(unary.shape[1:])
    for i in range(n - 2, -1, -1):
        x = m + unary[i + 1]
        after[i] = m = np.logaddexp(x + stay, 0) - np.logaddexp(x, stay)
    return 1 / (1 + np.exp(-np.clip(before + unary + after, -40, 40)))


def _quality(field: Field, text: str) -> float:
    rows, lengths = line_features(text)
    good = marginals(with_neighbours(rows) @ field.weights, field.stay)
    return float(good @ lengths / lengths.sum())


def score(field: Field, text: str) -> float:
    mean = min(max(_quality(field, text), 1e-6), 1 - 1e-6)
    logit = field.slope * np.log(mean / (1 - mean)) + field.shift
    return float(1 / (1 + np.exp(-np.clip(logit, -40, 40))))


def fit(documents: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 80, ridge: float = 1e-3) -> Field:
    """Maximum conditional likelihood of the lines' labels by gradient ascent (Adam), then calibration.

    `documents`: features, lengths and label of each. The gradient of a potential's weight is the
    feature's value under the labels less that under the marginals; that of `stay` is the number of
    equal neighbours less their expected number.
    """
    if len({label for *_, label in documents}) < 2:
        return Field(np.zeros(3 * WIDTH + 1), 0.0, 0.0, 0.0)
    size = np.array([len(rows) for rows, *_ in documents])
    # One row per line for the features; chains side by side, padded at their ends, for the sums.
    x = np.vstack([with_neighbours(rows) for rows, *_ in documents])
    length = np.concatenate([lengths for _, lengths, _ in documents])
    chain = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(chain)) - np.repeat(np.cumsum(size) - size, size)
    real = np.zeros((size.max(), len(size)))
    real[place, chain] = 1
    label = np.array([y for *_, y in documents], float)
    # Both labels weigh the same, and a document weighs the same however many lines it has.
    share = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum()) / size
    pairs = real[1:] * real[:-1] * share

    def expected(theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unary = np.zeros_like(real)
        unary[place, chain] = x @ theta[:-1]
        good, equal = _expected(unary, theta[-1], real)
        return good[place, chain], equal

    theta = np.zeros(3 * WIDTH + 2)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        good, equal = expected(theta)
        slope = np.append((share[chain] * (label[chain] - good)) @ x,
                          (pairs * (1 - equal)).sum()) - ridge * theta  # neighbours' labels are equal
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope * slope
        theta = theta + 0.15 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-9)
    mean = np.bincount(chain, expected(theta)[0] * length) / np.bincount(chain, length)
    return calibrated(Field(theta[:-1], float(theta[-1])), mean, label)


def calibrated(field: Field, mean: np.ndarray, label: np.ndarray) -> Field:
    """The field with slope and shift fitted to documents' mean marginals and labels."""
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    slope, shift = _calibrated(np.log(mean / (1 - mean)), label)
    return field._replace(slope=slope, shift=shift)


def _expected(unary: np.ndarray, stay: float, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of lines, and of equal neighbours, over chains padded at their ends."""
    n = len(unary)
    before, after = np.zeros_like(unary), np.zeros_like(unary)
    for i in range(1, n):
        x = before[i - 1] + unary[i - 1]
        before[i] = np.logaddexp(x + stay, 0) - np.logaddexp(x, stay)
    for i in range(n - 2, -1, -1):
        x = after[i + 1] + unary[i + 1]
        after[i] = np.where(real[i + 1] > 0, np.logaddexp(x + stay, 0) - np.logaddexp(x, stay), 0.0)
    good = 1 / (1 + np.exp(-np.clip(before + unary + after, -40, 40)))
    left, right = (before + unary)[:-1], (after + unary)[1:]
    same = np.logaddexp(left + right, 0) + stay
    other = np.logaddexp(left, right)
    return good, 1 / (1 + np.exp(np.clip(other - same, -40, 40)))


def _calibrated(x: np.ndarray, label: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Logistic regression of the labels on x by damped Newton steps, both labels weighing the same."""
    design = np.stack([x, np.ones_like(x)], 1)
    weight = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    theta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -40, 40)))
        slope = design.T @ (weight * (label - p)) - 1e-3 * (theta - [1.0, 0.0])
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        theta = theta + np.clip(np.linalg.solve(curve, slope), -1, 1)
    return float(theta[0]), float(theta[1])


_SAMPLED = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()),
                       StructField("features", BinaryType()), StructField("lengths", ArrayType(DoubleType()))])
_MEANS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()), StructField("mean", DoubleType())])
_SCORES = StructType([StructField("doc_id", LongType()), StructField("held_out", BooleanType()),
                      StructField("score", DoubleType()), StructField("predicted", IntegerType())])


def held_out(id: str = "doc_id"):
    """The fold that no label is learnt from. A null id is in none."""
    return F.coalesce(F.crc32(F.col(f"`{id}`").cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines: int = SAMPLE_LINES,
          text: str = "text") -> Field:
    """A field fitted on the `sample` labelled documents, outside the held-out fold, that hash first."""
    marked = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
              .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(sample))
    # `marked` has at most `sample` rows; of a repeated id, one text is read.
    some = settle(docs.select("doc_id", F.col(f"`{text}`").cast("string").alias("text")).join(F.broadcast(marked), "doc_id")
                  .groupBy("doc_id", "quality").agg(F.min("text").alias("text")), "labelled")

    def block(doc_id: int, n: int) -> slice:
        begin = zlib.crc32(str(doc_id).encode()) % max(1, n - lines + 1)
        return slice(begin, begin + lines)

    def kernel(ids: list, quality: list, texts: list) -> list:
        found = [line_features(t or "") for t in texts]
        part = [block(i, len(lengths)) for i, (_, lengths) in zip(ids, found)]
        return [ids, quality, [rows[p].astype(np.float32).tobytes() for p, (rows, _) in zip(part, found)],
                [lengths[p].tolist() for p, (_, lengths) in zip(part, found)]]

    rows = map_texts(some, kernel, _SAMPLED, keep=("doc_id", "quality")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    field = fit([(np.frombuffer(r["features"], np.float32).reshape(-1, WIDTH), np.array(r["lengths"]), r["quality"])
                 for r in rows])
    if len({r["quality"] for r in rows}) < 2:
        return field

    def whole(ids: list, quality: list, texts: list) -> list:
        return [ids, quality, [_quality(field, t or "") for t in texts]]

    means = sorted(map_texts(some, whole, _MEANS, keep=("doc_id", "quality")).collect())
    return calibrated(field, np.array([m["mean"] for m in means]), np.array([m["quality"] for m in means], float))


def quality_scores(docs: DataFrame, labels: DataFrame, text: str = "text", **bounds: int) -> DataFrame:
    """doc_id, held_out, score (likelihood of quality 1), predicted (1 from 0.5 on)."""
    field = train(docs, labels, text=text, **bounds)

    def kernel(ids: list, held: list, texts: list) -> list:
        scores = [score(field, t or "") for t in texts]
        return [ids, held, scores, [int(s >= 0.5) for s in scores]]

    held = unused(docs, "held")
    return map_texts(docs.withColumn(held, held_out()), kernel, _SCORES, text, ("doc_id", held))


def good_documents(docs: DataFrame, labels: DataFrame, text: str = "text", **bounds: int) -> DataFrame:
    """The rows of `docs` that are predicted good; all columns stay."""
    field = train(docs, labels, text=text, **bounds)
    at = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        for batch in sliced(batches, at):
            yield batch.filter(pa.array([score(field, t or "") >= 0.5 for t in batch.column(at).to_pylist()]))

    return docs.mapInArrow(run, docs.schema)
