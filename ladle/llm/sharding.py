"""Shards of near equal bytes by histogram sort.

Rows are ordered by key. Candidate boundaries are probed: one pass counts the exact bytes and rows below
each of them over all partitions, and the gap that holds a wanted boundary is probed more finely in the
next pass, until every splitter meets the tolerance. Then the rows are exchanged once, whole: the texts are dealt, not
only what is known of them.

There are more splitters than shards, so that the exchange deals a shard to many tasks; the exact row
counts below the splitters give each task the first slot of its rows. Rows that share a key are split
by a number of their own, so a key with a third of all rows spans shards like any other rows.

Defined results: a null text has size 1; null keys come first; repeated rows get slots of their own;
other columns of the input travel with their row and are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.session import settle, ship_package

#: Probes between two known boundaries in one pass.
FAN = 15
_LOW, _TIES = -(1 << 63), 1 << 63


def _cells(keys: np.ndarray, ties: np.ndarray, probes: list[tuple[int, int]]) -> np.ndarray:
    """How many of the sorted (key, tie) probes are at or below each row."""
    at, own = (np.array(x, np.int64) for x in zip(*probes, strict=True))
    begin, end = np.searchsorted(at, keys, "left"), np.searchsorted(at, keys, "right")
    cell = begin.copy()
    same = np.flatnonzero(end > begin)  # rows whose key is that of a probe: their ties decide
    for first in np.unique(begin[same]):
        rows = same[begin[same] == first]
        cell[rows] = first + np.searchsorted(own[first:end[rows[0]]], ties[rows], "right")
    return cell


def _below(rows: DataFrame, probes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Exact (bytes, rows) below each probe: partial histograms per task, one row per cell to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, count = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            key, tie, weight = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            cell = _cells(key, tie, probes)
            np.add.at(size, cell, weight)
            count += np.bincount(cell, minlength=len(count))
        full = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"cell": full, "size": size[full], "n": count[full]})

    cells = (rows.select("key", "tie", "size").mapInArrow(run, "cell long, size long, n long")
             .groupBy("cell").agg(F.sum("size"), F.sum("n")).collect())
    size, count = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    for cell, s, n in cells:
        size[cell], count[cell] = s, n
    return list(zip(np.cumsum(size)[:-1].tolist(), np.cumsum(count)[:-1].tolist(), strict=True))


def _number(probe: tuple[int, int]) -> int:
    return (probe[0] - _LOW) * _TIES + probe[1]


def _probe(number: int) -> tuple[int, int]:
    return number // _TIES + _LOW, number % _TIES


def splitters(rows: DataFrame, parts: int, tolerance: int = 0) -> list[tuple[tuple[int, int], int, int]]:
    """For each of `parts` - 1 boundaries: the probe, and the bytes and rows below it.

    The i-th is the first place with at least i / `parts` of all bytes below it, and at most
    `tolerance` bytes more if rows allow; 0 gives the first such place itself.
    """
    total, least, most, n = rows.agg(F.sum("size"), F.min("key"), F.max("key"), F.count("*")).first()
    goals = [-(-total * i // parts) for i in range(1, parts)]
    floor, ceiling = _number((least, 0)), _number((most, 0)) + _TIES
    # Gap of each boundary: (low end with too few bytes below, high end with enough), with counts.
    low = [(floor, 0, 0)] * len(goals)
    high = [(ceiling, total, n)] * len(goals)
    while True:
        fresh: set[int] = set()
        for (a, _, rows_a), (b, size, rows_b), goal in zip(low, high, goals, strict=True):
            if size - goal > tolerance and rows_b - rows_a > 1:
                # Whole keys first; in a gap of one key, the numbers of its rows.
                step = _TIES if b - a > _TIES else 1
                first, gap = a // step, (b - a) // step
                fresh |= {(first + gap * i // (FAN + 1)) * step for i in range(1, FAN + 1)} - {a}
                fresh |= {(first + i) * step for i in range(1, min(gap, FAN + 1))}
        if not fresh:
            # Boundaries at one row may have been found at different places behind it.
            return [(_probe(at), size, count) for at, size, count in sorted(high)]
        probes = sorted(fresh)
        for at, (size, count) in zip(probes, _below(rows, [_probe(w) for w in probes]), strict=True):
            for i, goal in enumerate(goals):
                if size < goal and at > low[i][0]:
                    low[i] = (at, size, count)
                elif size >= goal and at < high[i][0]:
                    high[i] = (at, size, count)


def _bucket(probes: list[tuple[int, int]]) -> Callable:
    """Number of the bucket of a (key, tie); only these two reach Python."""
    @F.arrow_udf(returnType="int")
    def bucket(key: pa.Array, tie: pa.Array) -> pa.Array:
        return pa.array(_cells(*(c.to_numpy(zero_copy_only=False) for c in (key, tie)), probes), pa.int32())

    return bucket


def _size(body: Column) -> Column:
    return (F.octet_length(body) + 1).cast("long")


def shard_rows(docs: DataFrame, shards: int = 8, tolerance: int = 0, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every row of `docs`, whole, as `row`, with its `shard` and its `slot` there; rows of a shard lie together and in order."""
    spark = docs.sparkSession
    ship_package(spark)
    # Written with the rows, since a number given by reading may be another the next time.
    rows = settle(docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(_LOW)).alias("key"),
        F.monotonically_increasing_id().alias("tie"),
        _size(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("size")), "sized", compression="zstd")
    per_shard = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards))
    found = splitters(rows, shards * per_shard, tolerance) if not rows.isEmpty() else []
    probes = [p for p, *_ in found]
    starts = [0, *(n for *_, n in found)]
    # First slot of each bucket: the rows of its shard that stand before it.
    first = [starts[b] - starts[b - b % per_shard] for b in range(len(starts))]

    dealt = rows.select("row", "key", "tie", (_bucket(probes)("key", "tie") if probes else F.lit(0)).alias("bucket"))
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("key", "tie"))
    return dealt.select(
        "row", F.floor(F.col("bucket") / per_shard).cast("int").alias("shard"),
        (place - 1 + F.element_at(F.lit(first), F.col("bucket") + 1)).cast("long").alias("slot"))


def shard_by_bytes(docs: DataFrame, shards: int = 8, tolerance: int = 0, text: str = "text",
                   key: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law), of the texts that reached their shards."""
    names = list(dict.fromkeys([key, text]))
    dealt = shard_rows(docs.select(*(F.col(f"`{c}`") for c in names)), shards, tolerance, text, key)
    body = F.coalesce(F.col("row")[text].cast("string"), F.lit(""))
    return dealt.select(
        F.col("row")[key].cast("long").alias("doc_id"), _size(body).alias("size"), F.crc32(body).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
