"""Postings placed by document, with upper bounds: ranking without an exchange of what matches.

A document belongs to one shard, by hash, and has an ordinal in it, in order of source and id. A posting list is cut
into blocks by ordinal range; a block holds its documents' ordinals, frequencies and lengths, and its largest frequency
and shortest length, which bound every score in it. The table is bucketed by shard, so a task reads whole shards: it
matches, sums and takes the best `k` of every query, and only those are exchanged.

In a shard, lists whose bounds together stay below the k-th score seen so far are not essential: candidates come from
the others, and a candidate is dropped when its score so far with the bounds of the blocks that may hold it does not
reach the k-th score. Blocks without candidates are never turned into scores.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladle.operators.upsert import has_table
from ladle.session import passing, ship_package

#: Documents of a shard, on average; and of the ordinal range of a block.
DOCS_PER_SHARD, BLOCK = 50_000, 1024
#: Words of a shard's documents, on average: what the task that places it holds.
WORDS_PER_SHARD = 2_000_000
#: The most buckets a table may have by default; beyond, shards grow.
MOST_SHARDS = 100_000

_BLOCKS = ("shard int, source string, field string, term string, block int, ords array<int>, tfs array<int>, "
           "dls array<int>, max_tf int, min_dl int")
_DOCS = "shard int, ord int, source string, _id string"
_HITS = "asked long, shard int, ord int, score double"
_MATCHES = "asked long, source string, _id string, score double"

# Scores are rounded to six digits before they are ranked; bounds allow for that.
_DIGITS, _SLACK = 1e6, 2e-6


@dataclass(frozen=True)
class Placed:
    """Open tables; both are bucketed by shard."""

    blocks: DataFrame
    docs: DataFrame


def _table(path: str, part: str) -> str:
    return f"ladle_{part}_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def _write(df: DataFrame, path: str, part: str, shards: int, order: list[str]) -> None:
    """Write rows whose partitions are whole shards."""
    name = _table(path, part)
    df.sparkSession.sql(f"drop table if exists {name}")
    with passing(df.sparkSession):
        (df.write.mode("overwrite").option("path", f"{path}/{part}").option("compression", "zstd")
           .bucketBy(shards, "shard").sortBy(*order).saveAsTable(name))


def _numbers(spark: SparkSession, shards: int) -> Column:
    """For each of `shards` slots a number that falls in a bucket of its own."""
    rows = (spark.range(0, 40 * shards + 400).select(F.col("id").cast("int").alias("v"))
            .groupBy(F.pmod(F.hash("v"), F.lit(shards)).alias("bucket")).agg(F.min("v").alias("v")).orderBy("bucket").collect())
    return F.array(*(F.lit(r["v"]) for r in rows))


def place(postings: DataFrame, docs: DataFrame, path: str, documents: int, words: int, shards: int | None = None) -> Placed:
    """Write `postings(source, field, term, _id, tf, dl)` of so many documents `docs(source, _id)` as blocks below `path`.

    Postings are exchanged once, by shard; shards are bounded by the words of their documents, so what a task holds
    does not grow with the index.
    """
    spark = postings.sparkSession
    ship_package(spark)
    if shards is None:
        least = max(-(-documents // DOCS_PER_SHARD), -(-words // WORDS_PER_SHARD))
        shards = min(MOST_SHARDS, max(spark.sparkContext.defaultParallelism, least))
    numbers = _numbers(spark, shards)
    slot = F.pmod(F.xxhash64("source", "_id"), F.size(numbers)).cast("int")
    sharded = lambda df: df.where("source is not null and _id is not null").withColumn(
        "shard", F.get(numbers, slot)).repartition(shards, "shard")
    listed = sharded(docs.select("source", "_id").distinct()).withColumn(
        "ord", F.row_number().over(Window.partitionBy("shard").orderBy("source", "_id")) - 1)
    _write(listed.select("shard", "ord", "source", "_id"), path, "placed_docs", shards, ["ord"])
    held = spark.table(_table(path, "placed_docs")).repartition(shards, "shard")
    rows = sharded(postings.select("source", "field", "term", "_id", F.col("tf").cast("int").alias("tf"),
                                   F.col("dl").cast("int").alias("dl")))
    # A number of a shard falls in a bucket of its own, so a task has one shard, and its blocks need no exchange.
    blocks = rows.groupBy("shard").cogroup(held.groupBy("shard")).applyInArrow(_blocks, _BLOCKS)
    _write(blocks, path, "placed", shards, ["term", "field"])
    spark.range(1).select(F.lit(shards).alias("shards")).write.mode("overwrite").parquet(f"{path}/placed_shape")
    return open_placed(spark, path)


def _blocks(key: tuple, postings: pa.Table, docs: pa.Table) -> pa.Table:
    """Blocks of one shard."""
    ints, size = pa.list_(pa.int32()), postings.num_rows
    schema = pa.schema([("shard", pa.int32()), ("source", pa.string()), ("field", pa.string()), ("term", pa.string()),
                        ("block", pa.int32()), ("ords", ints), ("tfs", ints), ("dls", ints), ("max_tf", pa.int32()), ("min_dl", pa.int32())])
    if not size:
        return schema.empty_table()
    sources, ids = (pc.unique(docs[c]) for c in ("source", "_id"))
    number = lambda values, known: pc.index_in(values, value_set=known).to_numpy().astype(np.int64)
    source = number(postings["source"], sources)
    known = number(docs["source"], sources) * len(ids) + number(docs["_id"], ids)
    by_number = np.argsort(known)
    at = np.searchsorted(known, source * len(ids) + number(postings["_id"], ids), sorter=by_number)
    ords = docs["ord"].to_numpy()[by_number[at]].astype(np.int64)
    fields, terms = pc.unique(postings["field"]), pc.unique(postings["term"])
    lists = (source * len(fields) + number(postings["field"], fields)) * len(terms) + number(postings["term"], terms)
    order = np.lexsort((ords, lists))
    lists, ords = lists[order], ords[order]
    tfs, dls = (postings[c].to_numpy()[order] for c in ("tf", "dl"))
    begin = np.flatnonzero(np.concatenate([[True], (lists[1:] != lists[:-1]) | (ords[1:] // BLOCK != ords[:-1] // BLOCK)]))
    offsets = pa.array(np.append(begin, size).astype(np.int32))
    split = lambda values: pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int32)))
    first = postings.select(["source", "field", "term"]).take(pa.array(order[begin]))
    columns = [pa.array(np.full(len(begin), key[0].as_py()), pa.int32()), *first.columns,
               pa.array((ords[begin] // BLOCK).astype(np.int32)), split(ords), split(tfs), split(dls),
               pa.array(np.maximum.reduceat(tfs, begin)), pa.array(np.minimum.reduceat(dls, begin))]
    return pa.table(columns, schema=schema)


def open_placed(spark: SparkSession, path: str) -> Placed | None:
    """The tables below `path`, made known to this session where they are not yet; None if nothing is placed there."""
    if not has_table(spark, f"{path}/placed_shape"):
        return None
    shape = spark.read.parquet(f"{path}/placed_shape").first()
    if shape is None:
        return None
    for part, schema in (("placed", _BLOCKS), ("placed_docs", _DOCS)):
        if not spark.catalog.tableExists(_table(path, part)):
            spark.sql(f"create table {_table(path, part)} ({schema}) using parquet "
                      f"clustered by (shard) into {shape['shards']} buckets location '{path}/{part}'")
    return Placed(spark.table(_table(path, "placed")), spark.table(_table(path, "placed_docs")))


def unplace(spark: SparkSession, path: str) -> None:
    """What is placed below `path` no longer holds: its index is about to change."""
    if has_table(spark, f"{path}/placed_shape"):
        spark.createDataFrame([], "shards int").write.mode("overwrite").parquet(f"{path}/placed_shape")


def best(placed: Placed, gains: DataFrame, key: list[str], queries: list[dict[str, int]], fields: dict[str, float], k: int,
         k1: float, b: float, named: Column) -> DataFrame:
    """(asked, source, _id, score): rows among which are the best `k` of each query; `asked` is its place in the list.

    `gains` (key, gain, avgdl) is what a term is worth in a field, joined on `key`; it must fit a broadcast.
    `queries` give each term's repeats, `fields` the boosts; a document's score is that of its best field.
    """
    spark = gains.sparkSession
    ship_package(spark)
    search = _searcher(queries, fields, k, k1, b)
    hits = (placed.blocks.where(named).join(F.broadcast(gains), key)
            .select("shard", "field", "term", "ords", "tfs", "dls", "max_tf", "min_dl", "gain", "avgdl")
            .groupBy("shard").applyInArrow(search, _HITS))
    # Ties with the last of the best stay, because ids across shards are not known here.
    near = Window.partitionBy("asked").orderBy(F.col("score").desc())
    few = hits.withColumn("near", F.rank().over(near)).where(F.col("near") <= k).drop("near")
    return few.join(placed.docs, ["shard", "ord"]).select("asked", "source", "_id", "score")


def every(placed: Placed, gains: DataFrame, key: list[str], queries: list[dict[str, int]], fields: dict[str, float],
          k1: float, b: float, named: Column) -> DataFrame:
    """(asked, source, _id, score) of every match, not rounded; otherwise as `best`.

    A shard's documents lie beside its blocks, so a task names and writes its matches itself and none is exchanged. It
    holds the matches of one shard at a time.
    """
    spark = gains.sparkSession
    ship_package(spark)
    blocks = (placed.blocks.where(named).join(F.broadcast(gains), key)
              .select("shard", "field", "term", "ords", "tfs", "dls", "max_tf", "min_dl", "gain", "avgdl"))
    return blocks.groupBy("shard").cogroup(placed.docs.groupBy("shard")).applyInArrow(_matcher(queries, fields, k1, b), _MATCHES)


def _matcher(queries: list[dict[str, int]], fields: dict[str, float], k1: float, b: float) -> Callable:
    def match(key: tuple, blocks: pa.Table, docs: pa.Table) -> pa.Table:
        schema = pa.schema([("asked", pa.int64()), ("source", pa.string()), ("_id", pa.string()), ("score", pa.float64())])
        shard, out = Shard(blocks, k1, b), []
        docs = docs.take(pa.array(np.argsort(docs["ord"].to_numpy()))).combine_chunks()
        for q, query in enumerate(queries):
            ords, scores = shard.every(query, fields)
            if len(ords):
                named = docs.select(["source", "_id"]).take(pa.array(ords))
                out.append(pa.table([pa.array(np.full(len(ords), q)), *named.columns, pa.array(scores)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()

    return match


def _searcher(queries: list[dict[str, int]], fields: dict[str, float], k: int, k1: float, b: float) -> Callable:
    least = [0.0] * len(queries)  # k-th scores over the shards of a task: the function is unpickled once in each

    def search(key: tuple, blocks: pa.Table) -> pa.Table:
        shard, out = Shard(blocks, k1, b), []
        for q, query in enumerate(queries):
            docs, scores = shard.best(query, fields, k, least[q])
            if len(docs):
                if len(docs) == k:
                    least[q] = max(least[q], float(scores[-1]))
                out.append((np.full(len(docs), q), np.full(len(docs), key[0].as_py()), docs, scores))
        columns = [np.concatenate(c) for c in zip(*out)] or [np.empty(0)] * 4
        return pa.table([pa.array(c).cast(t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.float64()))],
                        names=["asked", "shard", "ord", "score"])

    return search


class Shard:
    """Blocks of one shard as flat arrays, turned into scores when they are asked for."""

    def __init__(self, blocks: pa.Table, k1: float, b: float):
        self.k1, self.b = k1, b
        blocks = blocks.combine_chunks()
        number = {c: blocks[c].to_numpy() for c in ("gain", "avgdl", "max_tf", "min_dl")}
        lists = {c: blocks[c].combine_chunks() if blocks.num_rows else None for c in ("ords", "tfs", "dls")}
        self.gain, self.avgdl = number["gain"], number["avgdl"]
        self.bound = self._part(self.gain, self.avgdl, number["max_tf"], number["min_dl"])
        self.ords, self.tfs, self.dls = (v.flatten().to_numpy() if v is not None else np.empty(0, np.int32) for v in lists.values())
        size = lists["ords"].value_lengths().to_numpy() if blocks.num_rows else np.empty(0, np.int64)
        self.begin = np.concatenate([[0], np.cumsum(size)])
        self.first, self.last = (self.ords[at].astype(np.int64) for at in (self.begin[:-1], self.begin[1:] - 1))
        self.size = int(self.last.max()) + 1 if len(size) else 0
        rows: dict[tuple[str, str], list[int]] = {}
        for row, name in enumerate(zip(blocks["field"].to_pylist(), blocks["term"].to_pylist())):
            rows.setdefault(name, []).append(row)
        self.rows = {name: np.array(r)[np.argsort(self.first[r])] for name, r in rows.items()}
        self.most = {name: float(self.bound[r].max()) for name, r in self.rows.items()}
        self.held: dict[int, np.ndarray] = {}
        self.whole: dict[tuple[str, str], tuple[np.ndarray, np.ndarray]] = {}

    def _part(self, gain, avgdl, tf, dl):
        return gain * tf / (tf + self.k1 * (1 - self.b + self.b * dl / avgdl))

    def parts(self, row: int) -> np.ndarray:
        """Scores of a block's documents for one occurrence of its term in the query."""
        if row not in self.held:
            a, z = self.begin[row:row + 2]
            self.held[row] = self._part(self.gain[row], self.avgdl[row], self.tfs[a:z], self.dls[a:z])
        return self.held[row]

    def entries(self, name: tuple[str, str]) -> tuple[np.ndarray, np.ndarray]:
        """Ordinals of a whole list, and their scores."""
        if name not in self.whole:
            rows = self.rows[name]
            size = self.begin[rows + 1] - self.begin[rows]
            at = np.repeat(self.begin[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            self.whole[name] = self.ords[at], self._part(np.repeat(self.gain[rows], size), np.repeat(self.avgdl[rows], size),
                                                         self.tfs[at], self.dls[at])
        return self.whole[name]

    def best(self, query: dict[str, int], fields: dict[str, float], k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Ordinals and rounded scores of the best `k`, best first, as far as they reach `least`."""
        found, scored = [], []
        for field in fields:
            docs, scores = self._field(field, query, k, least)
            found.append(docs)
            scored.append(scores)
            least = max(least, _kth(scores, k))
        docs, scores = np.concatenate(found), np.floor(np.concatenate(scored) * _DIGITS + 0.5) / _DIGITS
        order = np.lexsort((docs, -scores))
        _, once = np.unique(docs[order], return_index=True)  # the better of a document's fields
        top = order[np.sort(once)[:k]]
        return docs[top], scores[top]

    def every(self, query: dict[str, int], fields: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
        """Ordinals and scores of all documents with a term of the query."""
        top, seen = np.zeros(self.size), np.zeros(self.size, bool)
        for field in fields:
            scores = np.zeros(self.size)
            for term, n in query.items():
                if (field, term) in self.rows:
                    ords, parts = self.entries((field, term))
                    scores[ords] += n * parts
                    seen[ords] = True
            np.maximum(top, scores, out=top)
        docs = np.flatnonzero(seen)
        return docs, top[docs]

    def _field(self, field: str, query: dict[str, int], k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        lists = sorted((self.most[field, t] * n, n, (field, t)) for t, n in query.items() if (field, t) in self.rows)
        below = np.cumsum([0.0] + [bound for bound, *_ in lists])  # bounds of the lists before each
        essential = int(np.searchsorted(below[1:] + _SLACK, least, "left"))
        scores, seen = np.zeros(self.size), np.zeros(self.size, bool)
        for _, n, name in lists[essential:]:
            ords, parts = self.entries(name)
            scores[ords] += n * parts
            seen[ords] = True
        docs = np.flatnonzero(seen)
        scores = scores[docs]
        for j in range(essential - 1, -1, -1):
            least = max(least, _kth(scores, k))
            near = scores + below[j + 1] + _SLACK >= least
            docs, scores = docs[near], scores[near]
            if not len(docs):
                break
            _, n, name = lists[j]
            rows = self.rows[name]
            at = np.searchsorted(self.last[rows], docs)
            inside = at < len(rows)
            inside[inside] = self.first[rows[at[inside]]] <= docs[inside]
            bound = np.zeros(len(docs))
            bound[inside] = self.bound[rows[at[inside]]] * n
            near = scores + bound + below[j] + _SLACK >= least
            docs, scores, at, inside = docs[near], scores[near], at[near], inside[near]
            for block in np.unique(at[inside]).tolist():
                row = int(rows[block])
                mine = np.flatnonzero(inside & (at == block))
                ords = self.ords[self.begin[row]:self.begin[row + 1]]
                place = np.minimum(np.searchsorted(ords, docs[mine]), len(ords) - 1)
                hit = ords[place] == docs[mine]
                scores[mine[hit]] += n * self.parts(row)[place[hit]]
        return docs, scores


def _kth(scores: np.ndarray, k: int) -> float:
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0.0
