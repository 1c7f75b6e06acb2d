"""Ranked lexical search: Block-Max MaxScore over segments of compressed postings.

Documents are indexed where they are read, without a shuffle. A segment holds at most `SEGMENT_BYTES` of text and
`SEGMENT_DOCS` documents, in order of their length: per term a list of blocks of 128 postings, each block with its first
and last document, its largest frequency and its shortest document (which bound every contribution in it), and its
postings in as few bytes as their largest value needs. Corpus statistics are sums over the segments.

A search reads segments one by one and keeps the best `k` of every query across those of its task. The k-th score splits
the lists of a query: those whose bounds together stay below it are not essential, and a document found in them alone
cannot win. Candidates come from the essential lists; in the others the block that may hold a candidate is found by its
last document, and a candidate whose score with that block's bound stays below the k-th is rejected before the block is
decompressed. The heaps of all tasks meet in one window per query. Queries are taken in blocks of bounded size.

Defined results: a term is a run of letters, digits and characters beyond ASCII, only A to Z lower-cased. Null and empty
texts have no terms; such documents count nowhere and such queries return nothing. Every row is a document of its own,
also where ids repeat or are null; equal scores go by ascending id, null last. Every query row is answered, also where
item ids repeat. Scores of 0 are no hits. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StructField, StructType)

from ladle.llm.mapping import chunks
from ladle.session import settle, ship_package

SEGMENT_BYTES = 16 << 20
SEGMENT_DOCS = 1 << 16
BLOCK = 128
#: Query terms held at once, in bytes; more queries are answered block by block.
QUERY_BYTES = 4 << 20
#: An index made for given queries holds only their terms, if those fit in so many bytes.
WANTED_BYTES = 32 << 20
_SLICE = 1 << 20

# Fixed values of the score, in the contract's integers.
_B_OF_100, _LENGTH_PART, _TF_PART, _SCALE = 75, 8, 1000, 1_000_000_000

_KEEP = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_TABLE = _KEEP.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))

_BLOCKS = np.dtype([("first", "<u4"), ("last", "<u4"), ("count", "<u2"), ("gap_width", "u1"), ("tf_width", "u1"),
                    ("tf", "<u4"), ("length", "<i8"), ("at", "<u8")])

SEGMENTS = StructType([
    StructField("docs", LongType()), StructField("length", LongType()), StructField("ids", BinaryType()),
    StructField("named", BinaryType()), StructField("lengths", BinaryType()), StructField("terms", ArrayType(BinaryType())),
    StructField("df", ArrayType(LongType())), StructField("firsts", BinaryType()), StructField("blocks", BinaryType()),
    StructField("postings", BinaryType())])
_HITS = StructType([StructField("asked", LongType()), StructField("doc_id", LongType()), StructField("score", LongType())])
_RANKED = StructType([StructField("item_id", LongType()), StructField("rank", IntegerType()), *_HITS.fields[1:]])


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, some at a time, so that a text of any length takes little memory."""
    text, pos = text.translate(_TABLE), 0
    while pos < len(text):
        end = len(text) if pos + _SLICE >= len(text) else text.find(b" ", pos + _SLICE)
        end = len(text) if end < 0 else end
        yield text[pos:end].split()
        pos = end


# -- index -----------------------------------------------------------------------------

class _Segment:
    """Collects documents and packs them into one row."""

    def __init__(self, wanted: dict[bytes, int] | None):
        self.wanted = wanted
        self.terms: dict[bytes, int] = dict(wanted or {})
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.numbers: list[np.ndarray] = []
        self.owner: list[int] = []
        self.bytes = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        number = self.terms.get if self.wanted is not None else lambda t, _: self.terms.setdefault(t, len(self.terms))
        total = 0
        for run in terms_of(text):
            total += len(run)
            found = np.fromiter((number(t, -1) for t in run), np.int32, len(run))
            self.numbers.append(found[found >= 0])
            self.owner.append(len(self.ids))
        self.bytes += len(text)
        if total:
            self.ids.append(doc_id)
            self.lengths.append(total)
        elif self.owner and self.owner[-1] == len(self.ids):
            self.numbers.pop()  # only separators: not a document of the collection
            self.owner.pop()

    def full(self) -> bool:
        return self.bytes >= SEGMENT_BYTES or len(self.ids) >= SEGMENT_DOCS

    def row(self) -> list:
        lengths = np.array(self.lengths, np.int64)
        order = np.argsort(lengths, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lengths = lengths[order]
        number = np.concatenate(self.numbers) if self.numbers else np.empty(0, np.int32)
        owner = np.repeat(place[np.array(self.owner, np.int64)], [len(n) for n in self.numbers]) if self.numbers else place[:0]
        key, tf = np.unique(number.astype(np.int64) * max(len(order), 1) + owner, return_counts=True)
        term, doc = np.divmod(key, max(len(order), 1))
        present, start, df = np.unique(term, return_index=True, return_counts=True)
        within = np.arange(len(term)) - np.repeat(start, df)
        begin = np.flatnonzero(within % BLOCK == 0)
        end = np.append(begin[1:], len(term))
        blocks = np.zeros(len(begin), _BLOCKS)
        data = []
        if len(begin):
            gaps = np.diff(doc, prepend=doc[:1])
            gaps[begin] = 0
            blocks["first"], blocks["last"], blocks["count"] = doc[begin], doc[end - 1], end - begin
            blocks["tf"] = np.maximum.reduceat(tf, begin)
            blocks["length"] = np.minimum.reduceat(lengths[doc], begin)
            for name, values in (("gap_width", np.maximum.reduceat(gaps, begin)), ("tf_width", blocks["tf"])):
                blocks[name] = np.select([values < 1 << 8, values < 1 << 16], [1, 2], 4)
            blocks["at"] = np.concatenate([[0], np.cumsum(
                blocks["count"] * (blocks["gap_width"].astype(np.int64) + blocks["tf_width"]))[:-1]])
            for b, (s, e) in enumerate(zip(begin.tolist(), end.tolist())):
                data.append(gaps[s:e].astype(f"<u{blocks['gap_width'][b]}").tobytes())
                data.append(tf[s:e].astype(f"<u{blocks['tf_width'][b]}").tobytes())
        names = list(self.terms)
        ids = [self.ids[i] for i in order.tolist()]
        return [len(ids), int(lengths.sum()), np.array([i or 0 for i in ids], "<i8").tobytes(),
                bytes(i is not None for i in ids), lengths.astype("<i8").tobytes(), [names[t] for t in present.tolist()],
                df.tolist(), np.searchsorted(begin, np.append(start, len(term))).astype("<i8").tobytes(),
                blocks.tobytes(), b"".join(data)]


def build_index(docs: DataFrame, wanted: list[bytes] | None = None, text: str = "text") -> DataFrame:
    """Segments of all documents, settled; with postings of the terms `wanted` only, where they are named."""
    spark = docs.sparkSession
    ship_package(spark)
    arrow = to_arrow_schema(SEGMENTS)
    numbers = None if wanted is None else spark.sparkContext.broadcast({t: i for i, t in enumerate(wanted)})

    def pack(segment: _Segment) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(segment.row(), arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = None if numbers is None else numbers.value
        segment = _Segment(chosen)
        for batch in batches:
            for part in chunks(batch, 1):
                for doc_id, body in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
                    if body:
                        segment.add(doc_id, body)
                    if segment.full():
                        yield pack(segment)
                        segment = _Segment(chosen)
        if segment.ids:
            yield pack(segment)

    rows = docs.select(F.col("`doc_id`").cast("long"), F.col(f"`{text}`").cast("string"))
    return settle(rows.mapInArrow(run, SEGMENTS), "segments")


# -- search ----------------------------------------------------------------------------

def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class _Reader:
    """One segment under the corpus's statistics; a block is decompressed at most once."""

    def __init__(self, row: dict, documents: int, total: int, asked: set[bytes]):
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.named = np.frombuffer(row["named"], np.uint8).astype(bool)
        self.m = 100 - _B_OF_100 + _B_OF_100 * np.frombuffer(row["lengths"], "<i8") * documents // total
        self.terms = {t: i for i, t in enumerate(row["terms"]) if t in asked}
        self.firsts = np.frombuffer(row["firsts"], "<i8")
        self.blocks = np.frombuffer(row["blocks"], _BLOCKS)
        self.postings = row["postings"]
        shortest = 100 - _B_OF_100 + _B_OF_100 * self.blocks["length"] * documents // total
        #: No posting of a block contributes more, before the term's weight.
        self.bounds = self.impact(self.blocks["tf"].astype(np.int64), shortest)
        self.lasts = self.blocks["last"].astype(np.int64)
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @staticmethod
    def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return _SCALE * tf // (_TF_PART * tf + _LENGTH_PART * m)

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and contributions of a block."""
        if b not in self.held:
            head = self.blocks[b]
            count, gap, width, at = int(head["count"]), int(head["gap_width"]), int(head["tf_width"]), int(head["at"])
            docs = np.frombuffer(self.postings, f"<u{gap}", count, at).cumsum(dtype=np.int64) + int(head["first"])
            tf = np.frombuffer(self.postings, f"<u{width}", count, at + count * gap).astype(np.int64)
            self.held[b] = docs, self.impact(tf, self.m[docs])
        return self.held[b]

    def postings_of(self, blocks: range | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        read = [self.block(int(b)) for b in blocks]
        return np.concatenate([d for d, _ in read]), np.concatenate([i for _, i in read])

    def best(self, query: dict[bytes, int], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the best `k`, with their scores; `least` is the k-th score so far.

        `query` gives each term's weight times its repeats.
        """
        lists = []
        for term, factor in query.items():
            if factor > 0 and term in self.terms:
                a, z = self.firsts[self.terms[term]:self.terms[term] + 2].tolist()
                lists.append((int(self.bounds[a:z].max()) * factor, factor, a, z))
        lists.sort()
        below = np.cumsum([0] + [bound for bound, *_ in lists])  # bounds of the lists before each
        essential = int(np.searchsorted(below[1:], least, "left"))
        scores = np.zeros(len(self.ids), np.int64)
        for _, factor, a, z in lists[essential:]:
            docs, impact = self.postings_of(range(a, z))
            scores[docs] += factor * impact
        docs = np.flatnonzero(scores)
        scores = scores[docs]
        for j in range(essential - 1, -1, -1):
            least = max(least, _kth(scores, k))
            near = scores + below[j + 1] >= least
            docs, scores = docs[near], scores[near]
            if not len(docs):
                break
            _, factor, a, z = lists[j]
            at = a + np.searchsorted(self.lasts[a:z], docs)
            inside = at < z
            inside[inside] = self.blocks["first"][at[inside]] <= docs[inside]
            bound = np.zeros(len(docs), np.int64)
            bound[inside] = self.bounds[at[inside]] * factor
            near = scores + bound + below[j] >= least
            docs, scores, at, inside = docs[near], scores[near], at[near & inside], inside[near]
            if len(at):
                held, impact = self.postings_of(np.unique(at))
                place = np.minimum(np.searchsorted(held, docs), len(held) - 1)
                hit = inside & (held[place] == docs)
                scores[hit] += factor * impact[place[hit]]
        return docs, scores


def _kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


class _Heap:
    """The best `k` rows seen, by score, then by id with null last."""

    def __init__(self, k: int):
        self.k = k
        self.rows = (np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))

    def least(self) -> int:
        return int(self.rows[2][-1]) if len(self.rows[2]) == self.k else 0

    def add(self, ids: np.ndarray, named: np.ndarray, scores: np.ndarray) -> None:
        ids, named, scores = (np.concatenate(p) for p in zip(self.rows, (ids, named, scores)))
        first = np.lexsort((ids, ~named, -scores))[:self.k]
        self.rows = ids[first], named[first], scores[first]


def search(index: DataFrame, queries: list[dict[bytes, int]], k: int) -> DataFrame:
    """(asked, doc_id, score): rows among which are the best `k` of each query, at most `k` of it from a task.

    `queries` give each term's repeats; `asked` is a query's place in the list.
    """
    spark = index.sparkSession
    ship_package(spark)
    terms = sorted({t for q in queries for t in q})
    asked = spark.createDataFrame([(bytearray(t),) for t in terms], StructType([StructField("term", BinaryType())]))
    documents, total = index.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    held = index.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), "t.df")
    # Bounded: no more rows than terms in a block of queries.
    counts = held.join(F.broadcast(asked), "term").groupBy("term").agg(F.sum("df").alias("df")).collect()
    weights = {bytes(r["term"]): weight(documents, r["df"]) for r in counts}
    plans = spark.sparkContext.broadcast([{t: weights[t] * n for t, n in q.items() if t in weights} for q in queries])
    arrow = to_arrow_schema(_HITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = {t for q in plans.value for t in q}
        heaps = [_Heap(k) for _ in plans.value]
        for batch in batches:
            for i in range(batch.num_rows):
                reader = _Reader(batch.slice(i, 1).to_pylist()[0], documents, total, wanted)
                for query, heap in zip(plans.value, heaps):
                    docs, scores = reader.best(query, k, heap.least())
                    if len(docs):
                        heap.add(reader.ids[docs], reader.named[docs], scores)
        for q, heap in enumerate(heaps):
            ids, named, scores = heap.rows
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(ids), pa.int64()), pa.array(ids, mask=~named),
                                                  pa.array(scores)], schema=arrow)

    return index.mapInArrow(run, _HITS)


def _query_blocks(queries: DataFrame) -> Iterator[tuple[list[int | None], list[dict[bytes, int]]]]:
    """Item ids and terms of the query rows that have terms, as many at once as `QUERY_BYTES` allows."""
    ids, terms, size = [], [], 0
    for row in queries.toLocalIterator():
        counted = Counter(t for run in terms_of((row["text"] or "").encode()) for t in run)
        if counted:
            ids.append(row["item_id"])
            terms.append(dict(counted))
            size += sum(len(t) + 64 for t in counted)
        if size >= QUERY_BYTES:
            yield ids, terms
            ids, terms, size = [], [], 0
    if ids:
        yield ids, terms


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` best documents of every row of `items` (item_id, text)."""
    queries = items.select(F.col("`item_id`").cast("long"), F.col("`text`").cast("string"))
    wanted: set[bytes] | None = set()
    for _, terms in _query_blocks(queries):
        wanted.update(t for q in terms for t in q)
        if sum(len(t) + 64 for t in wanted) > WANTED_BYTES:
            wanted = None  # too many to name: all terms are indexed
            break
    index = build_index(docs, None if wanted is None else sorted(wanted), text)
    answers = [_answer(index, ids, terms, k) for ids, terms in _query_blocks(queries)]
    if len(answers) > 1:
        answers = [settle(a, "answers") for a in answers]
    if not answers:
        return docs.sparkSession.createDataFrame([], _RANKED)
    return reduce(DataFrame.unionByName, answers)


def _answer(index: DataFrame, ids: list[int | None], terms: list[dict[bytes, int]], k: int) -> DataFrame:
    """The rows of one block of queries; equal queries are scored once."""
    spark = index.sparkSession
    distinct: dict[tuple, int] = {}
    place = [distinct.setdefault(tuple(sorted(q.items())), len(distinct)) for q in terms]
    rows = spark.createDataFrame([(a, row, i) for row, (a, i) in enumerate(zip(place, ids))],
                                 StructType([StructField(c, LongType()) for c in ("asked", "row", "item_id")]))
    hits = search(index, [dict(q) for q in distinct], k)
    order = Window.partitionBy("asked").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # Bounded: as many rows as the block has queries.
    return best.join(F.broadcast(rows), "asked").select("item_id", "rank", "doc_id", "score")
