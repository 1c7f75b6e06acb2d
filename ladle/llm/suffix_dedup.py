"""Removal of repeated byte strings by a sampled suffix array.

Every string of `LENGTH` bytes holds an anchor: the least-hashed of its k-mers, the leftmost of ties.
Equal strings have their anchor at the same place, so only the suffixes that start at anchors are sorted,
about one in 36 bytes. An anchor owns the strings it is the anchor of; they start side by side, and the
bytes they cover are its stretch.

1. Suffixes are compared by tokens: the k-mer at the anchor, then the whole stretch, each as a 64-bit
   fingerprint, then the place. Sampled splitters range-partition them by these leading tokens, so equal
   suffixes, however many, spread over as many buckets as they fill. A bucket sorts by multikey quicksort:
   each round orders only what the tokens so far leave tied. Within a run of equal stretches all but the
   first are repeats. A k-mer alone repeats nothing, and is dropped.
2. Where one k-mer has different stretches, their strings may agree in part. Each distinct stretch goes on
   once, with its bytes, to a second sort: now every start of a string in it is a suffix, compared byte
   for byte in tokens of eight bytes.
3. The first and the last run of a bucket may go on in its neighbours. They are not decided there: the
   runs' first members are compared across the boundaries, by key. Stretches are cut into blocks of
   `BLOCKED` strings for that. A block is compared only with those that share the bytes that all its
   strings share, so of a passage that very many texts hold only the blocks at its ends are looked into.

Texts meet the found places by document, once for the stretches and once for the result.

Defined results: a null text is an empty one; texts shorter than `LENGTH` lose nothing; null ids come
first; rows that share an id count as one document, so of their strings the earliest start stays, and of
rows alike in all neither loses anything to the other; other columns of the input are not looked at; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ladle.llm.mapping import map_texts
from ladle.session import settle, ship_package

LENGTH = 100
KMER = 32
REACH = LENGTH - KMER + 1  # k-mers of a string
#: Bytes that anchors are looked for in at once; a longer text is taken in such blocks.
BLOCK = 1 << 20
BLOCKED = 8
_FIRST = -(1 << 63)  # stands for a null id

#: Text that a bucket of suffixes stands for, on average; more text gives more buckets.
BUCKET_BYTES = 64 << 20

# A place in one number: start of the first string, strings - 1, anchor - start. Beside it go the document and `body`, a
# hash of its text: together they tell rows apart that share an id.
_START, _MORE = 16, 8


def _place(start, more, anchor=0):
    return start << _START | more << _MORE | anchor


# -- Fingerprints ---------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_BYTE = np.random.default_rng(100).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: list[np.ndarray] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def anchors(parts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Anchors of the strings inside each part: part, first start, last start, anchor, and the tokens."""
    size = np.array([len(p) for p in parts])
    buffer = np.frombuffer(b"".join(parts), np.uint8)
    n = len(buffer)
    starts = n - LENGTH + 1
    if starts <= 0:
        return tuple(np.empty(0, np.int64) for _ in range(6))
    power, inverse = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[buffer] * power[:n], out=sums[1:])
    hashes = _mixed((sums[KMER:] - sums[:-KMER]) * inverse[:n - KMER + 1])

    def least(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.where(hashes[y] < hashes[x], y, x)

    best, reach = np.arange(len(hashes), dtype=np.int32), 1
    while reach * 2 <= REACH:
        best = least(best[:-reach], best[reach:])
        reach *= 2
    best = least(best[:len(best) - (REACH - reach)], best[REACH - reach:])

    ends = np.cumsum(size)
    part = np.repeat(np.arange(len(parts)), size)[:starts]
    start = np.flatnonzero(np.arange(starts) + LENGTH <= ends[part])
    if not len(start):
        return tuple(np.empty(0, np.int64) for _ in range(6))
    anchor = best[start].astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (part[start[1:]] != part[start[:-1]])]))
    first, last = start[new], start[np.append(new[1:], len(start)) - 1]
    anchor, part = anchor[new], part[start[new]]
    stretch = (sums[last + LENGTH] - sums[first]) * inverse[first]
    shape = ((anchor - first) << 8 | (last - first)).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    origin = (ends - size)[part]
    return (part, first - origin, last - origin, anchor - origin, hashes[anchor].view(np.int64),
            _mixed(stretch ^ shape).view(np.int64))


_SUFFIXES = StructType([StructField(c, LongType()) for c in ("kmer", "stretch", "doc", "body", "at")])


def _suffixes(docs: DataFrame) -> DataFrame:
    def blocks(texts: list) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
        """Parts of about one block: row, offset and bytes."""
        rows, offsets, parts, held = [], [], [], 0
        for row, t in enumerate(texts):
            raw = (t or "").encode()
            if len(raw) < LENGTH:
                continue
            for at in range(0, len(raw) - LENGTH + 1, BLOCK):
                part = raw[at:at + BLOCK + LENGTH - 1]
                if held and held + len(part) > BLOCK:
                    yield rows, offsets, parts
                    rows, offsets, parts, held = [], [], [], 0
                rows.append(row), offsets.append(at), parts.append(part)
                held += len(part)
        if parts:
            yield rows, offsets, parts

    def kernel(ids: list, bodies: list, texts: list) -> list:
        out: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in _SUFFIXES]
        doc, body = np.array(ids, np.int64), np.array(bodies, np.int64)
        for rows, offsets, parts in blocks(texts):
            part, first, last, anchor, kmer, stretch = anchors(parts)
            place, row = _place(first + np.array(offsets)[part], last - first, anchor - first), np.array(rows)[part]
            for column, values in zip(out, (kmer, stretch, doc[row], body[row], place), strict=True):
                column.append(values)
        return [np.concatenate(c) for c in out]

    return map_texts(docs, kernel, _SUFFIXES, keep=("doc", "body"))


# -- Sorting --------------------------------------------------------------------------

def multikey_sort(tokens: list[Callable[[np.ndarray], np.ndarray]], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of n rows by their tokens, and the number of each sorted row's run of equal rows.

    `tokens[i](rows)` gives the i-th token of some rows; it is asked only for rows still tied.
    """
    order, run = np.arange(n), np.zeros(n, np.int64)
    for token in tokens:
        counts = np.bincount(run, minlength=1)
        tied = np.flatnonzero(counts[run] > 1)
        if not len(tied):
            break
        value = token(order[tied])
        sub = np.lexsort((value, run[tied])) if run[tied[0]] != run[tied[-1]] else np.argsort(value, kind="stable")
        order[tied] = order[tied][sub]
        value, within = value[sub], run[tied]
        new = np.zeros(n, bool)
        new[0] = True
        new[1:] = run[1:] != run[:-1]
        new[tied[1:][(value[1:] != value[:-1]) & (within[1:] == within[:-1])]] = True
        run = np.cumsum(new) - 1
    return order, run


def _starts(run: np.ndarray) -> np.ndarray:
    """For each row, the row its run starts with."""
    new = np.concatenate([[True], run[1:] != run[:-1]])
    return np.flatnonzero(new)[np.cumsum(new) - 1]


DUPLICATE, DIFFERENT, EDGE = 0, 1, 2
_SORTED = StructType([StructField("kind", LongType()), *_SUFFIXES])


def _gathered(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held) if held else None


def _sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket: repeats; distinct stretches of k-mers that have several; and what its edges hold."""
    table = _gathered(batches)
    if table is None:
        return
    columns = [c.to_numpy() for c in table.columns]
    order, _ = multikey_sort([lambda rows, c=c: c[rows] for c in (*columns[:3], columns[4])], len(table))
    kmer, stretch, doc, body, at = (c[order] for c in columns)
    new_kmer = np.concatenate([[True], kmer[1:] != kmer[:-1]])
    new = new_kmer | np.concatenate([[True], stretch[1:] != stretch[:-1]])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    repeat = (doc != doc[first]) | (at >> _START != at[first] >> _START)
    group = np.cumsum(new_kmer) - 1
    edge = (group == 0) | (group == group[-1])
    several = np.bincount(group, new)[group] > 1
    kinds = ((DUPLICATE, repeat), (DIFFERENT, new & several & ~edge), (EDGE, new & edge))
    for kind, rows in kinds:
        if rows.any():
            values = [c[rows] for c in (kmer, stretch, doc, body, at)]
            if kind == DUPLICATE:  # only the place is needed
                values[0] = values[1] = np.zeros(len(values[2]), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(values[0]), kind)), *map(pa.array, values)], names=_SORTED.names)


def _across(edges: DataFrame, *key: str) -> DataFrame:
    """Runs that several buckets hold a part of, put together: all places, and the `first` of them.

    A bucket gives a run a row, or one for each 20,000 stretches at its edges: an array holds at most
    a few times as many places as there are buckets.
    """
    raw = [F.min("bytes").alias("bytes")] if "bytes" in edges.columns else []
    return (edges.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("doc", "at", "body"))).alias("places"), *raw)
            .withColumn("first", F.col("places")[0]))


def _later(runs: DataFrame) -> DataFrame:
    """Places of a run that come after its first."""
    start = lambda c: F.shiftright(c, _START)
    return (runs.where(F.size("places") > 1).select("first", F.explode("places").alias("p"))
            .where((F.col("p.doc") != F.col("first.doc")) | (start(F.col("p.at")) != start(F.col("first.at"))))
            .select("p.doc", "p.body", "p.at"))


# -- Stretches ------------------------------------------------------------------------

_STRETCHES = StructType([*_SUFFIXES, StructField("bytes", BinaryType())])


def _packed(docs: DataFrame) -> DataFrame:
    """(doc, body, doc_id, packed): texts as compressed bytes, as they are moved."""
    schema = StructType([StructField(c, LongType()) for c in ("doc", "body", "doc_id")] + [StructField("packed", BinaryType())])

    def kernel(doc: list, bodies: list, ids: list, texts: list) -> list:
        from zstandard import ZstdCompressor

        pack = ZstdCompressor(level=3).compress
        return [doc, bodies, ids, [pack((t or "").encode()) for t in texts]]

    return map_texts(docs, kernel, schema, keep=("doc", "body", "doc_id"))


def _unpack(packed: bytes) -> bytes:
    from zstandard import ZstdDecompressor

    return ZstdDecompressor().decompress(packed)


def _with_bytes(places: DataFrame, docs: DataFrame) -> DataFrame:
    """Stretches with their bytes. A text's places are gathered before it is met."""
    asked = places.groupBy("doc", "body").agg(F.collect_list(F.struct("kmer", "stretch", "at")).alias("asked"))
    both = _packed(docs).drop("doc_id").join(asked, ["doc", "body"]).select("doc", "body", "packed", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, body, packed, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = _unpack(packed)
                rows = [(a["kmer"], a["stretch"], doc, body, a["at"], raw[s:s + (a["at"] >> _MORE & 0xFF) + LENGTH])
                        for a in asked for s in (a["at"] >> _START,)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in list(zip(*rows, strict=True))[:5]),
                     pa.array([r[5] for r in rows], pa.binary())], names=_STRETCHES.names)

    return both.mapInArrow(run, _STRETCHES)


_STRINGS = StructType([StructField("kind", LongType()), *_STRETCHES])


def _rows(kind: int, *columns: np.ndarray, raw: list[bytes] | None = None) -> pa.RecordBatch:
    n = len(columns[-1])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, kind)), *(pa.array(c) for c in columns),
         pa.array(raw, pa.binary()) if raw else pa.nulls(n, pa.binary())], names=_STRINGS.names)


def _sort_strings(batches: Iterator[pa.RecordBatch], blocks: bool) -> Iterator[pa.RecordBatch]:
    """A bucket of stretches: every string in them sorted byte for byte within its k-mer.

    What the bucket's edges hold is given on as `blocks`, or else as single strings.
    """
    table = _gathered(batches)
    if table is None:
        return
    kmer, _, doc, body, at = (c.to_numpy() for c in table.columns[:5])
    raw = b"".join(table.column(5).to_pylist())
    # Eight bytes from any place, as one number that compares as they do.
    buffer = np.frombuffer(raw + bytes(8), np.uint8)
    word = np.zeros(len(buffer) - 8, np.uint64)
    for i in range(8):
        word = word << np.uint64(8) | buffer[i:len(word) + i]
    more, anchor = at >> _MORE & 0xFF, at & 0xFF
    base = np.concatenate([[0], np.cumsum(more + LENGTH)])[:-1]
    of = np.repeat(np.arange(len(at)), more + 1)  # the stretch of each string
    nth = np.arange(len(of)) - np.repeat(np.cumsum(more + 1) - (more + 1), more + 1)
    place = base[of] + nth
    start = (at >> _START)[of] + nth
    tokens = [lambda rows: kmer[of[rows]]]
    tokens += [lambda rows, i=i: word[place[rows] + i] for i in (*range(0, LENGTH - 8, 8), LENGTH - 8)]
    order, run = multikey_sort(tokens, len(of))
    # Of equal strings the first document's first start leads.
    order = order[np.lexsort((start[order], doc[of[order]], run))]
    of, start, place = of[order], start[order], place[order]
    first = _starts(run)
    repeat = (doc[of] != doc[of[first]]) | (start != start[first])

    rows = np.flatnonzero(repeat)
    rows = rows[np.lexsort((start[rows], of[rows]))]
    if len(rows):  # starts side by side in one stretch are one place
        cut = np.flatnonzero(np.concatenate(
            [[True], (of[rows[1:]] != of[rows[:-1]]) | (start[rows[1:]] != start[rows[:-1]] + 1)]))
        head = rows[cut]
        none = np.zeros(len(head), np.int64)
        yield _rows(DUPLICATE, none, none, doc[of[head]], body[of[head]],
                    _place(start[head], np.diff(np.append(cut, len(rows))) - 1))
    edge = (kmer == kmer.min()) | (kmer == kmer.max())
    if blocks:
        yield from _edge_blocks(raw, base, doc, body, at >> _START, more, anchor, np.flatnonzero(edge))
    else:
        rows = np.flatnonzero(edge[of] & (first == np.arange(len(of))))
        for some in np.array_split(rows, len(rows) // 100_000 + 1) if len(rows) else ():
            digest = _digests(raw, place[some], place[some] + LENGTH)
            yield _rows(EDGE, digest[:, 1], digest[:, 0], doc[of[some]], body[of[some]], _place(start[some], 0))


def _digests(raw: bytes, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128-bit hashes of stretches of bytes, as two numbers."""
    from xxhash import xxh3_128_intdigest

    return np.frombuffer(b"".join(xxh3_128_intdigest(raw[a:b]).to_bytes(16, "little")
                                  for a, b in zip(begin.tolist(), end.tolist())), np.int64).reshape(-1, 2)


def _edge_blocks(raw, base, doc, body, start, more, anchor, rows) -> Iterator[pa.RecordBatch]:
    """The distinct blocks of some stretches, by the bytes that all strings of a block share.

    Blocks are cut by distance from the anchor, so equal strings lie in blocks that share those bytes.
    """
    for some in np.array_split(rows, len(rows) // 20_000 + 1) if len(rows) else ():
        highest, lowest = anchor[some] // BLOCKED, (anchor[some] - more[some]) // BLOCKED
        times = highest - lowest + 1
        of = np.repeat(some, times)
        block = np.repeat(highest, times) - (np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times))
        # Starts of the block, counted from the stretch's first one.
        low = np.maximum(0, anchor[of] - (block * BLOCKED + BLOCKED - 1))
        high = np.minimum(more[of], anchor[of] - block * BLOCKED)
        shared = base[of] + anchor[of] - block * BLOCKED
        core = _digests(raw, shared, shared + LENGTH - BLOCKED + 1)[:, 0]
        full = _digests(raw, base[of] + low, base[of] + high + LENGTH)[:, 0] ^ _mixed(
            ((anchor[of] - low) << 8 | (high - low)).astype(np.uint64)).view(np.int64)
        at = _place(start[of] + low, high - low, anchor[of] - low)
        order = np.lexsort((at, doc[of], full, core))
        new = np.concatenate([[True], (core[order[1:]] != core[order[:-1]]) | (full[order[1:]] != full[order[:-1]])])
        one = order[new]
        begin = base[of[one]] + low[one]
        yield _rows(EDGE, core[one], full[one], doc[of[one]], body[of[one]], at[one], raw=[
            raw[a:b] for a, b in zip(begin.tolist(), (begin + high[one] - low[one] + LENGTH).tolist())])


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, body, at): places of strings that occur earlier; `docs` has doc, body, doc_id and text."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)

    def ranged(df: DataFrame) -> DataFrame:
        return df.repartitionByRange(parts, "kmer", "stretch", "doc", "at")

    found = settle(ranged(_suffixes(docs)).mapInArrow(_sort_suffixes, _SORTED), "suffixes")
    runs = _across(found.where(f"kind = {EDGE}"), "kmer", "stretch")
    # At most two k-mers of a bucket stand at its edges: few, whatever the corpus.
    several = runs.groupBy("kmer").count().where("count > 1").select("kmer")
    different = (found.where(f"kind = {DIFFERENT}").drop("kind").unionByName(
        runs.join(F.broadcast(several), "kmer").select("kmer", "stretch", "first.doc", "first.body", "first.at")))
    strings = settle(ranged(_with_bytes(different, docs)).mapInArrow(
        lambda batches: _sort_strings(batches, True), _STRINGS), "strings")
    blocks = _across(strings.where(f"kind = {EDGE}"), "kmer", "stretch")
    alike = blocks.groupBy("kmer").count().where("count > 1").select("kmer")
    within = settle(ranged(blocks.join(alike, "kmer").select("kmer", "stretch", "first.doc", "first.body", "first.at", "bytes"))
                    .mapInArrow(lambda batches: _sort_strings(batches, False), _STRINGS), "blocks")
    single = _across(within.where(f"kind = {EDGE}").drop("bytes"), "kmer", "stretch")
    places = [_later(runs), _later(blocks), _later(single)]
    places += [df.where(f"kind = {DUPLICATE}").select("doc", "body", "at") for df in (found, strings, within)]
    return reduce(DataFrame.unionByName, places)


def merged(at: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of bytes (end exclusive) that the strings at these places cover."""
    start = np.sort(at >> _START << 8 | (at >> _MORE & 0xFF))
    out: list[tuple[int, int]] = []
    for a, b in zip((start >> 8).tolist(), ((start >> 8) + (start & 0xFF) + LENGTH).tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _prepared(docs: DataFrame, text: str, id: str) -> DataFrame:
    doc_id = F.col(f"`{id}`").cast("long")
    body = F.col(f"`{text}`").cast("string")
    return docs.select(F.coalesce(doc_id, F.lit(_FIRST)).alias("doc"), F.xxhash64(F.coalesce(body, F.lit(""))).alias("body"),
                       doc_id.alias("doc_id"), body.alias("text"))


def kept_bytes(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): the bytes that stay, and the removed runs."""
    ship_package(docs.sparkSession)
    docs = _prepared(docs, text, id)
    # Rows alike in id and text share their places, however many they are.
    places = repeats(docs).groupBy("doc", "body").agg(F.collect_set("at").alias("places"))
    both = _packed(docs).join(places, ["doc", "body"], "left").select("doc_id", "packed", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                raw = _unpack(one.column(1)[0].as_py())
                spans = []
                if one.column(2)[0].is_valid:
                    spans = merged(one.column(2)[0].values.to_numpy())
                kept, done = [], 0
                for a, b in spans:
                    kept.append(raw[done:a])
                    done = b
                kept.append(raw[done:])
                yield pa.RecordBatch.from_arrays(
                    [one.column(0), pa.array([len(raw)]), pa.array([sum(b - a for a, b in spans)]),
                     pa.array([[{"start": a, "end": b} for a, b in spans]], _SPANS), pa.array([b"".join(kept)])],
                    names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def suffix_dedup(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return kept_bytes(docs, text, id).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
