"""Benchmark decontamination by spaced-seed hashing.

A seed is the hash of the tokens that a fixed mask selects from a short stretch; the positions it leaves
out may differ. Seeds of the benchmark and of the documents are joined, and around every hit the two
texts are compared token by token without gaps: an overlap is a stretch of `WINDOW` tokens (or the whole
of a shorter item) with at most a fifth of them substituted, an item of `SHORTEST` to `LEAST` - 1 tokens as it is:
of these, all tokens are the seed.

Documents read a bit map of the benchmark's seeds, of a fixed size whatever the benchmark, to leave out
positions that cannot join. What passes goes on as regions: runs of hits with their surroundings, as
hashes of tokens. Texts are read once and never shuffled.

Defined results: a null text has no tokens; an item of fewer than `SHORTEST` tokens is too short to
tell and matches nothing; rows alike in doc_id and text share a result; null ids are compared like any other; other
columns of either table are not looked at; an empty benchmark or table contaminates nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from ladle.llm.mapping import body_hash, map_texts, unused
from ladle.operators.sizing import small
from ladle.session import settle

#: Tokens at 1 are hashed, those at 0 may be substituted. However the substitutions lie that an overlap of 8 to 16
#: tokens may have, one of these fits between them; no set of up to six masks of six tokens does that.
MASKS = ("11011001", "11000111", "10111010", "00111011")
SPAN = len(MASKS[0])
LEAST = SPAN
#: Shorter items match only as a whole and without substitutions; still shorter ones are common phrases.
SHORTEST = 4
WINDOW = 16
#: Tokens compared at once when a hit is verified, of either side.
TILE = 1024
#: Substituted tokens allowed in an overlap, as one of so many.
ONE_IN = 5
#: Bits of the map that documents are filtered with.
FILTER_BITS = 1 << 26
#: Tokens kept around a run of hits, and the gap between hits that ends a run.
AROUND, GAP = WINDOW, 2 * WINDOW

_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Characters of scripts without spaces between words (Thai, Lao, Tibetan, Burmese, Khmer, kana, Han, Yi), and their
#: punctuation.
_SPACELESS = re.compile(
    "([\u0e01-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf"
    "\u4e00-\ua4cf\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff])"
    "|[\u3000-\u3004\u3008-\u301f\uff01-\uff0f\uff1a-\uff20\uff5b-\uff65]")
_REMEMBERED = 300_000
_known: dict[bytes, int] = {}


def token_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the lower-cased tokens: runs of letters, digits and characters beyond ASCII.

    Of scripts without spaces every character is a token.
    """
    from xxhash import xxh64_intdigest

    low = text.lower()
    if not low.isascii():
        low = _SPACELESS.sub(r" \1 ", low)
    tokens = _TOKEN.findall(low.encode())
    if len(_known) > _REMEMBERED:
        _known.clear()
    for t in set(tokens).difference(_known):
        _known[t] = xxh64_intdigest(t)
    return np.array([_known[t] for t in tokens], np.uint64)


def seeds(hashes: np.ndarray) -> np.ndarray:
    """Masks x positions. Under a mask, equal seeds stand for equal selected tokens in equal places."""
    n = len(hashes) - SPAN + 1
    if n <= 0:
        return np.empty((len(MASKS), 0), np.uint64)
    out = np.empty((len(MASKS), n), np.uint64)
    for m, mask in enumerate(MASKS):
        seed = np.full(n, 0x9E3779B97F4A7C15 * (m + 1) & 0xFFFFFFFFFFFFFFFF, np.uint64)
        for at in (i for i, bit in enumerate(mask) if bit == "1"):
            seed = (seed ^ hashes[at:at + n]) * np.uint64(0xD6E8FEB86659FD93)
            seed ^= seed >> np.uint64(32)
        out[m] = seed
    return out


def whole_seeds(hashes: np.ndarray, length: int) -> np.ndarray:
    """Seeds of all stretches of `length` tokens, none left out, for items that are no longer."""
    n = max(0, len(hashes) - length + 1)
    seed = np.full(n, 0xA24BAED4963EE407 * length & 0xFFFFFFFFFFFFFFFF, np.uint64)
    for at in range(length if n else 0):
        seed = (seed ^ hashes[at:at + n]) * np.uint64(0xD6E8FEB86659FD93)
        seed ^= seed >> np.uint64(32)
    return seed


_ITEMS = StructType([StructField("item_id", LongType()), StructField("tokens", BinaryType()),
                     StructField("seeds", ArrayType(LongType()))])
_REGIONS = StructType([StructField("doc_id", LongType()), StructField("body", LongType()), StructField("start", LongType()),
                       StructField("tokens", BinaryType()), StructField("seeds", ArrayType(LongType()))])


def _items(benchmark: DataFrame, text: str) -> DataFrame:
    def kernel(ids: list, texts: list) -> list:
        every = [token_hashes(t or "") for t in texts]
        return [ids, [h.astype(np.uint32).tobytes() for h in every],
                [np.unique(whole_seeds(h, len(h)) if SHORTEST <= len(h) < LEAST else seeds(h)).view(np.int64) for h in every]]
    return map_texts(benchmark, kernel, _ITEMS, text, ("item_id",))


def _filter(items: DataFrame) -> np.ndarray:
    """The bit map as bytes: gathered word by word, so its size is fixed."""
    words = (items.select(F.explode("seeds").alias("seed"))
             .select(F.col("seed").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("bit"))
             .select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, cast(bit & 63 as int)) as bits"))
             .groupBy("word").agg(F.bit_or("bits").alias("bits"))).toArrow()
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return table.view(np.uint8)


def _regions(docs: DataFrame, items: DataFrame, text: str) -> DataFrame:
    packed = docs.sparkSession.sparkContext.broadcast(_filter(items))
    size = F.octet_length("tokens") / 4
    # Lengths of short items, at most LEAST - SHORTEST of them.
    lengths = sorted(int(r[0]) for r in items.where((size >= SHORTEST) & (size < LEAST)).select(size).distinct().collect())

    def kernel(ids: list, bodies: list, texts: list) -> list:
        bits, rows = packed.value, []
        for doc, body, t in zip(ids, bodies, texts, strict=True):
            hashes = token_hashes(t or "")
            every = seeds(hashes)
            if lengths and len(hashes) >= lengths[0]:
                n = len(hashes) - lengths[0] + 1
                every = np.concatenate([np.pad(every, ((0, 0), (0, n - every.shape[1]))), np.stack(
                    [np.pad(w, (0, n - len(w))) for w in (whole_seeds(hashes, m) for m in lengths)])])
            place = (every & np.uint64(FILTER_BITS - 1)).astype(np.int64)
            hit = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1
            at = np.flatnonzero(hit.any(axis=0))
            if not len(at):
                continue
            short = hashes.astype(np.uint32)
            for run in np.split(at, np.flatnonzero(np.diff(at) > GAP) + 1):
                first = max(0, int(run[0]) - AROUND)
                rows.append((doc, body, first, short[first:int(run[-1]) + SPAN + AROUND].tobytes(),
                             np.unique(every[:, run][hit[:, run] == 1]).view(np.int64)))
        return list(zip(*rows, strict=True)) or [[]] * 5

    here = unused(docs, "here")
    return map_texts(docs.withColumn(here, body_hash(text)), kernel, _REGIONS, text, ("doc_id", here))


def overlaps(doc: np.ndarray, item: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of `doc` (tokens, end exclusive) that match `item` without gaps, merged.

    Both are cut into tiles that overlap by all but one of an overlap's tokens. A tile in which few tokens are equal is
    looked at by the diagonals on which they lie, one full of repeats as a whole, so memory is that of one tile and time
    at most that of comparing every token of the one with every token of the other.
    """
    size = min(WINDOW, len(item))
    if size < SHORTEST or len(doc) < size:
        return []
    allowed = size // ONE_IN if size >= LEAST else 0
    covered = np.zeros(len(doc) + 2, bool)  # with a place before the first token and one after the last
    for i in range(0, len(item) - size + 1, TILE):
        part = item[i:i + TILE + size - 1]
        for d in range(0, len(doc) - size + 1, TILE):
            beside = doc[d:d + TILE + size - 1]
            covered[d + 1:d + 1 + len(beside)] |= _tile(beside, part, size, size - allowed)
    edge = np.flatnonzero(covered[1:] != covered[:-1])
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _tile(doc: np.ndarray, item: np.ndarray, size: int, least: int) -> np.ndarray:
    """Tokens of `doc` in windows of `size` tokens that agree with the item's in `least` or more.

    Substituted tokens at the ends of a window are not part of it.
    """
    covered = np.zeros(len(doc), bool)
    order = np.argsort(item, kind="stable")
    held = item[order]
    low = np.searchsorted(held, doc, "left")
    same = np.searchsorted(held, doc, "right") - low
    if same.sum() <= 16 * TILE:
        at = np.repeat(np.arange(len(doc)), same)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(same) - same, same)
        lines, counts = np.unique(at - order[np.repeat(low, same) + nth], return_counts=True)
        lines = lines[counts >= least]
    else:
        lines = np.arange(1 - len(item), len(doc))
    # Diagonals far from each other come first: they may cover all that those between them could.
    apart = max(1, len(lines) // 64)
    for first in range(apart if len(lines) else 0):
        some = lines[first::apart]
        before = np.concatenate([[0], np.cumsum(covered)])
        begin, end = np.maximum(some, 0), np.minimum(some + len(item), len(doc))
        some = some[before[end] - before[begin] < end - begin]
        if not len(some):
            continue
        # Row n is a diagonal; column j compares the item's token j with the one that stands beside it.
        place = some[:, None] + np.arange(len(item))
        inside = (place >= 0) & (place < len(doc))
        equal = inside & (doc[np.where(inside, place, 0)] == item)
        sums = np.zeros((len(some), len(item) + 1), np.int32)
        np.cumsum(equal, axis=1, out=sums[:, 1:])
        row, j = np.nonzero((sums[:, size:] - sums[:, :-size] >= least) & inside[:, :len(item) - size + 1] & inside[:, size - 1:])
        begin, end = j.copy(), j + size
        for _ in range(size - least):
            begin += ~equal[row, begin]
            end -= ~equal[row, end - 1]
        steps = (np.bincount(some[row] + begin, minlength=len(doc) + 1) - np.bincount(some[row] + end, minlength=len(doc) + 1))
        covered |= np.cumsum(steps[:-1]) > 0
    return covered


def contaminations(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, item_id, start, end): verified overlaps, in tokens of the document, end exclusive."""
    return _found(docs, benchmark, text).drop("body")


def _found(docs: DataFrame, benchmark: DataFrame, text: str) -> DataFrame:
    """The overlaps with the hash of the text, (doc_id, body, item_id, start, end)."""
    items = settle(_items(benchmark, text).withColumn("item", F.monotonically_increasing_id()), "items")
    regions = settle(_regions(docs, items, text).withColumn("region", F.monotonically_increasing_id()), "regions")
    asked = items.select("item", F.explode("seeds").alias("seed"))
    pairs = (regions.select("region", F.explode("seeds").alias("seed")).join(asked, "seed")
             .select("region", "item").distinct())
    both = (pairs.join(regions.drop("seeds"), "region")
            .join(items.select("item", "item_id", F.col("tokens").alias("item_tokens")), "item")
            .select("doc_id", "body", "item_id", "start", "tokens", "item_tokens"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(doc, body, item, start + a, start + b)
                    for doc, body, item, start, tokens, of in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                    for a, b in overlaps(np.frombuffer(tokens, np.uint32), np.frombuffer(of, np.uint32))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in list(zip(*rows, strict=True)) or [[]] * 5],
                names=["doc_id", "body", "item_id", "start", "end"])

    return both.mapInArrow(verify, "doc_id long, body long, item_id long, start long, end long")


def decontamination(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Per document: contaminated, n_items matched, overlap_tokens (of all items), the first overlap's place."""
    found = _found(docs, benchmark, text).groupBy(F.col("doc_id").alias("of"), F.col("body").alias("__of_body")).agg(
        F.count_distinct("item_id").alias("n_items"), F.sum(F.col("end") - F.col("start")).alias("overlap_tokens"),
        F.min("start").alias("first_token"))
    found = settle(found, "contaminated")
    rows = docs.select("doc_id", body_hash(text).alias("__body"))
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("__body") == F.col("__of_body")), "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("overlap_tokens", F.lit(0)).alias("overlap_tokens"), "first_token")


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` without an overlap with the benchmark; all columns stay.

    Rows that share an id, or have none, are told apart by their text.
    """
    here, of, of_body = (unused(docs, c) for c in ("here", "of", "of_body"))
    found = settle(_found(docs, benchmark, text).select(
        F.col("doc_id").alias(of), F.col("body").alias(of_body)).distinct(), "contaminated")
    met = F.col("doc_id").eqNullSafe(F.col(of)) & (F.col(here) == F.col(of_body))
    return docs.withColumn(here, body_hash(text)).join(small(found), met, "left_anti").drop(here)
