"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Two fingerprints that differ in at most d of their 64 bits differ in at most d of their 8 bytes, so
they share at least s = 8 - d positional bytes. The index holds every distinct fingerprint under each
choice of s - 1 positions with their bytes, 56 choices for two bits. Pairs that meet in a posting are
tallied over all postings: those that share s bytes meet in s or more of them, the guaranteed minimum,
those that share only s - 1 meet in one and are rejected by their tally. What reaches the minimum is
verified bit by bit. Strangers agree in 40 given bits of a hash by chance only, one pair in 10^12.
Copies meet as one fingerprint, never as pairs.

Defined results: a null or wordless text has fingerprint zero and is linked like any other; repeated
rows are answered one by one; a component of null ids alone has a null component_id; other columns of
the input are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ladle.llm.components import components
from ladle.llm.mapping import body_hash, map_texts, unused
from ladle.operators.sizing import small
from ladle.session import settle

SEED = 42
BYTES = 8
FINGERPRINTS = StructType([StructField("doc_id", LongType()), StructField("fp", LongType())])


def fingerprint(text: bytes, width: int = 3) -> int:
    """The 64-bit majority of the shingles' hashes; repeated shingles count as often as they occur."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: lower-cases A-Z only, splits at space and \x09-\x0d
    if not words:
        return 0
    hashes = np.array([xxh64_intdigest(b" ".join(words[i:i + width]), SEED)
                       for i in range(max(1, len(words) - width + 1))], ">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, BYTES)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""
    def kernel(ids: list, texts: list) -> list:
        return [ids, np.array([fingerprint((t or "").encode(), width) for t in texts], np.uint64).view(np.int64)]
    return map_texts(docs, kernel, FINGERPRINTS, text, (id,))


def links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """(src, dst): every pair of distinct values of `fp` at `distance` or fewer differing bits, once."""
    if not 0 < distance < BYTES:
        raise ValueError("a distance of 1 to 7 bits leaves a positional byte to share")
    return (tallies(prints, distance).where(F.col("tally") >= guaranteed(distance))
            .where(F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= distance).select("src", "dst"))


def _positions(distance: int) -> list[tuple[int, ...]]:
    """Choices of positions that postings are made for: one fewer than a linked pair is sure to share."""
    return list(combinations(range(BYTES), max(1, BYTES - distance - 1)))


def guaranteed(distance: int) -> int:
    """Postings that hold both of a linked pair, at least: the choices among the positions it is sure to share."""
    return comb(BYTES - distance, len(_positions(distance)[0]))


def tallies(prints: DataFrame, distance: int) -> DataFrame:
    """(src, dst, tally): pairs that meet in the index, and the number of postings in which they do."""
    def mask(positions: tuple[int, ...]) -> int:
        bits = sum(0xFF << 8 * p for p in positions)
        return bits - (1 << 64) if bits >> 63 else bits

    postings = prints.select("fp").distinct().select("fp", F.explode(F.array(*(
        F.struct(F.lit(n).alias("positions"), F.col("fp").bitwiseAND(F.lit(mask(c))).alias("bytes"))
        for n, c in enumerate(_positions(distance))))).alias("key")).select("fp", "key.positions", "key.bytes")
    # Most postings hold one fingerprint; only the others are joined.
    met = settle(postings, "postings")
    shared = met.groupBy("positions", "bytes").count().where("count > 1").drop("count")
    some = settle(met.join(shared, ["positions", "bytes"], "left_semi"), "shared-postings")
    a, b = some.alias("a"), some.alias("b")
    return (a.join(b, (F.col("a.positions") == F.col("b.positions")) & (F.col("a.bytes") == F.col("b.bytes"))
                   & (F.col("a.fp") < F.col("b.fp")))
            .groupBy(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst")).agg(F.count("*").alias("tally")))


def simhash_components(docs: DataFrame, width: int = 3, distance: int = 2, text: str = "text",
                       id: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links)."""
    prints = settle(fingerprints(docs, width, text, id), "fingerprints")
    least = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-prints")
    roots = components(links(least, distance)).withColumnRenamed("node", "fp")
    rooted = least.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# -- One document of each group --------------------------------------------------------

_BODIED = StructType([StructField("doc_id", LongType()), StructField("body", LongType()), StructField("fp", LongType())])


def one_of_each(docs: DataFrame, width: int = 3, distance: int = 2, text: str = "text", id: str = "doc_id") -> DataFrame:
    """`docs` without near copies: of each component of linked fingerprints the row of the smallest id stays.

    Null ids come last. Rows that share an id are told apart by a hash of their text; of rows alike in id and text one
    stays. All columns of `docs` are returned.
    """
    here, of, of_body = (unused(docs, c) for c in ("here", "of", "of_body"))

    def kernel(ids: list, bodies: list, texts: list) -> list:
        return [ids, bodies, np.array([fingerprint((t or "").encode(), width) for t in texts], np.uint64).view(np.int64)]

    prints = settle(map_texts(docs.withColumn(here, body_hash(text)), kernel, _BODIED, text, (id, here)), "fingerprints")
    keys = prints.groupBy("doc_id", "body").agg(F.first("fp").alias("fp"), F.count("*").alias("times"))
    least = settle(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "body")).alias("stays")), "least")
    roots = components(links(least, distance))
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    stays = rooted.groupBy("root").agg(F.min("stays").alias("stays")).select("stays.doc_id", "stays.body")
    marked = stays.withColumn("stays", F.lit(True)).alias("s")
    same = F.col("k.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("k.body") == F.col("s.body"))
    fate = settle(keys.alias("k").join(marked, same, "left").select(
        F.col("k.doc_id").alias(of), F.col("k.body").alias(of_body), F.col("stays").isNotNull().alias("stays"),
        F.col("times")).where("not stays or times > 1"), "fates")
    bodied = docs.withColumn(here, body_hash(text))
    met = F.col(f"`{id}`").eqNullSafe(F.col(of)) & (F.col(here) == F.col(of_body))
    kept = bodied.join(small(fate.select(of, of_body)), met, "left_anti").drop(here)
    repeated = fate.where("stays").select(of, of_body)
    again = bodied.join(small(repeated), met, "left_semi").dropDuplicates([id, here]).drop(here)
    return kept.unionByName(again) if not repeated.isEmpty() else kept
