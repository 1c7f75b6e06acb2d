"""How five filters interact: what each removes at every step of every order, per part of the corpus.

A document fails or passes each filter, so it falls in one of 2^5 cells. The cells are counted per part by Spark
(in all, good ones, toxic ones); from there on a part is a tensor of 2x2x2x2x2 and everything asked is a contraction
of it: along each axis the vector (1, 0) selects what passes, (0, 1) what fails, (1, 1) both. For a filter at its step,
the filters before it pass and those after it are free.

Defined results: a null text counts as empty (no words: A fails, B to D pass); a null part counts as ''; equal texts are
equal as bytes; a row is a copy if its text also stands under a smaller id, so rows that share the smallest id are no
copies, and neither is a row with a null id. Repeated rows count each. A document is good (toxic) if any of its
`labels` rows says 1. An empty table gives no rows. Columns of other names are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ladle.session import settle, ship_package

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)

# Parts of one Arrow batch are contracted together; each takes 600 rows.
_PARTS_AT_ONCE = 256

SCHEMA = StructType([StructField("part", StringType()), StructField("filter_order", StringType()), StructField("step", IntegerType())]
                    + [StructField(c, LongType()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost",
                                                            "toxic_lost", "shapley")])


def failures(text: Column) -> dict[str, Column]:
    """Conditions under which a text fails the filters A to D, which look at nothing but the text."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": F.size(words) < 200,
            "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
            "C": 100 * capitals.cast("long") > 2 * F.length(text).cast("long"),
            "D": text.rlike(r"[#$%&*|]")}


def cell_counts(docs: DataFrame, labels: DataFrame, part: str = "source", text: str = "text") -> DataFrame:
    """(part, cell, docs, good, toxic): documents per part and cell; bit i of `cell` is set if filter i fails."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    read = docs.select(F.col("`doc_id`").cast("long").alias("id"),
                       F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), body.alias("body"))
    bits = sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(failures(F.col("body")).values())), F.lit(0))
    # The texts are read once; a digest and four bits go on in their place.
    rows = settle(read.select("id", "part", F.unhex(F.sha2("body", 256)).alias("digest"), bits.alias("bits")), "audit")
    first = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    truth = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    # Both joins are on the id, so copies of one text, however many, spread over all tasks.
    known = (rows.where("id is not null").join(first, ["id", "digest"], "left").join(truth, "id", "left")
             .select("part", "bits", F.coalesce("first", F.lit(False)).alias("first"), "good", "toxic"))
    nameless = rows.where("id is null").select("part", "bits", F.lit(True).alias("first"), F.lit(None).cast("int").alias("good"),
                                               F.lit(None).cast("int").alias("toxic"))
    cell = F.col("bits") + F.when(F.col("first"), 0).otherwise(1 << FILTERS.index("E"))
    return (known.unionByName(nameless).groupBy("part", cell.alias("cell"))
            .agg(F.count("*").alias("docs"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
                 F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")))


def select(tensors: np.ndarray, choice: dict[str, tuple[int, int]]) -> np.ndarray:
    """Contract each filter's axis with its vector, all documents where `choice` is silent."""
    vectors = [np.array(choice.get(f, ALL), dtype=np.int64) for f in FILTERS]
    return np.einsum("pabcdek,a,b,c,d,e->pk", tensors, *vectors)


def contract(tensors: np.ndarray) -> list[dict[str, np.ndarray]]:
    """Per order and step, the asked counts of every part; `tensors` has axes part, A to E, (docs, good, toxic)."""
    fails = {f: select(tensors, {f: FAIL})[:, 0] for f in FILTERS}
    unique = {f: select(tensors, {g: FAIL if g == f else PASS for g in FILTERS})[:, 0] for f in FILTERS}
    memo: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    out = []
    for order in ORDERS:
        for step, f in enumerate(order):
            key = (f, frozenset(order[:step]))  # what came before, in whatever order
            if key not in memo:
                before = dict.fromkeys(order[:step], PASS)
                memo[key] = select(tensors, before | {f: PASS})[:, 0], select(tensors, before | {f: FAIL})
            kept, lost = memo[key]
            out.append({"filter": f, "kept": kept, "removed": lost[:, 0], "redundant": fails[f] - lost[:, 0],
                        "unique_fails": unique[f], "good_lost": lost[:, 1], "toxic_lost": lost[:, 2]})
    total = {f: sum(row["removed"] for row in out if row["filter"] == f) for f in FILTERS}
    for row in out:
        row["shapley"] = total[row["filter"]]
    return out


def filter_audit(docs: DataFrame, labels: DataFrame, part: str = "source", text: str = "text") -> DataFrame:
    """One row per part, order of the filters and step; columns as in `SCHEMA`."""
    ship_package(docs.sparkSession)
    arrow = to_arrow_schema(SCHEMA)
    # At most 32 cells a part, whatever the number of its documents.
    cells = cell_counts(docs, labels, part, text).groupBy("part").agg(
        F.collect_list(F.struct("cell", "docs", "good", "toxic")).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _PARTS_AT_ONCE):
                piece = batch.slice(start, _PARTS_AT_ONCE)
                names = piece.column(0)
                tensors = np.zeros((len(names), 32, 3), dtype=np.int64)
                for i, held in enumerate(piece.column(1).to_pylist()):
                    for c in held:
                        tensors[i, c["cell"]] = c["docs"], c["good"], c["toxic"]
                # Bit 0 of a cell varies fastest: the axes come out as E to A and are turned round.
                shaped = tensors.reshape(-1, 2, 2, 2, 2, 2, 3).transpose(0, 5, 4, 3, 2, 1, 6)
                for i, row in enumerate(contract(shaped)):
                    fixed = [names, pa.array([ORDERS[i // 5]] * len(names)), pa.array([i % 5 + 1] * len(names), pa.int32())]
                    yield pa.RecordBatch.from_arrays(fixed + [pa.array(row[c]) for c in SCHEMA.names[3:]], schema=arrow)

    return cells.mapInArrow(run, SCHEMA)
