"""Run a per-document kernel inside Arrow batches, a bounded amount of text at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ladle.session import ship_package

#: Text handed to a kernel at once, in bytes; one longer text is handed over alone.
CHUNK = 4 << 20


def chunks(batch: pa.RecordBatch, column: int, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of `batch` whose text column holds about `limit` bytes; always at least one row."""
    start, held = 0, 0
    for row, text in enumerate(batch.column(column)):
        size = len(text.as_buffer()) if text.is_valid else 0
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def sliced(batches: Iterator[pa.RecordBatch], column: int, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a bounded amount of text, for functions that keep all columns."""
    for batch in batches:
        yield from chunks(batch, column, limit)


def map_texts(docs: DataFrame, kernel: Callable[..., list], schema: StructType, text: str = "text",
              keep: tuple[str, ...] = ("doc_id",), limit: int = CHUNK) -> DataFrame:
    """`kernel(*columns)` per chunk of rows, `columns` being Python lists of `keep` and the text.

    The kernel returns one list or array per field of `schema`; the number of rows may change.
    No row leaves its task: nothing is shuffled.
    """
    ship_package(docs.sparkSession)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, batch.num_columns - 1, limit):
                out = kernel(*(c.to_pylist() for c in part.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(out, arrow, strict=True)], schema=arrow)

    return docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").cast("string")).mapInArrow(run, schema)


def body_hash(text: str) -> Column:
    """A hash of the text, empty where it is null: with the id, it tells rows apart that share the id."""
    return F.xxhash64(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")))


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have in any spelling of case."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name
