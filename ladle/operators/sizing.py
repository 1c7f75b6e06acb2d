"""Broadcast only what has been measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 1_000_000
#: Text of one piece, where the work on it needs many times its memory.
PIECE_BYTES = 8 * 1024 * 1024
#: What the tasks of a write read of tables and of exchanges, and what Python gets at once: of one size, however large the
#: input is. (Tables that are read so are written in row groups of `PIECE_BYTES`, which no split divides.)
IN_PIECES = {"spark__sql__files__maxPartitionBytes": str(PIECE_BYTES), "spark__sql__adaptive__advisoryPartitionSizeInBytes": str(PIECE_BYTES),
             "spark__sql__execution__arrow__maxBytesPerBatch": str(PIECE_BYTES)}


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes; one pass with partial sums, no data moved."""
    width = F.lit(16 * len(df.columns)).cast("bigint")
    for name, kind in df.dtypes:
        if kind == "string" or kind.startswith(("array", "struct", "map")):
            text = F.col(f"`{name}`") if kind == "string" else F.to_json(F.struct(f"`{name}`"))
            width = width + F.coalesce(F.octet_length(text), F.lit(0))
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


def fits(measured: tuple[int, int], times: int = 1) -> bool:
    """True when rows and bytes, grown at most `times`-fold by a later join, may be broadcast."""
    rows, size = measured
    return rows * times <= BROADCAST_ROWS and size * times <= BROADCAST_BYTES


def fits_broadcast(df: DataFrame) -> bool:
    return fits(measure(df))


def small(df: DataFrame) -> DataFrame:
    """`df` with a broadcast hint if it fits, otherwise as it is (shuffle join, AQE skew split)."""
    return F.broadcast(df) if fits_broadcast(df) else df


#: Broadcasts of keys that one join may take.
PARTS = 4


def key_parts(keys: DataFrame, on: list[str]) -> list[DataFrame] | None:
    """`keys` in parts by hash that may each be broadcast; None if these were more than `PARTS`."""
    rows, size = measure(keys)
    parts = max(1, -(-rows // BROADCAST_ROWS), -(-size // BROADCAST_BYTES))
    if parts == 1:
        return [F.broadcast(keys)]
    parts += 1  # hashes deal unevenly
    if parts > PARTS:
        return None
    return [F.broadcast(keys.where(F.pmod(F.xxhash64(*on), F.lit(parts)) == p)) for p in range(parts)]


def without(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of `df` that have none of `keys`. `df` is not exchanged as long as a few broadcasts hold the keys."""
    for part in key_parts(keys, on) or [keys]:
        df = df.join(part, on, "left_anti")
    return df


def within(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of `df` that have one of the distinct `keys`, likewise."""
    parts = key_parts(keys, on)
    if parts is None or len(parts) == 1:
        return df.join(parts[0] if parts else keys, on, "left_semi")
    found = df
    for n, part in enumerate(parts):
        found = found.join(part.withColumn(f"_in{n}", F.lit(True)), on, "left")
    return found.where(F.coalesce(*(f"_in{n}" for n in range(len(parts))))).select(df.columns)


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan over at least as many tasks as there are cores.

    A large input has more partitions than cores and is left alone; a single big row group
    would otherwise keep heavy per-row work on one core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def piece_count(df: DataFrame, size: int = PIECE_BYTES) -> int:
    """Pieces of about `size` bytes of text, and as many as there are cores at least: one pass counts the bytes."""
    kinds = dict(df.dtypes)
    width = F.lit(16 * len(kinds)).cast("bigint")
    for name, kind in kinds.items():
        if kind in ("string", "array<string>"):
            text = F.col(f"`{name}`") if kind == "string" else F.array_join(f"`{name}`", "\n")
            width = width + F.coalesce(F.octet_length(text), F.lit(0))
    total = df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-total // size))


def pieces(df: DataFrame, *keys: str, size: int = PIECE_BYTES) -> DataFrame:
    """Rows placed by `keys` in pieces of about `size` bytes of text.

    A number left to Spark follows the cores and the compressed bytes, so that pieces would grow with the input.
    """
    return df.repartition(piece_count(df, size), *keys)
