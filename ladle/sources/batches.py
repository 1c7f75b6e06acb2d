"""Landed result batches: write, list, read, quarantine."""

from __future__ import annotations

import posixpath
import re
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.functions.values import batch_key, index_name
from ladle.operators.sizing import small
from ladle.schemas import RESULT, STATUS_CODES
from ladle.sources.objects import write_objects

#: Files that are named to a scan, at most.
FEW_FILES = 10_000


def write_batches(batches: DataFrame, path: str, source: str, clean: bool = False,
                  objects: bool = False) -> None:
    """Write batches below `path/source=<source>`, one JSON array per line.

    `objects=True` gives every batch an object of its own, `path/<source>/<key>.json`; the default packs
    many batches into one file, because an object per hundred records does not scale.
    `clean` empties the whole target first; otherwise `objects` replaces batches of the same
    key, and packed files are added under the time of their landing: of a batch landed again,
    readers let the later landing win.
    """
    if objects:
        write_objects(batches, path, source, clean)
    else:
        rows = batches.withColumn("source", F.lit(source))
        landed = F.lit(f"{time.time_ns():020d}")
        writer = rows.select("source", landed.alias("landed"), F.col("body").alias("value")).write
        writer = writer.option("partitionOverwriteMode", "static")
        writer.mode("overwrite" if clean else "append").partitionBy("source", "landed").text(path)


def _below(path: str) -> Column:
    """Path of a scanned file below the folder `path`."""
    root = posixpath.normpath(re.sub(r"^[a-z0-9]+:/*", "/", path)).lstrip("./")
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.get(F.split(plain, rf"/\Q{root}\E/", 2), F.lit(1))


def _of_files(raw: DataFrame, files: DataFrame) -> DataFrame:
    """Rows of some files. Few are named to the scan, which opens no other; of many, those older than all are skipped."""
    named = [r["path"] for r in files.select("path").limit(FEW_FILES + 1).collect()]
    if len(named) <= FEW_FILES:
        return raw.where(F.col("_metadata.file_path").isin(named))
    since = files.agg(F.min("modified")).first()[0]
    late = raw.where(F.col("_metadata.file_modification_time") >= F.lit(since))
    return late.join(small(files.select("path")), F.col("_metadata.file_path") == F.col("path"), "left_semi")


def scan_text(spark: SparkSession, path: str, whole_files: bool = False, files: DataFrame | None = None) -> DataFrame:
    """`source, file, body` of every landed file below `path`, nested folders included, or of `files(path, modified)`.

    The source is the first folder, plain or as `source=...`; a file in the root has none and
    is ignored.
    """
    raw = (spark.read.schema("value string").option("recursiveFileLookup", "true")
                .text(path, wholetext=whole_files))
    if files is not None:
        raw = _of_files(raw, files)
    folder = F.regexp_extract(_below(path), r"^([^/]+)/", 1)
    named = F.url_decode(F.replace(F.substr(folder, F.lit(len("source=") + 1)), F.lit("+"), F.lit("%2B")))
    source = F.when(folder.startswith("source="), named).otherwise(folder)
    return (raw.select(source.alias("source"), _below(path).alias("file"), F.col("value").alias("body"))
               .where((F.col("source") != "") & (F.trim("body") != "")))


def parse_batches(raw: DataFrame) -> DataFrame:
    """Add `results`, null where the text is not an array of valid records."""
    parsed = raw.withColumn("results", F.from_json("body", T.ArrayType(RESULT)))
    valid = lambda r: r["id"].isNotNull() & r["status"].isin(*STATUS_CODES)
    whole = F.coalesce(F.ltrim("body").startswith("[") & F.forall("results", valid), F.lit(False))
    return parsed.withColumn("results", F.when(whole, F.col("results")))


def quarantine(parsed: DataFrame) -> DataFrame:
    """Texts that could not be read; the load goes on without them."""
    return parsed.where(F.col("results").isNull()).select("source", "file", "body")


def batch_results(parsed: DataFrame) -> DataFrame:
    """One row per record: `source, file, batch_key, pos` and the record as `result`."""
    ids = F.transform("results", lambda r: r["id"])
    return (parsed.where(F.col("results").isNotNull())
                  .withColumn("batch_key", batch_key(F.array_min(ids), F.array_max(ids)))
                  .select("source", "file", "batch_key", F.posexplode("results").alias("pos", "result")))


def successes(results: DataFrame) -> DataFrame:
    """Recipes of successful records, with the version columns that order rewrites: batches by
    key, and landings of one batch by time."""
    landed = F.regexp_extract("file", r"(?:^|/)landed=(\d+)/", 1)
    return (results.where((F.col("result.status") == "success") & F.col("result.recipe").isNotNull())
                   .select("source", F.struct("batch_key", landed.alias("landed"), "file", "pos").alias("version"), "result.recipe.*"))


def sources(results: DataFrame) -> DataFrame:
    """Distinct sources with the index each one belongs to."""
    return results.select("source").distinct().withColumn("index_name", index_name(F.col("source")))
