"""A training corpus from `documents`: filter, deduplicate, decontaminate, redact, pack.

Each stage takes what its predecessor kept, written as Parquet and read again, and all but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ladle.llm import decontaminate, line_crf, packing, pii, simhash
from ladle.llm.catalog import tokenizer
from ladle.session import settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field predicts to be good."""
    return line_crf.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints over three-word shingles, linked at two differing bits or fewer."""
    return simhash.one_of_each(docs, width=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.redacted(docs)


def packs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2,048 tokens."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_copies", near_copies), ("decontamination", decontamination),
          ("redaction", redaction), ("packs", packs)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the `documents` of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs


#: The stages are learnt, approximate or use a vocabulary: SQL cannot express them.
ORACLE_SQL: str | None = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
