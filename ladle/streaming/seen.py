"""Seen URLs as explicit keyed state, so that a URL can come again after some time.

`first_seen` leaves the state to the built-in drop of duplicates, which forgets by event time or never. Here the state is a
map of URL keys per bucket of keys, kept by RocksDB: a micro-batch reads and writes the entries of its own keys only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ladle.functions.urls import url_key
from ladle.session import ship_package
from ladle.streaming.frontier import one_per_key

#: Buckets of keys. Fixed for the life of a checkpoint: a key is looked for in its bucket only.
BUCKETS = 1024
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Seen(StatefulProcessor):
    """Lets a URL key through if its bucket does not hold it, and holds it from then on, or for `expiry_ms`."""

    def __init__(self, columns: list[str], expiry_ms: int | None):
        self.columns, self.expiry_ms = columns, expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.keys = handle.getMapState("keys", "url_key string", "seen boolean", self.expiry_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for part in rows:
            part = part.drop_duplicates("url_key")
            fresh = [not self.keys.containsKey((k,)) for k in part["url_key"]]
            part = part.loc[fresh, self.columns]
            for k in part["url_key"]:
                self.keys.updateValue((k,), (True,))
            yield part

    def close(self) -> None:
        pass


def first_seen_for(urls: DataFrame, expiry_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Stream `urls` and their `url_key`, each key once, or once per `expiry_ms` of processing time.

    The time runs from when a key was let through; coming again does not prolong it. URLs that have no key are dropped.
    Duplicates inside an Arrow batch go before the shuffle. Groups are hashes of the key, not hosts: one host may hold
    a third of all URLs. Needs the RocksDB state store and sets it for queries of this session.
    """
    spark = urls.sparkSession
    ship_package(spark)
    spark.conf.set(_STORE, _ROCKSDB)
    keyed = urls.withColumn("url_key", url_key(F.col("url"))).where(F.col("url_key").isNotNull())
    thinned = keyed.mapInArrow(one_per_key, keyed.schema)
    bucketed = thinned.withColumn("_bucket", F.pmod(F.xxhash64("url_key"), F.lit(buckets)).cast("int"))
    return bucketed.groupBy("_bucket").transformWithStateInPandas(
        _Seen(keyed.columns, expiry_ms), keyed.schema, "Append", "None" if expiry_ms is None else "ProcessingTime")
