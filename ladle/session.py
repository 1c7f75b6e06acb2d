"""Session defaults and the one shared scratch location every job uses."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Python workers receive whole pages: bound an Arrow batch by bytes, not by rows alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": "33554432",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Lists of query terms reach the Parquet reader as values, not just as their range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "100",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def session(name: str = "ladle", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local master may fall back to a folder of its own machine: on a cluster a
    machine-local folder is gone with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    local = tempfile.mkdtemp(prefix="ladle-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, for a table written by one run."""
    return f"{shared_dir(spark).rstrip('/')}/ladle/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "settled", **options: str) -> DataFrame:
    """Write `df` once under the shared folder and read it back; `options` are the writer's.

    Cuts the lineage, survives executor loss, and gives later plans exact file sizes.
    """
    path = scratch(df.sparkSession, label)
    with passing(df.sparkSession):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Settings for what runs inside, `__` standing for dots; what was set before comes back."""
    names = {key: key.replace("__", ".") for key in conf}
    before = {name: spark.conf.get(name) for name in names.values()}
    try:
        for key, name in names.items():
            spark.conf.set(name, conf[key])
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@contextmanager
def passing(spark: SparkSession, **conf: str) -> Iterator[None]:
    """For writes: exchanged rows leave the disks when the write that needed them is done.

    Spark keeps them until the driver happens to collect its garbage, so that a job holds those of all its steps at once.
    """
    with settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true", **conf):
        yield


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if getattr(context, "_ladle_shipped", False):
        return
    package = Path(__file__).resolve().parent
    bundle = Path(tempfile.mkdtemp(prefix="ladle-ship-")) / "ladle.zip"
    with zipfile.ZipFile(bundle, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(bundle))
    context._ladle_shipped = True
