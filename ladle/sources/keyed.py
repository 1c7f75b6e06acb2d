"""Tables bucketed by a key and written load by load: a join on the key moves only its other side.

A load holds a key at most once, and a load that is written again replaces itself. Rows lie in buckets by hash of the
key, sorted by it, so joins and ranks by key exchange nothing that is stored. Equal keys are at most as many as
loads, so no bucket grows from one hot key.

`tidy` puts earlier loads together and lets the number of buckets follow the rows. It writes a new generation beside the
old one; the shape that names it is written last, so a failure leaves the old generation in force.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from ladle.operators.upsert import has_table

#: What a table may have by Spark's default.
MOST_BUCKETS = 100_000
#: The load that earlier loads are put into.
MERGED = -1

_SHAPE = "generation int, buckets int"


@dataclass(frozen=True)
class Keyed:
    """A table at `path` of `columns` (DDL, `key` among them) and the number of the load, a column named `load`."""

    path: str
    key: str
    columns: str
    load: str = "load"
    rows_per_bucket: int = 2_000_000
    most_loads: int = 64

    def read(self, spark: SparkSession) -> DataFrame:
        """All loads; no rows before the first one."""
        shape = self._shape(spark)
        if shape is None:
            return spark.createDataFrame([], f"{self.columns}, {self.load} int")
        return spark.table(self._opened(spark, shape))

    def newest(self, spark: SparkSession) -> DataFrame:
        """The row of each key's last load."""
        last = Window.partitionBy(self.key).orderBy(F.col(self.load).desc())
        return self.read(spark).withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank")

    def write(self, rows: DataFrame, load: int, expected: int = 0) -> None:
        """Write or replace load `load` (from 0) by `rows`, whose keys are distinct. `expected` rows in all
        decide the number of buckets of a new table."""
        spark = rows.sparkSession
        shape = self._shape(spark)
        if shape is None:
            shape = Row(generation=0, buckets=self._buckets_for(spark, expected))
            self._record(spark, shape)
        self._insert(rows.withColumn(self.load, F.lit(load)), shape)

    def tidy(self, spark: SparkSession, before: int) -> bool:
        """Put loads below `before` together, if they are many or the buckets have become too large; of a key in
        several of them the last load stays. True if the table was rewritten."""
        shape = self._shape(spark)
        if shape is None:
            return False
        table = self.read(spark)
        loads = table.where(F.col(self.load) < before).select(self.load).distinct().count()
        # Counted from the footers.
        rows = table.count()
        if loads <= self.most_loads and rows <= 2 * self.rows_per_bucket * shape["buckets"]:
            return False
        target = F.when(F.col(self.load) < before, F.lit(MERGED)).otherwise(F.col(self.load))
        last = Window.partitionBy(self.key, "_target").orderBy(F.col(self.load).desc())
        kept = (table.withColumn("_target", target).withColumn("_rank", F.row_number().over(last)).where("_rank = 1")
                     .withColumn(self.load, F.col("_target")).drop("_rank", "_target"))
        grown = Row(generation=shape["generation"] + 1,
                    buckets=max(shape["buckets"], self._buckets_for(spark, rows)))
        # What a failed attempt has registered is of no use; its files are replaced load by load.
        spark.sql(f"drop table if exists {self._name(grown)}")
        self._insert(kept, grown)
        self._record(spark, grown)
        return True

    def buckets(self, spark: SparkSession) -> int | None:
        shape = self._shape(spark)
        return shape and shape["buckets"]

    def _buckets_for(self, spark: SparkSession, rows: int) -> int:
        """At least the partitions of a shuffle: with fewer buckets the planner would exchange the stored side."""
        least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        return min(MOST_BUCKETS, max(least, -(-rows // self.rows_per_bucket)))

    def _shape(self, spark: SparkSession) -> Row | None:
        if not has_table(spark, f"{self.path}-shape"):
            return None
        return spark.read.schema(_SHAPE).parquet(f"{self.path}-shape").orderBy(F.desc("generation")).first()

    def _record(self, spark: SparkSession, shape: Row) -> None:
        spark.createDataFrame([shape], _SHAPE).coalesce(1).write.mode("append").parquet(f"{self.path}-shape")

    def _folder(self, shape: Row) -> str:
        return f"{self.path}-{shape['generation']}" if shape["generation"] else self.path

    def _name(self, shape: Row) -> str:
        return f"ladle_keyed_{hashlib.sha256(self._folder(shape).encode()).hexdigest()[:24]}"

    def _opened(self, spark: SparkSession, shape: Row) -> str:
        """The table of a generation, made known to this application, with the loads that are there."""
        name, folder = self._name(shape), self._folder(shape)
        if not spark.catalog.tableExists(name):
            # A load replaces itself alone, whatever the session's overwrite mode.
            spark.sql(f"create table {name} ({self.columns}, {self.load} int) using parquet "
                      f"options (partitionOverwriteMode 'dynamic') partitioned by ({self.load}) "
                      f"clustered by (`{self.key}`) sorted by (`{self.key}`) into {shape['buckets']} buckets "
                      f"location '{folder}'")
        if has_table(spark, folder):
            spark.sql(f"msck repair table {name}")
        return name

    def _insert(self, rows: DataFrame, shape: Row) -> None:
        name = self._opened(rows.sparkSession, shape)
        order = rows.sparkSession.table(name).columns
        rows.select(*order).repartition(shape["buckets"], self.key).write.insertInto(name, overwrite=True)
