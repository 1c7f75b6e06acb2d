"""Text and postings are exchanged only where rows must meet."""

import os
import time

import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.operators import index, segments, sizing
from ladle.operators.batching import batches
from ladle.operators.sizing import within, without
from ladle.operators.upsert import documents, latest, latest_settled
from ladle.plans import jobs
from ladle.plans.jobs import index_new
from ladle.schemas import RECIPE
from ladle.session import settle
from ladle.sources.batches import write_batches

SCHEMA = "source string, _id string, version int, title string"


def test_last_versions_without_a_window_over_all(spark, rows, tmp_path):
    some = [("a", "1", 1, "x"), ("a", "2", 1, "old"), ("a", "2", 3, "new"), ("b", "2", 2, "y"), ("a", None, 1, "p"), ("a", None, 2, "q")]
    spark.createDataFrame(some, SCHEMA).write.parquet(f"{tmp_path}/docs")
    held = spark.read.parquet(f"{tmp_path}/docs")
    assert rows(latest_settled(held)) == rows(latest(held))
    once = held.where("_id = '1'")
    assert "Window" not in latest_settled(once)._jdf.queryExecution().toString()
    assert rows(latest_settled(once)) == rows(once)


def test_keys_in_several_broadcasts(spark, rows, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 20)
    table = spark.range(100).select(F.col("id").alias("n"), (F.col("id") % 50).alias("k"))
    for few in (10, 30, 45):  # one broadcast, several, too many
        keys = spark.range(few).select(F.col("id").alias("k"))
        assert rows(within(table, keys, ["k"]), "n", "k") == rows(table.where(F.col("k") < few))
        assert rows(without(table, keys, ["k"]), "n", "k") == rows(table.where(F.col("k") >= few))
    assert len(sizing.key_parts(spark.range(30), ["id"])) == 3 and sizing.key_parts(spark.range(90), ["id"]) is None


def test_load_exchanges_no_text_and_keeps_no_second_copy(spark, rows, tmp_path, monkeypatch):
    def load(ids, title):
        recipe = F.struct(*(F.col(f) for f in RECIPE.fieldNames()))
        docs = spark.createDataFrame([(str(i), f"{title} {i}", "s", ["a b"], [], []) for i in ids], RECIPE)
        results = docs.select(F.col("_id").cast("int").alias("id"), F.lit("u").alias("source"), F.lit("success").alias("status"),
                              F.lit(None).cast("string").alias("html"), recipe.alias("recipe"))
        write_batches(batches(results), f"{tmp_path}/landed", "all-recipes")
        return index_new(spark, f"{tmp_path}/landed", f"{tmp_path}/base")

    hints, bodies = [], []
    hint = DataFrame.hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda df, name, *a: hints.append(name) or hint(df, name, *a))
    settle = jobs.settle

    def watched(df, label, **options):
        out = settle(df, label, **options)
        if label == "parsed":
            bodies.append(out)
        return out

    monkeypatch.setattr(jobs, "settle", watched)
    load(range(1, 8), "first")
    load((2, 5, 9), "again")
    got = rows(documents(spark, f"{tmp_path}/base/documents"), "_id", "title")
    assert got == sorted([(str(i), f"{'again' if i in (2, 5, 9) else 'first'} {i}") for i in (*range(1, 8), 9)], key=repr)
    assert "rebalance" not in hints  # a table of one folder
    assert all(b.where("body is not null").count() == 0 < b.count() for b in bodies) and len(bodies) == 2
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_tasks_that_count_terms_are_of_one_size(spark, rows, tmp_path, monkeypatch):
    # They followed the size of a scan's split, and the postings of a folder went to one task to be sorted.
    monkeypatch.setattr(segments, "COUNTED_BYTES", 20_000)
    docs = spark.range(400).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("_id"),
                                   F.concat_ws(" ", *(F.sha2(F.concat(F.lit(f"{i}-"), F.col("id")), 256) for i in range(8))).alias("title"),
                                   F.array(F.lit("common")).alias("ingredient"))
    met = []
    finish = segments._finish
    monkeypatch.setattr(segments, "_finish", lambda *a: (met.append(a[4]), finish(*a)))
    segments.add(docs.repartition(8), str(tmp_path))
    index = segments.open_segments(spark, str(tmp_path))
    assert rows(index.term_stats.where("term = 'common'"), "field", "df") == [("ingredient", 400)]
    assert index.term_stats.count() == index.term_stats.select("term").distinct().count() == 400 * 8 + 1
    with segments.settings(spark, spark__sql__files__maxPartitionBytes="20000"):
        assert met[0].rdd.getNumPartitions() > 8
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b"


def test_exchanged_rows_go_when_they_are_written(spark):
    # They stayed until the driver collected its garbage, so the disks held the exchanges of all steps of a job.
    folders = [d.getPath() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    held = lambda: {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}
    before = held()
    got = settle(spark.range(1000).repartition(7, "id"))
    for _ in range(50):
        if held() <= before:
            break
        time.sleep(0.2)
    assert held() <= before and got.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_index_is_built_where_documents_are_read(spark, rows, tmp_path, monkeypatch):
    # The text was exchanged, which dealt the documents of a source over all tasks: a term had one short list in each.
    text = spark.range(1200).select(F.col("id").cast("string").alias("_id"), F.lit("common").alias("title"),
                                    F.array(F.concat(F.lit("w"), F.col("id"))).alias("ingredient"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"))
    text.repartition(12, "source").write.partitionBy("source").parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs").repartition(4, "source").sortWithinPartitions("source")
    met, write = [], index._write
    monkeypatch.setattr(index, "_write", lambda df, path, *a: (met.append(df) if path.endswith("postings") else None, write(df, path, *a)))
    built = index.build_index(docs, f"{tmp_path}/index", buckets=2)
    # One exchange is that of `docs` itself.
    assert met[0]._jdf.queryExecution().optimizedPlan().toString().count("Repartition") == 1
    lists = spark.read.parquet(f"{tmp_path}/index/postings").where("term = 'common'")
    assert lists.count() == 3
    assert rows(built.term_stats.where("term = 'common'"), "source", "df") == [("s0", 400), ("s1", 400), ("s2", 400)]
    assert built.postings.count() == 2400


def test_parsed_batches_are_read_in_groups_of_one_size(spark, tmp_path, monkeypatch):
    # A row holds a batch of records, and the default group of 128 MB was read at once.
    recipe = F.struct(*(F.col(f) for f in RECIPE.fieldNames()))
    docs = spark.range(300).select(F.col("id").cast("string").alias("_id"), F.sha2(F.col("id").cast("string"), 512).alias("title"), F.lit("s").alias("summary"),
                                   F.array(F.lit("a")).alias("ingredient"), F.array().cast("array<string>").alias("steps"), F.array().cast("array<string>").alias("images"))
    results = docs.select((F.col("_id").cast("int") + 1).alias("id"), F.lit("u").alias("source"), F.lit("success").alias("status"),
                          F.lit(None).cast("string").alias("html"), recipe.alias("recipe"))
    write_batches(batches(results, 1).coalesce(1), f"{tmp_path}/landed", "all-recipes")
    monkeypatch.setattr(jobs, "PIECE_BYTES", 10_000)
    found, kept = [], jobs.settle

    def watched(df, label, **options):
        out = kept(df, label, **options)
        if label == "parsed":
            found.extend(pq.ParquetFile(f.removeprefix("file:")).num_row_groups for f in out.inputFiles())
        return out

    monkeypatch.setattr(jobs, "settle", watched)
    index_new(spark, f"{tmp_path}/landed", f"{tmp_path}/base")
    assert max(found) > 1 and documents(spark, f"{tmp_path}/base/documents").count() == 300
