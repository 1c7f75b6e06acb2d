"""The segmented index against an index built at once."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ladle.operators import segments, sizing
from ladle.operators.index import build_index
from ladle.operators.search import search

SCHEMA = "source string, _id string, title string, ingredient array<string>"


def doc(rng, i):
    line = lambda: " ".join(rng.choices([f"w{j}" for j in range(30)], k=rng.randint(0, 5)))
    return (f"s{i % 2}", str(i), line(), [line(), line()])


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


def same(spark, rows, path, docs, tmp_path, name):
    got, want = segments.open_segments(spark, path), build_index(spark.createDataFrame(docs, SCHEMA), str(tmp_path / name), buckets=2)
    for part, columns in (("postings", ("source", "field", "term", "_id", "tf", "dl")), ("doc_len", ("source", "field", "_id", "dl")),
                          ("term_stats", ("source", "field", "term", "df")), ("catalogue", ("source", "documents")),
                          ("corpus_stats", ("source", "field", "n_docs", "total_len", "avgdl"))):
        assert rows(getattr(got, part), *columns) == rows(getattr(want, part), *columns), (name, part)
    asked = spark.createDataFrame([(1, "w1 w2"), (2, "w3")], "query_id int, query string")
    assert rows(search(asked, got)) == rows(search(asked, want))


def test_equal_to_an_index_built_at_once(spark, tmp_path, rows):
    rng, path = random.Random(4), str(tmp_path / "segments")
    frame = lambda docs: spark.createDataFrame(docs, SCHEMA)
    held = {i: doc(rng, i) for i in range(30)} | {99: ("s1", "99", "", [])}
    segments.add(frame(list(held.values())), path)
    same(spark, rows, path, list(held.values()), tmp_path, "built")

    before = files(path)
    changed = {i: doc(rng, i) for i in (3, 4, 5, 31, 32)}
    segments.add(frame(list(changed.values())), path)
    held |= changed
    after = files(path)
    assert {f: after[f] for f in before} == before  # nothing that was written is touched
    segments.delete(spark.createDataFrame([("s1", "5"), ("s0", "6"), ("s0", "none"), ("s1", "6")], "source string, _id string"), path)
    del held[5], held[6]
    same(spark, rows, path, list(held.values()), tmp_path, "deleted")
    held[5] = doc(rng, 5)
    segments.add(frame([held[3], held[5]]), path)  # one as it was, one that was deleted comes back
    same(spark, rows, path, list(held.values()), tmp_path, "returned")

    segments.merge(spark, path, everything=True)
    _, parts = segments.manifest(spark, path)
    assert [p.kind for p in parts] == ["deltas", "segment"]
    same(spark, rows, path, list(held.values()), tmp_path, "merged")


def test_tiers_are_merged(spark, tmp_path, rows):
    rng, path, held = random.Random(5), str(tmp_path / "segments"), []
    for n in range(5):
        some = [doc(rng, 10 * n + i) for i in range(2)]
        held += some
        segments.add(spark.createDataFrame(some, SCHEMA), path)
    _, parts = segments.manifest(spark, path)
    assert sorted(p.documents for p in parts if p.kind == "segment") == [2, 8]
    same(spark, rows, path, held, tmp_path, "tiers")


def test_an_unfinished_commit_is_not_read(spark, tmp_path, rows, monkeypatch):
    rng, path = random.Random(6), str(tmp_path / "segments")
    held = [doc(rng, i) for i in range(4)]
    segments.add(spark.createDataFrame(held, SCHEMA), path)
    with monkeypatch.context() as m:
        m.setattr(segments, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            segments.add(spark.createDataFrame([doc(rng, 1), doc(rng, 9)], SCHEMA), path)
    same(spark, rows, path, held, tmp_path, "before")
    held[1] = doc(rng, 1)
    segments.add(spark.createDataFrame([held[1]], SCHEMA), path)
    same(spark, rows, path, held, tmp_path, "again")


def test_everything_deleted(spark, tmp_path):
    path, docs = str(tmp_path / "segments"), [doc(random.Random(7), i) for i in range(3)]
    segments.add(spark.createDataFrame(docs, SCHEMA), path)
    segments.delete(spark.createDataFrame([(d[0], d[1]) for d in docs], "source string, _id string"), path)
    segments.merge(spark, path, everything=True)
    index = segments.open_segments(spark, path)
    assert index.sources == 0 and index.postings.count() == 0 and index.catalogue.count() == 0


def test_documents_are_counted_in_batches_of_bytes(spark, tmp_path, monkeypatch):
    # A batch was 10,000 documents however long they were, and a task held it in Python twice and in the JVM.
    monkeypatch.setitem(sizing.IN_PIECES, "spark__sql__execution__arrow__maxBytesPerBatch", "20000")
    text = spark.range(400).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("_id"),
                                   F.concat_ws(" ", *(F.sha2(F.concat(F.lit(f"{i}-"), F.col("id")), 256) for i in range(8))).alias("title"),
                                   F.array(F.lit("common")).alias("ingredient"))
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    segments.add(text, str(tmp_path))
    held = spark.read.parquet(f"{tmp_path}/segment").where("term = 'common'")
    places = sorted(tuple(r) for r in held.select("_metadata.file_path", "_metadata.row_index").collect())
    runs = sum((f, i - 1) not in set(places) for f, i in places)
    assert len(places) == 400 and runs >= 10  # four tasks, so four runs if a batch were a task's documents
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_a_merge_sorts_and_sums_in_pieces_of_one_size(spark, tmp_path, rows, monkeypatch):
    # What a task sorted followed the partitions that Spark made of an exchange, and sums followed the splits of a scan.
    rng, path, met = random.Random(8), str(tmp_path / "segments"), []
    held = [doc(rng, i) for i in range(6)]
    for some in (held[:3], held[3:]):
        segments.add(spark.createDataFrame(some, SCHEMA), path)
    passing = segments.passing
    monkeypatch.setattr(segments, "passing", lambda spark, **conf: met.append(conf) or passing(spark, **conf))
    segments.merge(spark, path, everything=True)
    assert len(met) == 2 and all(sizing.IN_PIECES.keys() <= conf.keys() for conf in met)
    same(spark, rows, path, held, tmp_path, "pieces")
