"""Loads that read only what landed since the last one."""

import os

import pytest

from ladle.operators.batching import batches
from ladle.operators.search import search
from ladle.operators.segments import open_segments
from ladle.operators.upsert import documents
from ladle.plans.jobs import index_new
from ladle.schemas import RESULT
from ladle.sources import batches as landing
from ladle.sources.batches import scan_text, write_batches
from ladle.sources.ledger import landed_files, new_files, record


def result(i, title, _id=None):
    return (i, f"http://s/{i}", "success", None, (_id or f"s-{i}", title, None, ["a"], ["b"], []))


def land(spark, path, *results):
    write_batches(batches(spark.createDataFrame(list(results), RESULT)), path, "s [odd] name")


def files_read(df):
    """Files that the scan of a finished query opened."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan"):
            scans.append(node.metrics().apply("numFiles").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
    return scans


@pytest.mark.parametrize("few", [10_000, 0])
def test_only_new_files_are_read(spark, tmp_path, rows, monkeypatch, few):
    monkeypatch.setattr(landing, "FEW_FILES", few)
    path, ledger = str(tmp_path / "landed"), str(tmp_path / "ledger")
    land(spark, path, result(1, "one"), result(2, "two"))
    first = new_files(spark, path, ledger)
    assert first.count() == landed_files(spark, path).count() > 0
    record(first, ledger)
    assert new_files(spark, path, ledger).count() == 0
    land(spark, path, result(3, "three"))
    second = new_files(spark, path, ledger)
    read = scan_text(spark, path, files=second)
    assert read.count() == 1 and "three" in read.first()["body"]
    if few:
        assert sum(files_read(read)) == second.count()
    # A file that is written again counts as new.
    name = min(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".txt"))
    os.utime(name, (1, 1))
    assert new_files(spark, path, ledger).count() == second.count() + 1


def test_loads_one_by_one(spark, tmp_path, rows):
    path, base = str(tmp_path / "landed"), str(tmp_path / "base")
    land(spark, path, result(1, "apple"), result(2, "pear"))
    assert rows(index_new(spark, path, base), "documents") == [(2,)]
    land(spark, path, result(3, "plum"), result(4, "quince", "s-2"))
    assert rows(index_new(spark, path, base), "documents") == [(2,)]
    assert index_new(spark, path, base).count() == 0
    held = documents(spark, f"{base}/documents")
    assert rows(held, "_id", "title") == [("s-1", "apple"), ("s-2", "quince"), ("s-3", "plum")]
    asked = spark.createDataFrame([(1, "pear"), (2, "quince plum")], "query_id int, query string")
    hits = search(asked, open_segments(spark, f"{base}/segments"))
    assert rows(hits, "query_id", "_id") == [(2, "s-2"), (2, "s-3")]
