import json

import pytest
from pyspark.sql import functions as F

from ladle.operators.batching import batch_bounds, batches
from ladle.operators.upsert import documents, has_table, id_buckets, latest, outcome, upsert
from ladle.schemas import RECIPE, RESULT
from ladle.sources.batches import (batch_results, parse_batches, quarantine, scan_text, sources, successes,
                                   write_batches)


def result(i, status="success", _id=None, title="t"):
    recipe = (_id or f"s-{i}", title, None, ["a"], ["b"], []) if status == "success" else None
    return (i, f"http://s/{i}", status, None, recipe)


def frame(spark, results):
    return spark.createDataFrame(results, RESULT)


def test_batches_of_100(spark, rows):
    results = frame(spark, [result(i, "success" if i % 2 else "networkFailure") for i in range(1, 251)])
    out = batches(results)
    assert rows(out, "batch", "n", "batch_key") == [
        (0, 100, "00000001-00000100"), (1, 100, "00000101-00000200"), (2, 50, "00000201-00000250")]
    assert rows(batch_bounds(results), "batch_key") == rows(out, "batch_key")
    body = json.loads(out.where("batch = 0").first()["body"])
    assert [r["id"] for r in body] == list(range(1, 101))
    assert body[1] == {"id": 2, "source": "http://s/2", "status": "networkFailure", "html": None, "recipe": None}
    assert body[0]["recipe"]["_id"] == "s-1" and body[0]["recipe"]["summary"] is None


@pytest.mark.parametrize("objects", [False, True])
def test_land_and_read_back(spark, tmp_path, rows, objects):
    path = str(tmp_path / "land=ed x")
    out = batches(frame(spark, [result(i) for i in range(1, 151)] + [result(151, "parseFailure")]))
    write_batches(out, path, "all-recipes", objects=objects)
    found = batch_results(parse_batches(scan_text(spark, path)))
    assert found.count() == 151
    assert rows(sources(found)) == [("all-recipes", "recipes-from-all-recipes")]
    good = successes(found)
    assert good.count() == 150 and set(RECIPE.fieldNames()) < set(good.columns)
    # The same keys again: objects replace theirs, packed files are added; one version wins.
    write_batches(out, path, "all-recipes", objects=objects)
    again = scan_text(spark, path)
    assert again.count() == (2 if objects else 4)
    assert latest(successes(batch_results(parse_batches(again)))).count() == 150
    write_batches(out.where("batch = 1"), path, "all-recipes", clean=True, objects=objects)
    assert scan_text(spark, path).count() == 1


def test_foreign_files_and_quarantine(spark, tmp_path, rows):
    ok = [{"id": 1, "source": "u", "status": "success", "html": None, "recipe": {
        "_id": "x-1", "title": "T", "ingredient": ["a"], "steps": ["b"], "images": []}}]
    no_recipe = [{"id": 2, "source": "u", "status": "success", "recipe": None}]
    for name, text in {"a/00000001-00000001.json": json.dumps(ok, indent=1), "a/empty.json": "[]",
                       "b/page.json": "<html>", "b/cut.json": '[{"id":1', "b/object.json": '{"id": 3}',
                       "b/status.json": '[{"id": 3, "status": "odd"}]', "a/none.json": json.dumps(no_recipe),
                       "root.json": json.dumps(ok)}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    parsed = parse_batches(scan_text(spark, str(tmp_path), whole_files=True)).cache()
    assert rows(quarantine(parsed), "file") == [("b/cut.json",), ("b/object.json",), ("b/page.json",), ("b/status.json",)]
    found = batch_results(parsed)
    assert rows(found, "source", "batch_key") == [("a", "00000001-00000001"), ("a", "00000002-00000002")]
    assert rows(successes(found), "_id", "title") == [("x-1", "T")]
    assert rows(outcome(found)) == [("a", 1, 1, False)]


VERSIONED = "source string, version int, _id string, title string"


def versioned(spark, data):
    df = spark.createDataFrame(data, VERSIONED)
    empty = F.array().cast("array<string>")
    return df.withColumn("summary", F.lit(None).cast("string")).withColumns(
        {"ingredient": empty, "steps": empty, "images": empty})


def test_upsert(spark, tmp_path, rows):
    path = str(tmp_path / "docs")
    hot = [("007", v, "same", f"v{v}") for v in range(300)]
    upsert(versioned(spark, [*hot, *[("007", 1, f"d{i}", "old") for i in range(20)], ("b", 1, "x", "bx")]),
           path, buckets=4)
    assert documents(spark, path).count() == 22 and id_buckets(documents(spark, path)) == 4
    fresh = versioned(spark, [("007", 2, "d3", "new"), ("007", 1, "d3", "older"), ("c", 1, "y", "cy")])
    for _ in range(2):  # running it again changes nothing
        report = upsert(fresh, path)
        assert rows(report, "source", "documents") == [("007", 1), ("c", 1)]
        got = {(r["source"], r["_id"]): r["title"] for r in documents(spark, path).collect()}
        assert len(got) == 23 and documents(spark, path).count() == 23
        assert got["007", "same"] == "v299" and got["007", "d3"] == "new" and got["007", "d4"] == "old"
        assert got["b", "x"] == "bx" and got["c", "y"] == "cy"
    upsert(fresh, path, recreate=True)
    assert documents(spark, path).count() == 2


def test_the_last_landing_of_a_batch_wins(spark, tmp_path, rows):
    path = str(tmp_path / "landed")
    for n in range(10):
        out = batches(frame(spark, [result(i, title=f"landing {n}") for i in (1, 2, 3)]))
        write_batches(out, path, "s")
        found = latest(successes(batch_results(parse_batches(scan_text(spark, path)))))
        assert rows(found, "title") == [(f"landing {n}",)] * 3


def test_a_table_that_cannot_be_read_is_not_absent(spark, tmp_path):
    assert not has_table(spark, str(tmp_path / "none"))
    (tmp_path / "empty").mkdir()
    assert not has_table(spark, str(tmp_path / "empty"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("not a table")
    with pytest.raises(Exception):
        has_table(spark, str(tmp_path / "bad"))
