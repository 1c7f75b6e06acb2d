import json

import pytest
from pyspark.sql import functions as F

from ladle.operators.batching import batches
from ladle.schemas import RESULT
from ladle.sources.batches import batch_results, parse_batches, scan_text, successes
from ladle.sources.objects import ObjectWriter, write_objects


def results(spark, n, title="t"):
    return spark.createDataFrame([(i, f"http://s/{i}", "success", None, (f"s-{i}", title, None, ["a"], ["b"], []))
                                  for i in range(1, n + 1)], RESULT)


def objects(path):
    files = {str(f.relative_to(path)): f.read_text() for f in path.rglob("*") if f.is_file()}
    return {name: text for name, text in files.items() if not name.startswith("_staging/")}


def test_names_and_bodies(spark, tmp_path):
    out = tmp_path / "land ed=x"
    made = batches(results(spark, 250, "é"))
    write_objects(made, str(out), "all-recipes")
    assert objects(out) == {f"all-recipes/{r['batch_key']}.json": r["body"] for r in made.collect()}
    assert not (out / "_staging").exists()
    found = batch_results(parse_batches(scan_text(spark, f"file:{out}", whole_files=True)))
    assert successes(found).count() == 250
    # The same names are replaced, others stay; a URI names the same folder.
    write_objects(batches(results(spark, 100, "new")), f"file:{out}", "all-recipes")
    now = objects(out)
    assert len(now) == 3 and json.loads(now["all-recipes/00000001-00000100.json"])[0]["recipe"]["title"] == "new"
    write_objects(batches(results(spark, 3)), f"file://{out}", "other", clean=True)
    assert list(objects(out)) == ["other/00000001-00000003.json"]
    write_objects(batches(results(spark, 3)).limit(0), str(out), "other", clean=True)
    assert objects(out) == {}


def test_a_failed_job_leaves_what_was_there(spark, tmp_path):
    out = tmp_path / "landed"
    write_objects(batches(results(spark, 20, "old"), 10), str(out), "s")
    before = objects(out)
    late = batches(results(spark, 80, "new"), 10).repartition(4).withColumn(
        "body", F.when(F.col("batch") == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("body")))
    for clean in (False, True):
        with pytest.raises(Exception, match="lost"):
            write_objects(late, str(out), "s", clean=clean)
        assert objects(out) == before and scan_text(spark, str(out)).count() == 2


def test_attempts_clear_what_they_staged(tmp_path):
    writer = ObjectWriter(str(tmp_path), False)

    def fails():
        yield {"name": "s/1.json", "body": "[]"}
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        writer.write(fails())
    assert [f.name for f in tmp_path.rglob("*") if f.is_file()] == ["_running"]
    writer.abort([])
    # An attempt that goes on after its job has ended.
    with pytest.raises(RuntimeError, match="ended"):
        writer.write(iter([{"name": "s/1.json", "body": "[]"}]))
    assert not [f for f in tmp_path.rglob("*") if f.is_file()]


def test_staged_objects_are_not_read(spark, tmp_path):
    out = tmp_path / "landed"
    write_objects(batches(results(spark, 5)), str(out), "s")
    other = ObjectWriter(str(out), False)
    staged = other.write(iter([{"name": "s/00000007-00000007.json", "body": "[]"}]))
    assert scan_text(spark, str(out)).count() == 1
    # A job that commits meanwhile leaves the other's staging alone.
    write_objects(batches(results(spark, 6)), str(out), "s")
    other.commit([staged, None])
    assert sorted(objects(out)) == [f"s/0000000{a}-0000000{b}.json" for a, b in ((1, 5), (1, 6), (7, 7))]
    other.abort([])


@pytest.mark.parametrize("source", ["", "a/b", "_a", ".a", "source=a"])
def test_sources_that_a_reader_would_miss(spark, tmp_path, source):
    with pytest.raises(ValueError):
        write_objects(batches(results(spark, 1)), str(tmp_path), source)
