"""Ranking over postings placed by document against the exchange of all matches."""

import random

import numpy as np
import pyarrow as pa
import pytest

from ladle.functions.analysis import LIGHT_ENGLISH
from ladle.operators.index import ALL_INDEXES, build_index, place_index, refresh_index
from ladle.operators.placed import Shard
from ladle.operators.search import _placed_hits, _scores_by_term, scores, search, search_one

SCHEMA = "source string, _id string, title string, ingredient array<string>"


def docs(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    line = lambda: " ".join(rng.choices(words, weights, k=rng.randint(0, 9)))
    return [(f"s{i % 3}", str(i), line(), [line(), line()]) for i in range(n)]


@pytest.fixture(scope="module")
def indexes(spark, tmp_path_factory):
    """The same documents twice: with placed postings and without."""
    frame = spark.createDataFrame(docs(1, 400) + [("s1", f"copy{i}", "w5 w6", ["w7"]) for i in range(30)], SCHEMA)
    plain = build_index(frame, str(tmp_path_factory.mktemp("plain")), buckets=2)
    path = str(tmp_path_factory.mktemp("placed"))
    build_index(frame, path, buckets=2)
    return plain, place_index(spark, path, shards=5)


@pytest.fixture(scope="module")
def queries(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(45)], k=rng.randint(1, 12))) for _ in range(20)]
    return spark.createDataFrame(list(enumerate([*texts, "w5 w6 w7", "w5", "", None, "...", texts[0], "unknown"])),
                                 "query_id int, query string")


@pytest.mark.parametrize("options", [
    {}, {"scope": "global"}, {"fields": {"title": 2.0}}, {"pattern": "recipes-from-s1"}, {"k": 3},
    {"fields": {"title": 0.0, "ingredient": 3.0}}, {"k": 1000}])
def test_same_hits(indexes, queries, rows, options):
    plain, placed = indexes
    assert plain.placed is None and placed.placed is not None
    assert rows(search(queries, placed, **options)) == rows(search(queries, plain, **options))


def test_nothing_is_exchanged_between_match_and_sum(indexes, queries):
    hits = _placed_hits(queries.where("query <> ''"), indexes[1], None, 10, "index", ALL_INDEXES, LIGHT_ENGLISH)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("FlatMapGroupsInArrow", 1)
    # The best of a task are cut before the exchange; under the sums there are a bucketed scan and what is broadcast.
    assert "WindowGroupLimit" in above
    assert "hashpartitioning" not in below.split("BroadcastExchange")[0] and "Bucketed: true" in below


def test_search_one_and_reopened_tables(spark, indexes, rows):
    plain, placed = indexes
    assert rows(search_one("w5 w6", placed)) == rows(search_one("w5 w6", plain))


def test_a_changed_index_is_placed_anew(spark, tmp_path, rows):
    path, frame = str(tmp_path / "i"), spark.createDataFrame(docs(3, 30), SCHEMA)
    build_index(frame, path, buckets=2)
    assert place_index(spark, path, shards=2).placed is not None
    changed = spark.createDataFrame([("s0", "0", "entirely new", ["thing"])], SCHEMA)
    index = refresh_index(changed, path, spark.createDataFrame([("s0",)], "source string"))
    assert index.placed is None
    asked = spark.createDataFrame([(1, "entirely"), (2, "w1")], "query_id int, query string")
    before = rows(search(asked, index))
    assert before and rows(search(asked, place_index(spark, path, shards=3))) == before


def test_empty_index(spark, tmp_path):
    path = str(tmp_path / "i")
    build_index(spark.createDataFrame([], SCHEMA), path, buckets=2)
    index = place_index(spark, path, shards=2)
    assert search(spark.createDataFrame([(1, "a")], "query_id int, query string"), index).count() == 0


def test_blocks_skipped():
    """A list that cannot win alone is looked into only where candidates of the others may be."""
    n, size = 40_000, 64
    common = [np.arange(a, a + size) for a in range(0, n, size)]
    rare = np.arange(100, n, 4000)
    rows = [("title", "common", o, np.ones(size, int), np.full(size, 10), 1, 10, 0.1, 10.0) for o in common]
    rows.append(("title", "rare", rare, np.full(len(rare), 3), np.full(len(rare), 10), 3, 10, 9.0, 10.0))
    frame = pa.table([pa.array(c) for c in zip(*rows)],
                     names=["field", "term", "ords", "tfs", "dls", "max_tf", "min_dl", "gain", "avgdl"])
    shard = Shard(frame, 1.2, 0.75)
    docs, scores = shard.best({"rare": 1, "common": 1}, {"title": 1.0}, 10, 1.0)
    assert docs.tolist() == rare.tolist() and len(shard.held) == len(rare) < len(common) / 10
    assert list(shard.whole) == [("title", "rare")]
    whole = Shard(frame, 1.2, 0.75)
    all_docs, all_scores = whole.best({"rare": 1, "common": 1}, {"title": 1.0}, 10, 0.0)
    assert len(whole.whole) == 2 and all_docs.tolist() == docs.tolist() and all_scores.tolist() == scores.tolist()


@pytest.mark.parametrize("options", [
    {}, {"scope": "global"}, {"fields": {"title": 2.0}}, {"pattern": "recipes-from-s1"}, {"fields": {"title": 0.0, "ingredient": 3.0}}])
def test_all_matches_without_exchanging_them(indexes, queries, rows, options):
    # They were summed by query and document after an exchange of every match, also where postings are placed by document.
    plain, placed = indexes
    found = scores(queries, placed, **options)
    assert rows(found) == rows(scores(queries, plain, **options)) != []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan.split("BroadcastExchange")[0] and plan.count("Bucketed: true") == 2
    asked = {"fields": None, "scope": "index", "pattern": ALL_INDEXES, "analyzer": LIGHT_ENGLISH} | options
    assert rows(found) == rows(_scores_by_term(queries, placed, **asked))


def test_no_query_has_no_match(indexes, queries):
    assert scores(queries.where("query_id > 1000"), indexes[1]).collect() == []
