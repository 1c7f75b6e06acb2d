import math

import pytest
from pyspark.sql import functions as F

import ladle.operators.search as search_module
from ladle.operators.index import build_index, ensure_index, index_view, open_index, refresh_index
from ladle.operators.search import no_results, result_lines, scores, search, search_one, with_documents

DOCS = [("a", "1", "apple pie", ["apple", "flour butter"]),
        ("a", "2", "plain cake", ["flour", "egg egg egg"]),
        ("a", "3", "salad", ["apple apple", "pear"]),
        ("b", "1", "apple", ["pear"]),
        ("b", "2", "", ["pear jam"])]
SCHEMA = "source string, _id string, title string, ingredient array<string>"
QUERIES = [(1, "apple"), (2, "apple apple"), (3, "cake"), (4, "egg"), (5, ""), (6, None), (7, "..."),
           (8, "pear flour"), (9, "unknown")]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    return build_index(docs, str(tmp_path_factory.mktemp("index")), buckets=3)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, "query_id int, query string")


def brute_force(query, scope="index"):
    fields = {"title": 2.0, "ingredient": 1.0}
    bags = {(s, i, f): (t if f == "title" else " ".join(g)).split() for s, i, t, g in DOCS for f in fields}
    out = {}
    for (s, i, f), words in bags.items():
        peers = [w for (s2, _, f2), w in bags.items() if f2 == f and w and (scope == "global" or s2 == s)]
        total = 0.0
        for term in query.split():
            tf = words.count(term)
            if tf:
                df = sum(term in w for w in peers)
                idf = math.log(1 + (len(peers) - df + 0.5) / (df + 0.5))
                norm = 1.2 * (1 - 0.75 + 0.75 * len(words) / (sum(map(len, peers)) / len(peers)))
                total += fields[f] * 2.2 * idf * tf / (tf + norm)
        if total:
            out[s, i] = max(out.get((s, i), 0.0), total)
    return {k: round(v, 6) for k, v in out.items()}


@pytest.mark.parametrize("scope", ["index", "global"])
def test_scores_match_brute_force(index, queries, scope):
    got = {}
    for r in scores(queries, index, scope=scope).collect():
        got.setdefault(r["query_id"], {})[r["source"], r["_id"]] = r["score"]
    for qid, text in QUERIES:
        want = brute_force(text, scope) if text and text != "..." else {}
        assert got.get(qid, {}) == pytest.approx(want, abs=2e-6), text
    assert got[2]["a", "1"] == pytest.approx(2 * got[1]["a", "1"], abs=3e-6)


def test_salted_join_gives_the_same(index, queries, monkeypatch, rows):
    want = rows(scores(queries, index))
    monkeypatch.setattr(search_module, "fits_broadcast", lambda *a: False)
    monkeypatch.setattr(search_module, "fits", lambda *a: False)
    monkeypatch.setattr(search_module, "FEW_TERMS", 0)
    monkeypatch.setattr(search_module, "HOT_POSTINGS", 1)
    assert rows(scores(queries, index)) == want


def test_few_terms_reach_the_scan(index, capsys):
    search_one("apple", index).explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(term,apple)" in plan or "In(term, [apple])" in plan
    assert "dynamicpruning" in plan
    search_one("apple pear", index).explain("formatted")
    assert "In(term, [apple,pear])" in capsys.readouterr().out


def test_query_without_tokens(index):
    assert search_one("... !", index).count() == 0


def test_index_tables(index, rows):
    assert rows(index.corpus_stats, "source", "field", "n_docs", "total_len") == [
        ("a", "ingredient", 3, 10), ("a", "title", 3, 5), ("b", "ingredient", 2, 3), ("b", "title", 1, 1)]
    lengths = {(r["source"], r["_id"], r["field"]): r["dl"] for r in index.doc_len.collect()}
    sums = index.postings.groupBy("source", "_id", "field").agg(F.sum("tf").alias("n")).collect()
    assert {(r["source"], r["_id"], r["field"]): r["n"] for r in sums} == lengths
    assert ("b", "2", "title") not in lengths
    assert rows(index.term_stats.where("term = 'apple'"), "source", "field", "df") == [
        ("a", "ingredient", 2), ("a", "title", 1), ("b", "title", 1)]


def test_top_k_is_a_prefix_and_ties_are_ordered(index, queries, rows):
    two, three = (search(queries, index, k=k).collect() for k in (2, 3))
    keep = {(r["query_id"], r["rank"], r["source"], r["_id"], r["score"]) for r in three if r["rank"] <= 2}
    assert {(r["query_id"], r["rank"], r["source"], r["_id"], r["score"]) for r in two} == keep
    single = [(r["source"], r["_id"]) for r in search_one("apple", index, k=2).collect()]
    assert single == [(r["source"], r["_id"]) for r in sorted(two, key=lambda r: r["rank"]) if r["query_id"] == 1]
    assert rows(search(queries, index, pattern="recipes-from-b"), "source") == [("b",)] * 4


def test_copies_of_a_query_get_the_same_hits(spark, index, queries, rows):
    copies = spark.createDataFrame([(100 + i, "pear flour") for i in range(40)] + [(5, "cake")], "query_id int, query string")
    got = search(copies, index, k=2)
    assert got.count() == 81
    want = [r[1:] for r in rows(search(queries, index, k=2).where("query_id = 8"))]
    for qid in (100, 139):
        assert [r[1:] for r in rows(got.where(F.col("query_id") == qid))] == want


def test_no_results_and_documents(spark, index, queries, rows):
    hits = search(queries, index)
    assert rows(no_results(queries, hits)) == [
        (1, False), (2, False), (3, False), (4, False), (5, True), (6, True), (7, True), (8, False), (9, True)]
    docs = spark.createDataFrame(DOCS, SCHEMA).withColumn("steps", F.array(F.lit("go")))
    found = with_documents(hits.where("query_id = 3"), queries, docs)
    assert rows(result_lines(found), "section", "line_no", "line") == [
        ("ingredient", 0, "flour"), ("ingredient", 1, "egg egg egg"), ("step", 0, "go"), ("title", 0, "plain cake")]


def test_refresh_replaces_only_touched_sources(spark, tmp_path, rows):
    path = str(tmp_path / "index")
    build_index(spark.createDataFrame(DOCS, SCHEMA), path, buckets=3)
    changed = [("a", "1", "zebra", ["zebra"])] + [d for d in DOCS if d[0] == "b"]
    index = refresh_index(spark.createDataFrame(changed, SCHEMA), path,
                          spark.createDataFrame([("a",)], "source string"))
    fresh = build_index(spark.createDataFrame(changed, SCHEMA), str(tmp_path / "fresh"), buckets=3)
    for table in ("postings", "term_stats", "doc_len", "corpus_stats"):
        a, b = getattr(index, table), getattr(fresh, table)
        assert rows(a) == rows(b.select(a.columns)), table


def test_ensure_keeps_or_recreates(spark, tmp_path, rows):
    path = str(tmp_path / "index")
    ensure_index(spark.createDataFrame(DOCS, SCHEMA), path)
    other = spark.createDataFrame(DOCS[:1], SCHEMA)
    assert ensure_index(other, path).names().count() == 2
    assert rows(ensure_index(other, path, recreate=True).names(), "index_name", "documents") == [("recipes-from-a", 1)]
    assert open_index(spark, path).buckets == 4


def test_index_view(spark, rows):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    index_view(docs, "recipes-from-b*", name="some_recipes")
    assert rows(spark.sql("select index_name, _id from some_recipes")) == [("recipes-from-b", "1"), ("recipes-from-b", "2")]
    assert index_view(docs).count() == 5


def test_boosts_below_zero_are_refused(index, queries):
    with pytest.raises(ValueError):
        scores(queries, index, fields={"title": -1.0})


def test_one_id_for_two_texts(spark, index, rows):
    twice = spark.createDataFrame([(1, "cake"), (1, "egg")], "query_id int, query string")
    assert rows(search(twice, index), "query_id", "source", "_id") == [(1, "a", "2"), (1, "a", "2")]
    apart = spark.createDataFrame([(1, "cake"), (1, "salad")], "query_id int, query string")
    assert rows(search(apart, index), "_id", "rank") == [("2", 1), ("3", 1)]


def test_catalogue_counts_every_document(spark, tmp_path, rows):
    docs = spark.createDataFrame([("a", "1", "pie", []), ("a", "2", "", ["egg"]), ("a", "3", "", [])], SCHEMA)
    path = str(tmp_path / "index")
    assert rows(build_index(docs, path).names(), "source", "documents") == [("a", 3)]
    touched = spark.createDataFrame([("a",)], "source string")
    assert rows(refresh_index(docs.where("_id < 3"), path, touched).names(), "source", "documents") == [("a", 2)]
    assert refresh_index(docs.where("false"), path, touched).names().count() == 0
