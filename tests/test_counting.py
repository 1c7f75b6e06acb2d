"""Tokens are counted batch by batch and handed over as lists."""

from collections import Counter

from pyspark.sql import functions as F

from ladle.functions.analysis import ANALYZERS, LIGHT_ENGLISH
from ladle.operators.index import FIELDS, posting_lists, posting_rows

SCHEMA = "source string, _id string, title string, ingredient array<string>"
DOCS = [("b", "1", "Eggs egg eggs", ["the berries", None, "egg"]), ("a", "2", None, ["berries berry", "x"]),
        (None, "3", "...", None), ("a", "4", "Crème creme", []), ("a", None, "egg", ["y" * 300])]


def test_a_batch_gives_one_sorted_row_for_a_term_of_a_source(spark):
    # Every posting was a row of its own through the counting, the exchange and the sort.
    docs = spark.range(500).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("_id"),
                                   F.lit("egg eggs Eggs").alias("title"), F.array(F.lit("flour")).alias("ingredient"))
    lists = posting_lists(docs.coalesce(1), doc_rows=False).select("field", "term", F.size("ids").alias("n"), F.spark_partition_id().alias("p")).collect()
    assert sum(r["n"] for r in lists) == 1500
    per_task = Counter(r["p"] for r in lists)
    assert set(per_task.values()) == {3}
    assert [(r["field"], r["term"]) for r in lists if r["p"] == lists[0]["p"]] == [("ingredient", "flour"), ("title", "egg"), ("title", "eggs")]


def test_the_same_terms_as_token_by_token(spark, rows):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    for analyzer in (LIGHT_ENGLISH, ANALYZERS["english"], ANALYZERS["light_english_stopped"]):
        want = []
        for source, id_, title, lines in DOCS:
            for field, text in zip(FIELDS, (title, "\n".join(x for x in lines or [] if x is not None))):
                one = spark.createDataFrame([(text,)], "t string")
                from ladle.functions.analysis import tokens
                found = [r[0] for r in analyzer.terms(one.select(F.explode(analyzer.kept(tokens(F.col("t")))).alias("token"))).collect()]
                counted = Counter(found)
                want += [(source, id_, field, len(found), t, n) for t, n in counted.items()]
                want += [(source, id_, field, len(found), "", 1)] if found else []
        assert rows(posting_rows(docs, analyzer)) == sorted(want, key=repr)
