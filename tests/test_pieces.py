"""Work that takes many times the memory of its text is cut by the bytes of that text."""

from pyspark.sql import functions as F

from ladle.functions.analysis import Analyzer
from ladle.operators import placed
from ladle.operators.index import build_index, place_index, posting_rows, term_totals
from ladle.operators.sizing import PIECE_BYTES, pieces

SCHEMA = "source string, _id string, title string, ingredient array<string>"


def test_partitions_follow_bytes(spark):
    text = spark.range(64).select(F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.col("id").cast("string").alias("_id"),
                                  F.repeat(F.lit("word "), 1000).alias("title"),
                                  F.array(F.lit("x" * 5000), F.lit(None).cast("string")).alias("ingredient"))
    parts = [pieces(text.limit(n), "source", "_id", size=10_000).rdd.getNumPartitions() for n in (16, 64)]
    assert 15 <= parts[0] <= 18 and 60 <= parts[1] <= 70


def test_postings_of_a_larger_input_take_more_tasks(spark):
    # AQE gave this one task for every core, however large it was.
    size = 6 * PIECE_BYTES
    text = spark.range(60).select(F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.col("id").cast("string").alias("_id"),
                                   F.repeat(F.lit("word "), size // 60 // 5).alias("title"),
                                   F.array().cast("array<string>").alias("ingredient"))
    found = posting_rows(text, doc_rows=False)
    assert found.rdd.getNumPartitions() >= 6
    assert found.agg(F.sum("tf"), F.count("*")).first() == (60 * (size // 60 // 5), 60)


def test_no_text(spark, rows):
    text = spark.createDataFrame([("s", "1", None, None)], SCHEMA)
    assert rows(posting_rows(text)) == [] == rows(posting_rows(text.limit(0)))
    lexicon = spark.createDataFrame([("mice", "mouse")], "token string, root string")
    some = spark.createDataFrame([("s", "1", "mice mouse", None)], SCHEMA)
    assert rows(posting_rows(some, Analyzer(lexicon=lexicon), doc_rows=False), "term", "tf") == [("mouse", 2)]


def test_shards_follow_words(spark, rows, tmp_path, monkeypatch):
    # Shards followed documents only, so a few long ones made a shard of any size.
    monkeypatch.setattr(placed, "WORDS_PER_SHARD", 500)
    docs = [(f"s{i % 2}", str(i), f"common w{i} w{i}", ["common " * 60 + f"x{i % 7}"]) for i in range(80)]
    index = build_index(spark.createDataFrame(docs, SCHEMA), str(tmp_path), buckets=2)
    postings = rows(index.postings.where("term <> ''"), "source", "field", "term", "tf", "dl")
    blocks = place_index(spark, str(tmp_path)).placed.blocks
    assert spark.read.parquet(f"{tmp_path}/placed_shape").first()["shards"] == -(-80 * 64 // 500)
    entries = blocks.select("source", "field", "term", F.inline(F.arrays_zip("tfs", "dls")))
    assert rows(entries) == postings


def test_terms_of_a_larger_input_meet_in_more_tasks(spark, rows):
    # Their number followed the shuffle partitions, so a task held more of them the larger the input was.
    def text(pieces_):
        return spark.range(60).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("_id"),
                                      F.repeat(F.concat(F.lit("word x"), F.col("id"), F.lit(" ")), pieces_ * PIECE_BYTES // 60 // 8).alias("title"),
                                      F.array().cast("array<string>").alias("ingredient"))
    assert term_totals(text(3)).rdd.getNumPartitions() < term_totals(text(9)).rdd.getNumPartitions() >= 9
    some = spark.createDataFrame([("a", "1", "berries berry", ["x"]), ("b", "2", "berry x", None)], SCHEMA)
    assert rows(term_totals(some), "field", "term", "n") == [("ingredient", "x", 1), ("title", "berry", 3), ("title", "x", 1)]
