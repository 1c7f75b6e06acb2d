import duckdb
from pyspark.sql import functions as F

from catalog.stems import sql_porter
from ladle.functions.analysis import ANALYZERS, LIGHT_ENGLISH, Analyzer, fold_ascii, tokens
from ladle.functions.porter import porter


def analyzed(spark, texts, analyzer=LIGHT_ENGLISH):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string").select(
        "i", F.posexplode(analyzer.kept(tokens(F.col("x")))).alias("at", "token"))
    out = [[] for _ in texts]
    for r in analyzer.terms(df).orderBy("i", "at").collect():
        out[r["i"]].append(r["term"])
    return out


CHAIN = [
    ("tomatoes Tomatoes", ["tomatoes", "tomatoes"]),
    ("eggs Eggs", ["egg", "eggs"]),
    ("berries", ["berry"]),
    ("baker's Baker’S", ["baker", "baker"]),
    ("crème brûlée", ["creme", "brulee"]),
    ("the", ["the"]),
    ("1,000 2.5", ["1,000", "2.5"]),
    ("a.5 b.c", ["a", "5", "b.c"]),
    ("...", []),
    ("", []),
    ("___ __a 1_2", ["__a", "1_2"]),
    ("bus glass gas is", ["bus", "glass", "ga", "is"]),
    ("Straße Æon Œuvre", ["strasse", "aeon", "oeuvre"]),
    ("東京tower", ["東", "京", "tower"]),
    ("x" * 600, ["x" * 255, "x" * 255, "x" * 90]),
]


def test_chain(spark):
    assert analyzed(spark, [text for text, _ in CHAIN]) == [terms for _, terms in CHAIN]


def test_long_token_does_not_overflow(spark):
    found = spark.createDataFrame([("a1" * 100_000,)], "x string").select(F.size(tokens(F.col("x")))).first()[0]
    assert found == -(-200_000 // 255)


def test_options(spark):
    assert analyzed(spark, ["Eggs"], Analyzer(lowercase_first=True)) == [["egg"]]
    assert analyzed(spark, ["The eggs was and THE ham This"], ANALYZERS["light_english_stopped"]) == [["egg", "ham"]]
    assert analyzed(spark, ["The relational this Hopping"], ANALYZERS["english"]) == [["relat", "hop"]]
    lexicon = spark.createDataFrame([("geese", "goose")], "token string, root string")
    assert analyzed(spark, ["geese eggs"], Analyzer(lexicon=lexicon)) == [["goose", "egg"]]


def test_fold_rule_covers_latin_blocks(spark):
    df = spark.createDataFrame([("ÀŽșđłẠ’ﬁþＡ",)], "x string")
    assert df.select(fold_ascii(F.col("x"))).first()[0] == "AZsdlA'fithA"


# Examples from the published description of the algorithm.
PORTER = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "sky": "sky", "relational": "relat", "rational": "ration",
    "vietnamization": "vietnam", "decisiveness": "decis", "sensibiliti": "sensibl",
    "electricity": "electr", "goodness": "good", "adoption": "adopt", "effective": "effect",
    "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "say": "sai",
    "Upper": "Upper", "is": "is", "crème": "crème",
}


def test_porter(spark):
    df = spark.createDataFrame([(w,) for w in PORTER], "w string").select("w", porter(F.col("w")).alias("s"))
    assert {r["w"]: r["s"] for r in df.collect()} == PORTER


def test_porter_sql_on_the_same_examples():
    words = ", ".join(f"('{w}')" for w in PORTER)
    stems = duckdb.sql(f"with e(term) as (values {words}), {sql_porter('e')} select * from stems").fetchall()
    assert dict(stems) == {w: s for w, s in PORTER.items() if w.isascii() and w.islower() and len(w) > 2}
