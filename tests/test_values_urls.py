from pyspark.sql import functions as F

from ladle.functions import urls as u
from ladle.functions import values as v


def each(spark, column, values, kind="string"):
    """`column` of every value, in one job."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}").select(
        "i", column(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in rows]


def one(spark, column, value, kind="string"):
    return each(spark, column, [value], kind)[0]


KEYS = [
    ("http://A.example/x#f", "http://a.example/x"),
    ("HTTPS://a.example:443/x", "https://a.example/x"),
    ("https://a.example:8443/x", "https://a.example:8443/x"),
    ("http://a.example", "http://a.example/"),
    ("http://a.example?q=1", "http://a.example/?q=1"),
    ("http://u:p@A.example:80/X?Q#z", "http://u:p@a.example/X?Q"),
    ("mailto:Me@a.example", "mailto:Me@a.example"),
    ("relative/x#y", "relative/x"),
]


def test_url_key(spark):
    assert each(spark, u.url_key, [k for k, _ in KEYS]) == [k for _, k in KEYS]


REFERENCES = [
    ("/x", "http://h.example/x"),
    ("x", "http://h.example/a/x"),
    ("//o.example/x", "http://o.example/x"),
    ("?q", "http://h.example/a/b?q"),
    ("#f", "http://h.example/a/b?k=1#f"),
    ("", "http://h.example/a/b?k=1"),
    ("../x", "http://h.example/x"),
    ("../../../x", "http://h.example/x"),
    ("./y/./z", "http://h.example/a/y/z"),
    ("..", "http://h.example/"),
    (".", "http://h.example/a/"),
    ("/c/..", "http://h.example/"),
    ("y/..", "http://h.example/a/"),
    ("x?a=../b", "http://h.example/a/x?a=../b"),
    (" https://o.example/p ", "https://o.example/p"),
    ("https://o.example/a/../b", "https://o.example/b"),
    ("mailto:me@x", "mailto:me@x"),
    ("a:b/../c", "a:b/../c"),
]


def test_resolve(spark):
    base = F.lit("http://h.example/a/b?k=1#top")
    got = each(spark, lambda x: u.resolve(base, x), [r for r, _ in REFERENCES])
    assert got == [r for _, r in REFERENCES]


def test_url_parts(spark):
    parts = lambda x: F.struct(u.host(x).alias("h"), u.path(x).alias("p"), u.scheme(x).alias("s"),
                               u.store_key(x).alias("k"), u.document_id(x, F.lit(7)).alias("d"))
    assert [tuple(r) for r in each(spark, parts, ["https://User@Host.example:99/p/q?x#y", "HTTP://H", "http://H/p?q#f"])] == [
        ("host.example", "/p/q", "https", "https://User@host.example:99/p/q?x#y//p/q", "host.example-7"),
        ("h", "/", "http", "http://h///", "h-7"),
        ("h", "/p", "http", "http://h/p?q#f//p", "h-7")]


def test_absolute(spark):
    assert each(spark, u.is_absolute, ["mailto:x", "/x", None]) == [True, False, False]


def test_pad_id_keeps_long_numbers(spark):
    assert each(spark, v.pad_id, [42, 123456789], "bigint") == ["00000042", "123456789"]


def test_clean_title(spark):
    clean = lambda x: v.clean_title(x, " | Allrecipes")
    assert each(spark, clean, ["  Pie | Allrecipes | Allrecipes ", None]) == ["Pie", ""]


def test_blank_items(spark):
    kept = spark.createDataFrame([([" a ", " ", " \t", None, "b"],)], "x array<string>").select(
        v.keep_not_blank(F.col("x"))).first()[0]
    assert kept == [" a ", "b"]


def test_index_names_and_patterns(spark):
    assert one(spark, v.index_name, "a//") == "recipes-from-a"
    like = lambda pattern: (lambda x: v.matches_pattern(x, pattern))
    assert one(spark, like("recipes-from-*"), "recipes-from-x") is True
    assert one(spark, like("recipes_from-*"), "recipes-from-x") is False


def test_status_codes(spark):
    assert one(spark, v.status_code, "parseFailure") == 8
    assert one(spark, v.status_name, 4, "int") == "networkFailure"
    assert each(spark, v.retryable, [400, 401, 403, 404, 429, 499, 500, 599, 600], "int") == [
        True, True, True, False, True, False, True, True, False]
