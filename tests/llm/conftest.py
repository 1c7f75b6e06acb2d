import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark):
    """Documents of (doc_id, text); `extra` adds columns whose names operators use themselves."""
    def make(rows, extra=False):
        df = spark.createDataFrame([(i, t, None if i == 3 else "en", None, len(t or "")) for i, t in rows], SCHEMA)
        if extra:
            for name in ("score", "fp", "piece", "key", "tie", "size", "doc", "at", "kind", "spans", "stratum",
                         "start", "tokens", "seeds", "node", "quality", "count", "packed", "__here", "__body", "__held", "here", "body", "held",
                         "of", "of_body", "stays", "times", "tally", "src", "dst"):
                df = df.selectExpr("*", f"'x' as {name}")
        return df
    return make


@pytest.fixture
def rows_of():
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return collect
