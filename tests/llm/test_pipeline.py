"""The pipeline on planted cases, each stage against what it must keep and drop."""

import random

import corpus_pipeline


def test_stages_on_planted_documents(spark, tmp_path):
    rnd = random.Random(6)

    def prose(n):
        return "\n".join(" ".join(f"{rnd.choice('bcdfg')}{rnd.choice('aeiou')}{rnd.randint(0, 999)}" for _ in range(10)) + "."
                         for _ in range(n))
    passage = " ".join(prose(3).split())
    rows = {i: prose(6) for i in range(80)}
    junk = {i: "BUY!! NOW!! CHEAP!! CHEAP!!\n" * 8 + f"{i}!! {i}!!" for i in range(200, 260)}
    copies = {300 + i: rows[i] for i in range(10)}
    leaks = {400 + i: prose(2) + "\n" + passage + "\n" + prose(2) for i in range(4)}
    private = {500: prose(4) + "\nmail a.b@c.dd or +1 555 123 4567\n" + prose(2)}
    every = rows | junk | copies | leaks | private | {600: None}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in every.items()],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200)) for i in [*rows, *junk]], "doc_id long, quality int").write.parquet(
        f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    kept, now = [], docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns, name
        kept.append({r["doc_id"]: r["text"] for r in now.collect()})
    quality, distinct, clean, redacted = kept
    assert set(rows | copies | leaks | private) <= set(quality) and not set(junk) & set(quality)
    assert set(distinct) == set(quality) - set(copies)
    assert set(clean) == set(distinct) - set(leaks)
    assert set(redacted) == set(clean)
    assert "<EMAIL> or <PHONE>" in redacted[500] and all(redacted[i] == rows[i] for i in rows)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(redacted)
