import time

from ladle.streaming.frontier import crawl_step
from ladle.streaming.seen import first_seen_for


def run(spark, tmp_path, urls, **options):
    """Land `urls` and run the stream on the one checkpoint; the URLs let through by this run."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    before = spark.read.schema("url string, url_key string").parquet(out).count() if (tmp_path / "out").exists() else 0
    spark.createDataFrame([(u,) for u in urls], "url string").repartition(3).write.mode("append").parquet(source)
    stream = first_seen_for(spark.readStream.schema("url string").parquet(source), buckets=4, **options)
    query = (stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint"))
             .trigger(availableNow=True).start(out))
    query.awaitTermination()
    keys = [r["url_key"] for r in spark.read.schema("url string, url_key string").parquet(out).collect()]
    return len(keys) - before, set(keys)


def test_each_key_once_over_restarts(spark, tmp_path):
    first = [f"http://h.example/{i % 30}#f{i}" for i in range(90)] + ["http://H.example:80/1"] * 200 + [None, ""]
    n, keys = run(spark, tmp_path, first)
    assert keys >= {f"http://h.example/{i}" for i in range(30)} and n == len(keys) <= 31
    again, now = run(spark, tmp_path, [*first, "http://h.example/new", "http://h.example/new#x"])
    assert again == 1 and now - keys == {"http://h.example/new"}


def test_a_key_comes_again_after_its_time(spark, tmp_path):
    urls = ["http://h.example/a", "http://h.example/b"]
    assert run(spark, tmp_path, urls, expiry_ms=2_000)[0] == 2
    time.sleep(2.5)
    assert run(spark, tmp_path, urls[:1], expiry_ms=2_000)[0] == 1


def test_a_key_stays_for_its_time(spark, tmp_path):
    assert run(spark, tmp_path, ["http://h.example/a"], expiry_ms=3_600_000)[0] == 1
    assert run(spark, tmp_path, ["http://h.example/a", "http://h.example/b"], expiry_ms=3_600_000)[0] == 1


def test_bytes_read_per_batch_stay_level(spark, tmp_path):
    """A chain of pages that all link to the first: the visited table grows, what a batch reads does not."""
    out, frontier = str(tmp_path / "out"), str(tmp_path / "frontier")
    files = spark._jvm.org.apache.hadoop.fs.FileSystem

    def read():
        return sum(s.getBytesRead() for s in files.getAllStatistics() if s.getScheme() == "file")

    took = []
    for n in range(10):
        url = f"http://g.example/{n:03}"
        page = spark.createDataFrame([(n, url, f'<a href="/{n + 1:03}">x</a><a href="/000">y</a>')],
                                     "page_id bigint, url string, html string")
        batch = spark.createDataFrame([(url, url)], "url string, url_key string")
        start = read()
        crawl_step(batch, n, page, out, frontier)
        took.append(read() - start)
    assert min(took) > 0 and max(took[6:]) <= 1.1 * max(took[1:5])
    # The link back is sent on, and the state of the stream drops it.
    sent = {r["url"] for r in spark.read.parquet(f"{frontier}/batch-9").collect()}
    assert sent == {"http://g.example/010", "http://g.example/000"}
