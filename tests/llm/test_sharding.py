import random
import zlib

import pytest

from ladle.llm import sharding as s
from hard_rows import HARD


def brute(rows, shards):
    """In key order, a row's shard follows from the bytes before it."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    total, done, slots, out = sum(len((t or "").encode()) + 1 for _, t in rows), 0, {}, []
    for i, t in rows:
        size = len((t or "").encode()) + 1
        shard = shards * done // total
        out.append((i, size, zlib.crc32((t or "").encode()), "bytes", shard, slots.setdefault(shard, 0), None))
        slots[shard] += 1
        done += size
    return sorted(out, key=repr)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_distinct_keys_against_brute_force(table, rows_of, shards):
    rnd = random.Random(shards)
    rows = [(rnd.randint(-2 ** 62, 2 ** 62), "x" * rnd.randint(0, 90)) for _ in range(120)] + [(None, "y"), (7, None)]
    assert rows_of(s.shard_by_bytes(table(rows, extra=True), shards)) == brute(rows, shards)


def test_a_key_that_holds_most_rows_is_split(table):
    rows = [(5, "z" * 9)] * 80 + [(1, "a"), (9, "b")] + HARD
    got = s.shard_by_bytes(table(rows), 8).collect()
    assert len(got) == len(rows)
    for shard in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))
    small = s.shard_by_bytes(table([(5, "z" * 9)] * 80), 8).collect()
    assert [sum(r["size"] for r in small if r["shard"] == k) for k in range(8)] == [100] * 8


def test_tolerance_bounds_the_excess(table):
    rows = [(i * 1000, "x" * (i % 37)) for i in range(300)]
    got = s.shard_by_bytes(table(rows), 4, tolerance=200).collect()
    sizes = [sum(r["size"] for r in got if r["shard"] == k) for k in range(4)]
    assert max(abs(x - sum(sizes) / 4) for x in sizes) <= 400


def test_empty_table(table):
    assert s.shard_by_bytes(table([])).collect() == []


def test_whole_rows_reach_their_shards(table, rows_of):
    # Only digests were dealt; the texts stayed where they were read.
    rows = [(i * 7 % 50, "t%d " % i * (i % 9)) for i in range(60)] + HARD
    docs = table(rows, extra=True)
    got = s.shard_rows(docs, 4)
    assert rows_of(got.select("row.*")) == rows_of(docs)
    held = got.collect()
    told = s.shard_by_bytes(docs, 4).collect()
    digest = lambda t: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
    assert sorted(((r["row"]["doc_id"], *digest(r["row"]["text"]), r["shard"], r["slot"]) for r in held), key=repr) == sorted(
        ((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in told), key=repr)


def test_digests_are_taken_after_the_exchange(table):
    plan = s.shard_by_bytes(table([(i, "x" * i) for i in range(40)]), 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("crc32") < plan.index("Window")
    assert "crc32" not in plan[plan.index("Window"):]
