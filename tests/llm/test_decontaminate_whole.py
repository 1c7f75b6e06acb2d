"""Seeds that are as wide as the tolerance, and scripts without spaces."""

from itertools import combinations

import pytest

from ladle.llm import decontaminate as d


@pytest.mark.parametrize("size", range(d.LEAST, d.WINDOW + 1))
def test_every_allowed_placement_leaves_a_seed(size):
    fits = [{o + i for i, bit in enumerate(mask) if bit == "1"} for mask in d.MASKS for o in range(size - d.SPAN + 1)]
    lost = [s for s in combinations(range(size), size // d.ONE_IN) if not any(f.isdisjoint(s) for f in fits)]
    assert not lost


def test_scripts_without_spaces(table, spark):
    said = "我们今天早上在图书馆里读了一本关于天文学的书"
    other = said[:4] + "昨" + said[5:]
    benchmark = spark.createDataFrame([(1, said), (2, "吾輩は猫である。名前はまだ無い。")], "item_id long, text string")
    docs = table([(1, f"他说{other}。然后回家"), (2, "完全不同的一句话没有任何重复的内容在里面"), (3, "so 吾輩は猫である、名前はまだ無い end"),
                  (4, "plain words only, nothing else in here at all")])
    got = {r["doc_id"]: r["contaminated"] for r in d.decontamination(docs, benchmark).collect()}
    assert got == {1: True, 2: False, 3: True, 4: False}


def test_rows_that_share_an_id_are_told_apart(table, spark):
    item = " ".join(f"w{i}" for i in range(20))
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = table([(1, item), (1, "clean one"), (None, item), (None, "clean two"), (2, "clean three")])
    got = sorted((r["doc_id"] or 0, r["contaminated"]) for r in d.decontamination(docs, benchmark).collect())
    assert got == [(0, False), (0, True), (1, False), (1, True), (2, False)]
    assert {r["text"] for r in d.clean_documents(docs, benchmark).collect()} >= {"clean one", "clean three"}
    assert item not in {r["text"] for r in d.clean_documents(docs, benchmark).collect()}
