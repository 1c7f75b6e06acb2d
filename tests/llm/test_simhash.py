import random
from itertools import combinations

import pytest
import xxhash

from ladle.llm import simhash as s
from ladle.llm.components import components
from hard_rows import HARD


def brute_print(text, width=3):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p
    for a, b in combinations(prints, 2):
        if bin(a ^ b).count("1") <= 2:
            root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_against_brute_force(table, rows_of):
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(600)]
    rows = [(i, " ".join(base[: 597 + i % 4])) for i in range(12)]
    rows += [(100 + i, " ".join(rnd.choice(base) for _ in range(rnd.randint(1, 30)))) for i in range(40)] + HARD
    rows.append((300, "ONE two THREE four five six seven"))
    prints = {r: brute_print(r[1]) for r in rows}
    roots = brute_components(set(prints.values()))
    least = {}
    for (i, _), p in prints.items():
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    want = [(i, f"{prints[i, t]:016x}", least.get(roots[prints[i, t]])) for i, t in rows]
    assert rows_of(s.simhash_components(table(rows, extra=True))) == sorted(want, key=repr)
    assert s.simhash_components(table([])).collect() == []


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_miss_no_pair(spark, distance):
    rnd = random.Random(distance)
    prints = {rnd.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for _ in range(3):
            for b in rnd.sample(range(64), rnd.randint(1, distance + 1)):
                p ^= 1 << b
            prints.add(p)
    signed = {p: p - (p >> 63 << 64) for p in prints}
    got = sorted(map(tuple, s.links(spark.createDataFrame([(v,) for v in signed.values()], "fp long"), distance).collect()))
    want = sorted(tuple(sorted((signed[a], signed[b]))) for a, b in combinations(prints, 2)
                  if bin(a ^ b).count("1") <= distance)
    assert got == want


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(5, 5), (7, 6), (130, 129)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "src long, dst long")).collect()))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 131)}
    assert components(spark.createDataFrame([], "src long, dst long")).collect() == []


def test_count_rejects_pairs_that_share_too_few_bytes(spark):
    """Pairs of 5 shared bytes meet in one posting and are rejected by their tally; those of 6 meet in six."""
    rnd = random.Random(7)
    rows, shared = [], {}
    for i in range(60):
        p = rnd.getrandbits(64)
        q = p ^ sum(rnd.randint(1, 255) << 8 * b for b in rnd.sample(range(8), 1 + i % 4))
        rows += [p, q]
        p, q = (x - (x >> 63 << 64) for x in (p, q))
        shared[min(p, q), max(p, q)] = 8 - (1 + i % 4)
    signed = spark.createDataFrame([(p - (p >> 63 << 64),) for p in rows], "fp long")
    got = {(r["src"], r["dst"]): r["tally"] for r in s.tallies(signed, 2).collect()}
    assert got == {pair: {5: 1, 6: 6, 7: 21}[n] for pair, n in shared.items() if n >= 5}
    assert s.guaranteed(2) == 6 and any(n < s.guaranteed(2) for n in got.values())


def test_one_of_each_group_stays(table):
    """Against components of the fingerprints: of each the smallest id stays, null ids last."""
    rnd = random.Random(9)
    rows = []
    for i in range(40):
        words = [f"{rnd.choice('abcdefg')}{rnd.randint(0, 9999)}" for _ in range(rnd.choice((5, 400)))]
        rows.append((i, " ".join(words)))
        for copy in (1, 2):
            changed = words[:-copy]
            rows.append((1000 * copy + i, " ".join(changed)))
    rows += [(5000 + i, rows[3][1]) for i in range(20)] + [(0, rows[0][1]), (6000, None), (6001, ""), (7, "another text of this id")]
    rows += [(None, "no id one"), (None, "no id one"), (None, "no id two"), (None, rows[0][1])]
    prints = {r: brute_print(r[1]) for r in rows}
    roots = brute_components(set(prints.values()))
    want = {}
    for r, p in prints.items():
        want[roots[p]] = min(want.get(roots[p], r), r, key=lambda x: (x[0] is None, x[0] or 0))
    kept = s.one_of_each(table(rows, extra=True))
    assert kept.columns == table([], extra=True).columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted(want.values(), key=repr)
    assert len(want) < 100
    assert s.one_of_each(table([])).collect() == []
