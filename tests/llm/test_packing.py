import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from ladle.llm import packing as p
from ladle.llm.catalog import tokenizer
from hard_rows import HARD

PATH = tokenizer("word_bpe_49k.json")
TEXTS = ["it's", "O'NEILL'S", "a\x1cb", "x\x85y", "é́", "Σ ΑΣ", "a<|endoftext|>b", "<|", "Ⅷ²1 23", "日本🤗_­", "İ!!", "ﬁ ﬁ", "　"]


def test_ids_equal_the_library(monkeypatch):
    monkeypatch.setattr(p, "REMEMBERED", 50)
    library, tokens, rnd = Tokenizer.from_file(PATH), p.Tokens(PATH), random.Random(3)
    some = TEXTS + ["".join(rnd.choice(TEXTS + [" ", "\n", "a", "B", "1", "."]) for _ in range(rnd.randint(0, 8)))
                    for _ in range(2000)]
    for text in some:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(tokens.ids(text), "<u4").tolist() == want, text


def test_ids_of_many_texts_equal_the_library(monkeypatch):
    monkeypatch.setattr(p, "REMEMBERED", 50)
    library, tokens, rnd = Tokenizer.from_file(PATH), p.Tokens(PATH), random.Random(4)
    near = ["'", "'S", "'re", "''ve", "'l", "'LL", "s", "E", "É", "ß", "×", "²", "7", "_", "!", ".", " ", "\xa0", "\n", "\0"]
    for some in [near, near + ["\u2003", "日", "—", "Σ"], near + TEXTS] * 40:
        texts = ["".join(rnd.choice(some) for _ in range(rnd.randint(0, 14))) for _ in range(50)] + [""]
        for text, got in zip(texts, tokens.batch(texts), strict=True):
            assert got.tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert tokens.batch([]) == []


def test_a_part_is_merged_once_for_many_texts(monkeypatch):
    tokens, learnt, learn = p.Tokens(PATH), [], p.Tokens._learn
    monkeypatch.setattr(p.Tokens, "_learn", lambda self, parts: learnt.append(sorted(parts)) or learn(self, parts))
    texts = [f"{word}{sign}" for word in ("Stone", "STONE", "stone's") for sign in (".", ",", "!", "") * 20]
    tokens.batch(texts)
    assert learnt == [["!", "'s", ",", ".", "stone"]]


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [p.Capacity(100, 100, 10_000), p.Capacity(100, 3, 10_000), p.Capacity(100, 9, 4_000)])
def test_every_capacity_holds(rule, capacity):
    rnd = np.random.default_rng(7)
    lengths = rnd.integers(1, 60, 3000)
    sequence, offset = p.best_fit(lengths, capacity, rule)
    members = defaultdict(list)
    for s, o, n in zip(sequence.tolist(), offset.tolist(), lengths.tolist()):
        members[s].append((o, n))
    for placed in members.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:i]) for i in range(len(placed))]
        assert sum(n for _, n in placed) <= capacity.tokens and len(placed) <= capacity.documents
        assert sum(n * n for _, n in placed) <= capacity.attention
    if capacity.documents == 100:
        assert len(members) <= 1.02 * lengths.sum() / 100 + 1


def test_pieces_and_places(table):
    rows = HARD + list(enumerate(TEXTS, 100))
    library = Tokenizer.from_file(PATH)
    got = p.pack(table(rows, extra=True), PATH, capacity=p.Capacity(256, 256, 256 ** 2), bucket=7).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for n, at in enumerate(range(0, len(ids), 256)):
            part = np.array(ids[at:at + 256], "<u4")
            want.append((i, n, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    members = defaultdict(list)
    for r in got:
        members[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in members.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:i]) for i in range(len(placed))]
        assert sum(n for _, n in placed) <= 256
    assert p.pack(table([]), PATH).collect() == []


def test_a_piece_over_a_capacity_is_an_error():
    with pytest.raises(ValueError):
        p.best_fit(np.array([50]), p.Capacity(100, 5, 2_000))
