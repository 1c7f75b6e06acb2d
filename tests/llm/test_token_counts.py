import random

import sentencepiece

from ladle.llm import token_counts as t
from ladle.llm.catalog import tokenizer
from hard_rows import HARD

MODEL = tokenizer("piece_bpe_32k.model")
TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b   c", "▁", "a▁b", "▁▁ x", "<s> hi </s>", "<unk>", "<0x41>", "\n\n x\n",
         "é　z  y", "\t \t", "日本語 テスト 🤗", "x" * 3000, "1234 5678²³", "\x00 a", "     " * 7, "﻿ a", "it's O'Neill's"]


def test_counts_equal_the_library(table, rows_of):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rnd = random.Random(1)
    random_ones = ["".join(rnd.choice(" ▁ab<s>\n\té1🤗.²") for _ in range(rnd.randint(0, 14))) for _ in range(500)]
    rows = HARD + list(enumerate(TEXTS + random_ones, 100))
    want = []
    for i, x in rows:
        n = len(library.encode(x or ""))
        want.append((i, len((x or "").encode()), n, n > 10))
    assert rows_of(t.token_counts(table(rows, extra=True), MODEL, limit=10)) == sorted(want, key=repr)
    assert t.token_counts(table([]), MODEL).collect() == []


def test_the_proof_holds_and_memory_is_bounded(monkeypatch):
    counting = t.Counting(MODEL)
    assert counting.splits and len(counting.whole) > 10_000
    monkeypatch.setattr(t, "REMEMBERED", 5)
    assert [counting.count(x) for x in TEXTS] == [len(counting.model.encode(x)) for x in TEXTS]
    assert len(counting.known) <= 40
