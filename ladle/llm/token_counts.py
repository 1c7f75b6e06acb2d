"""Token counts of texts under a sentencepiece BPE vocabulary, with a whole-token shortcut.

Offline, once per worker: a pre-token is a run of letters or a run of other characters, with the word
marks before it; every vocabulary string is shown to be one pre-token, so merges never cross from one
to the next; and each vocabulary string is proved, by encoding it alone, to be one token. Counting then
splits a text into pre-tokens, counts the proved ones directly and merges only the others, each distinct
one once as long as a bounded memory holds it. A vocabulary that fails the proof is encoded whole.

Defined results: a null text is an empty one (0 bytes, 0 tokens); repeated rows are answered one by
one; other columns of the input are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from ladle.llm.mapping import map_texts

MARK = "▁"
#: Distinct words, and merged pre-tokens, that a worker keeps; beyond it the memory starts anew.
REMEMBERED = 300_000
#: Longer words are counted but not kept.
KEPT_LENGTH = 64


# Superscript digits are neither letters nor digits to `re`; here they go with the other characters.
_PRETOKEN = re.compile(rf"{MARK}*[^\W\d_²³¹]+|{MARK}*(?:(?!{MARK})[\W\d_²³¹])+|{MARK}+")
#: Never part of a longer piece: what is encoded after it stands alone.
_APART = "\n"


class Counting:
    """Counts tokens as `sentencepiece` does, without beginning, end or added special tokens."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        usual = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size()) if not (
            self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        self.splits = (all(_PRETOKEN.fullmatch(p) and _APART not in p for p in usual) and self._plain())
        self.apart = self._encoded("")
        self.apart_id = self.model.encode(_APART)[-1]
        self.whole = {p for p in usual if self._encoded(p) == self.apart + 1}
        self.known: dict[str, int] = {}
        self.merged: dict[str, int] = {}

    def _plain(self) -> bool:
        """The model changes nothing in a text but spaces to marks, and puts one mark before it."""
        probe = "  Ａ é ﬁ\té\n\r ²  x y　z "
        return self.model.normalize(probe) == MARK + probe.replace(" ", MARK)

    def _encoded(self, pretoken: str) -> int:
        return len(self.model.encode(_APART + pretoken))

    def _merge(self, pretokens: list[str]) -> dict[str, int]:
        """Tokens of pre-tokens that stand apart in one encoding."""
        ids = self.model.encode(_APART + _APART.join(pretokens))
        cuts = [i for i, t in enumerate(ids) if t == self.apart_id] + [len(ids)]
        return {p: b - a - 1 for p, a, b in zip(pretokens, cuts[:-1], cuts[1:], strict=True)}

    def _learn(self, words: list[str]) -> dict[str, int]:
        """Tokens of words not known yet: whole tokens at once, the rest by merging."""
        whole, merged = self.whole, self.merged
        parts = [[w] if w in whole else _PRETOKEN.findall(w) for w in words]
        rest = {p: merged.get(p) for ps in parts for p in ps if p not in whole}
        new = [p for p, n in rest.items() if n is None]
        alone = [p for p in new if _APART in p]
        fresh = {p: self._encoded(p) - self.apart for p in alone}
        fresh |= self._merge([p for p in new if p not in fresh]) if len(alone) < len(new) else {}
        rest |= fresh
        learnt = {w: sum(1 if p in whole else rest[p] for p in ps) for w, ps in zip(words, parts, strict=True)}
        for memory, found in ((merged, fresh), (self.known, learnt)):
            if len(memory) + len(found) > REMEMBERED:
                memory.clear()
            memory.update((w, n) for w, n in found.items() if len(w) <= KEPT_LENGTH)
        return learnt

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.splits:
            return len(self.model.encode(text))
        # Words with the marks before them; a mark typed as such is a space to the model.
        words = Counter(_WORD.findall(MARK + text.replace(" ", MARK)))
        seen = {w: self.known.get(w) for w in words}
        seen.update(self._learn([w for w, n in seen.items() if n is None]))
        return sum(n * seen[w] for w, n in words.items())


_WORD = re.compile(f"{MARK}+[^{MARK}]*")


@lru_cache(maxsize=2)
def counting(model_path: str) -> Counting:
    return Counting(model_path)


COUNTS = StructType([StructField("doc_id", LongType()), StructField("n_bytes", LongType()),
                     StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())])


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than `limit` tokens)."""
    def kernel(ids: list, texts: list) -> list:
        by = counting(model_path)
        counts = [by.count(t or "") for t in texts]
        return [ids, [len((t or "").encode()) for t in texts], counts, [n > limit for n in counts]]
    return map_texts(docs, kernel, COUNTS, text)
