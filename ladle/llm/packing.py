"""Pack token sequences by vector best-fit.

A sequence has three capacities: tokens, documents and attention cost (the sum of the squared lengths of
its pieces). Pieces come longest first; each goes to the open sequence that fits under every capacity
and scores best, by the smallest weighted norm of what would be left or by the largest weighted dot
product of need and residual. Pieces of one length are placed together, so a task does one vector
operation per length.

Pieces are dealt to buckets of a bounded number of pieces; a bucket is packed by one task from lengths
alone, and the number of buckets grows with the data. Texts are tokenised where they are read; ids never
move.

Defined results: a null text is an empty one (its single token is the end id); repeated rows are packed
each for itself; other columns of the input are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ladle.llm.mapping import map_texts
from ladle.session import settle

#: Distinct parts of texts that a worker keeps; beyond it the memory starts anew.
REMEMBERED = 400_000
#: Longer ones are encoded but not kept.
KEPT_LENGTH = 48


class Capacity(NamedTuple):
    """What a sequence holds at most, and the weight of each in the choice of a sequence."""

    tokens: int
    documents: int
    attention: int
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)


#: Kinds of characters to the pre-tokeniser, whose pattern is fixed by the vocabulary file: 's|'t|'re|'ve|'m|'ll|'d,
#: letters, one number, or signs. Those beyond Latin-1 are foreign.
SPACE, SIGN, LETTER, NUMBER, FOREIGN = range(5)


def _kind(char: str) -> int:
    """Of a Latin-1 character; there the numbers that are not digits are six."""
    if not Tokens._WORD.match(char):
        return SPACE
    if re.match(r"[\d²³¹¼½¾]", char):
        return NUMBER
    return LETTER if re.match(r"[^\W_]", char) else SIGN


class Tokens:
    """Ids of texts by `tokenizers`; a part of a text is merged once as long as a bounded memory holds it.

    The pre-tokeniser never joins what white space separates, and normalisation does not act across it,
    so the ids of a text are those of its words in turn. Words of Latin-1 letters, which normalisation
    only lower-cases, are taken apart further, as the pre-tokeniser does, into parts that are merged
    independently; other words are encoded whole. Texts are taken apart side by side: characters by their
    kind, distinct parts by dictionary encoding, ids by one gather.
    """

    # What str.split() takes for white space and the library does not.
    _CONTROLS = "\x1c\x1d\x1e\x1f"
    _WORD = re.compile("[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
    _FAR_SPACES = np.array([0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)
    _LOWER = np.array([ord(chr(c).lower()) for c in range(256)] + [0], np.uint8)

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.merge = self.model.model.tokenize
        # Merges act on bytes, each written as a character of its own.
        written = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.written = {b: w for c in map(chr, range(256)) for b, w in zip(c.encode(), written(c)[0][0], strict=True)}
        self.kinds = np.array([_kind(chr(c)) for c in range(256)] + [FOREIGN], np.uint8)
        self.parts: dict[str, bytes] = {}

    def _encode(self, units: list[str]) -> list[bytes]:
        found = self.model.encode_batch_fast(units, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        learnt = {}
        if plain := [p for p in parts if p.isascii() or max(p) < "\u0100"]:
            written = " ".join(plain).encode().decode("latin-1").translate(self.written)
            learnt = {p: array("I", [t.id for t in self.merge(w)]).tobytes()
                      for p, w in zip(plain, written.split(self.written[ord(" ")]), strict=True)}
        if other := [p for p in parts if p not in learnt]:
            learnt |= zip(other, self._encode(other), strict=True)
        if len(self.parts) + len(learnt) > REMEMBERED:
            self.parts.clear()
        self.parts.update((p, ids) for p, ids in learnt.items() if len(p) <= KEPT_LENGTH)
        return learnt

    def _cut(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Characters without white space, lower-cased where words are of Latin-1; where their parts begin
        among them; and how many of them stand before each character given. `codes` ends in a space."""
        small = codes if codes.itemsize == 1 else np.minimum(codes, 256)
        kinds, lower = self.kinds[small], self._LOWER[small]
        far = np.flatnonzero(kinds == FOREIGN)
        if len(far):
            kinds[far[np.isin(codes[far], self._FAR_SPACES)]] = SPACE
            far = far[kinds[far] == FOREIGN]
        if len(far):  # their words stay whole
            spaces = np.flatnonzero(kinds == SPACE)
            after = np.unique(np.searchsorted(spaces, far))
            begin = np.where(after > 0, spaces[after - 1] + 1, 0)
            size = spaces[after] - begin
            kinds[np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())] = FOREIGN
            lower = np.where(kinds == FOREIGN, codes, lower)
        begins = np.ones(len(codes), bool)
        np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
        begins |= kinds == NUMBER
        # An apostrophe that is a run of its own, with letters behind it that may be an ending.
        at = np.flatnonzero((lower == ord("'")) & begins & (kinds == SIGN))
        at = at[kinds[at + 1] == LETTER]
        first, second = lower[at + 1], lower[np.minimum(at + 2, len(lower) - 1)]
        one = np.isin(first, np.frombuffer(b"stmd", np.uint8))
        two = (((first == ord("r")) | (first == ord("v"))) & (second == ord("e"))
               | (first == ord("l")) & (second == ord("l")))
        ending = one | two
        begins[at[ending] + 1] = False
        begins[(at + np.where(one, 2, 3))[ending]] = True
        held = kinds != SPACE
        before = np.cumsum(held)
        before -= held
        return lower[held], before[begins & held], before

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if not texts:
            return []
        joined = " ".join(texts) + " "
        if any(s in joined for s in (*self.special, *self._CONTROLS)):
            odd = [any(s in t for s in (*self.special, *self._CONTROLS)) for t in texts]
            if any(odd):
                plain = iter(self.batch([t for t, o in zip(texts, odd, strict=True) if not o]))
                return [self._odd(t) if o else next(plain) for t, o in zip(texts, odd, strict=True)]
        try:
            codes = np.frombuffer(joined.encode("latin-1"), np.uint8)
        except UnicodeEncodeError:
            codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        lower, begins, before = self._cut(codes)
        codec = "latin-1" if lower.itemsize == 1 else "utf-32-le"
        offsets = np.append(begins, len(lower)) * lower.itemsize
        found = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(lower)]
        ).dictionary_encode()
        parts = [p.decode(codec) for p in found.dictionary.to_numpy(zero_copy_only=False).tolist()]
        known = [self.parts.get(p) for p in parts]
        new = [p for p, ids in zip(parts, known, strict=True) if ids is None]
        learnt = self._learn(new) if new else {}
        known = [learnt[p] if ids is None else ids for p, ids in zip(parts, known, strict=True)]
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        flat = np.frombuffer(b"".join(known), "<u4")
        which = found.indices.to_numpy()
        size = sizes[which]
        ends = np.cumsum(size)
        ids = flat[np.repeat((np.cumsum(sizes) - sizes)[which] - ends + size, size) + np.arange(size.sum())]
        at = np.cumsum([len(t) + 1 for t in texts])[:-1]  # where the next text begins
        return np.split(ids, np.append(0, ends)[np.searchsorted(begins, before[at])])

    def _odd(self, text: str) -> np.ndarray:
        """Ids of a text that holds special tokens or controls."""
        units = [text] if any(s in text for s in self.special) else self._WORD.findall(text)
        return np.frombuffer(b"".join(self._encode(units)), "<u4")

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return self.batch([text])[0].tobytes()


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    return Tokens(path)


PIECES = StructType([StructField("doc_id", LongType()), StructField("piece", IntegerType()),
                     StructField("start", LongType()), StructField("length", LongType()),
                     StructField("ids_crc32", LongType())])


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int, size: int, text: str = "text",
           id: str = "doc_id") -> DataFrame:
    """Documents as token pieces: ids, then `end_id`; only what is longer than `size` is cut."""
    def kernel(ids: list, texts: list) -> list:
        of, rows = tokens(tokenizer_path), []
        end = np.array([end_id], "<u4").tobytes()
        for doc, found in zip(ids, of.batch([t or "" for t in texts]), strict=True):
            raw = found.tobytes() + end
            for n, at in enumerate(range(0, len(raw), 4 * size)):
                part = raw[at:at + 4 * size]
                rows.append((doc, n, at // 4, len(part) // 4, zlib.crc32(part)))
        return list(zip(*rows, strict=True)) or [[]] * 5
    return map_texts(docs, kernel, PIECES, text, (id,))


def best_fit(lengths: np.ndarray, capacity: Capacity, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; `lengths` in any order, none above the token capacity."""
    limits = np.array(capacity[:3], np.int64)
    weights = np.array(capacity.weights) / limits.astype(float) ** 2
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    left = np.empty((0, 3), np.int64)  # of the open sequences
    number = np.empty(0, np.int64)
    opened, at = 0, 0
    for length, count in zip(*(x[::-1] for x in np.unique(lengths, return_counts=True)), strict=True):
        need = np.array([length, 1, length * length])
        if (need > limits).any():
            raise ValueError("a piece is over the capacity of an empty sequence")
        # Nothing that follows is longer, but a sequence without room for any of it is closed.
        open_ = (left >= np.minimum(need, [1, 1, 1])).all(axis=1)
        left, number = left[open_], number[open_]
        fits = np.flatnonzero((left >= need).all(axis=1))
        rest = left[fits]
        score = (((rest - need) ** 2) @ weights if rule == "norm" else -((rest * need) @ weights))
        fits = fits[np.argsort(score, kind="stable")]
        room = (left[fits] // need).min(axis=1)
        before = np.cumsum(room) - room
        taken = np.clip(count - before, 0, room)
        if (short := count - int(taken.sum())) > 0:  # the rest opens sequences
            each = int((limits // need).min())
            more = -(-short // each)
            left = np.vstack([left, np.tile(limits, (more, 1))])
            number = np.concatenate([number, np.arange(opened, opened + more)])
            fits = np.concatenate([fits, np.arange(len(left) - more, len(left))])
            taken = np.concatenate([taken, np.full(more, each)])
            taken[-1] -= more * each - short
            opened += more
        fits, taken = fits[taken > 0], taken[taken > 0]
        items = order[at:at + count]
        nth = np.arange(count) - np.repeat(np.cumsum(taken) - taken, taken)
        sequence[items] = np.repeat(number[fits], taken)
        offset[items] = np.repeat(limits[0] - left[fits, 0], taken) + nth * length
        left[fits] -= taken[:, None] * need
        at += count
    return sequence, offset


#: Pieces of a bucket: enough for sequences to fill, few enough for one task.
BUCKET = 50_000


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: Capacity = Capacity(2048, 2048, 2048 ** 2),
         rule: str = "norm", bucket: int = BUCKET, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = settle(pieces(docs, tokenizer_path, end_id, capacity.tokens, text, id), "pieces")
    buckets = max(1, -(-cut.count() // bucket))
    packed = StructType([*PIECES, StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32")])
        base, part = 0, TaskContext.get().partitionId()
        for begin in range(0, len(rows), 4 * bucket):  # an uneven deal stays within a task's memory
            some = rows.slice(begin, 4 * bucket).combine_chunks()
            sequence, offset = best_fit(some["length"].to_numpy(), capacity, rule)
            yield from (some.append_column("sequence_id", pa.array((part << 40) + base + sequence))
                        .append_column("offset", pa.array(offset)).to_batches())
            base += int(sequence.max()) + 1

    return cut.repartition(buckets, F.xxhash64("doc_id", "piece", "ids_crc32")).mapInArrow(run, packed)
