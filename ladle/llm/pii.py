"""Personal data in texts, also behind disguises.

A transducer rewrites a text into a plain form and keeps, for every rewritten stretch, where it came
from: look-alike letters become ASCII, invisible characters go, spelled digits become digits, and
`(at)`, `dot` and their like become `@` and `.`. The detectors run on the plain form too, and what
they find is mapped back to code points of the text as written.

Defined results: a null text is an empty one and has no spans; repeated rows are answered one by one;
a null doc_id stays null; other columns of the input are not looked at. An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from typing import NamedTuple
from unicodedata import normalize

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ladle.llm.mapping import map_texts, sliced

KINDS = ("email", "ip", "card", "phone")

# -- Detectors ------------------------------------------------------------------------

_LOCAL = "A-Za-z0-9._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_TAIL = re.compile(f"[{_LOCAL}]+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
# A digit that follows a digit, or a digit and one separator, was passed by the match before it.
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Found from the `@` outwards, so that long words without one cost nothing."""
    found, last = [], 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at:
            found.append((start, m.end()))
            last = m.end()
    return found


def ips(text: str) -> list[tuple[int, int]]:
    def small(part: str) -> bool:
        part = part.lstrip("0")
        return len(part) < 3 or len(part) == 3 and part <= "255"
    return [m.span() for m in _IP.finditer(text) if all(map(small, m.groups()))]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text)
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]


DETECTORS = dict(zip(KINDS, (emails, ips, cards, phones), strict=True))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Undisguised identifiers, by kind as listed, then by start."""
    has_digit = any(c in text for c in "0123456789")
    found = []
    for kind, detect in DETECTORS.items():
        needed = {"email": "@" in text, "phone": "+" in text}.get(kind, has_digit)
        found += [(kind, a, b) for a, b in detect(text)] if needed else []
    return found


# -- Transducer -----------------------------------------------------------------------

# Compatibility forms of one ASCII letter or digit: full-width, circled, of the mathematical alphabets, raised and so on.
# Latin-1 is left out, where raised digits and letters are ordinary writing.
LOOKALIKES = {c: ord(plain) for c in range(0x100, 0x20000)
              if len(plain := normalize("NFKC", chr(c))) == 1 and plain.isascii() and plain.isalnum()}
# Look-alikes of ASCII characters, one to one: Cyrillic, Greek, dots and at signs.
LOOKALIKES |= str.maketrans(
    "аАВеЕіІјЈкКмМНоОрРсСТуУхХѕЅԁԛԝ" "αΑΒΕΖΗΙΚΜΝοΟρΡΤυΥΧ" "ινγκτχωϲϳ" "。．｡․∙﹫＋‐‑‒–−",
    "aABeEiIjJkKmMHoOpPcCTyYxXsSdqw" "aABEZHIKMNoOpPTuYX" "ivyktxwcj" ".....@+-----")
# Full-width forms stand at a fixed distance from ASCII.
LOOKALIKES.update({c + 0xFEE0: c for c in range(0x21, 0x7F)})
# Decimal digits of other scripts, by the first code point of their ten.
for _zero in (0x0660, 0x06F0, 0x0966, 0x09E6, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):
    LOOKALIKES.update({_zero + d: 0x30 + d for d in range(10)})
INVISIBLE = "­​‌‍⁠﻿"

# Digit words of the four languages of the tables.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5",
    "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7",
    "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6",
    "siete": "7", "ocho": "8", "nueve": "9",
}
_DOT = "dot|punkt|punto|point"
_AT = "at|arroba|ät"
_TOP = ("com|org|net|edu|gov|int|info|biz|io|dev|app|me|co|uk|us|eu|de|fr|es|it|ch|at|nl|be|pt|pl|se|dk|no|fi|ie|ca|au|"
        "in|jp|cn|br|mx|ar|ru|test|example|invalid|local|social|online|site|shop|store|xyz|tech|cloud|blog|ai|tv|cc|pro|name|"
        "mobi|live|news|page|link|club|world|space|website|email|group|team|work|agency|digital|media|studio|design")
_DIGIT = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_NUMERAL = rf"(?:{_DIGIT}|plus|{_DOT}|[0-9]+)"
#: Four digit words in a row, with what may stand between and around them.
_SPELLED = re.compile(
    rf"(?:\bplus\b[ ,-]{{0,2}}|\+ ?)?\b(?:{_NUMERAL}\b[ ,.()-]{{1,3}}){{3,}}{_NUMERAL}\b", re.I)
_NUMERAL_PART = re.compile(rf"{_DIGIT}|plus|{_DOT}|[0-9]+|[^\w]+", re.I)
_AT_SIGN = re.compile(
    rf"\s*[\[({{<]\s*(?:{_AT}|@)\s*[\])}}>]\s*|&#64;|&commat;|%40|(?<=\w)\s+@\s+(?=\w)"
    # Bare words count only before a domain that is spelled to its end, in brackets or to a usual one.
    rf"|(?<=\w)\s+(?:{_AT})\s+(?=[A-Za-z0-9-]+(?:\s*[\[({{<]\s*(?:{_DOT}|\.)\s*[\])}}>]\s*|&#46;)[A-Za-z0-9]"
    rf"|(?:[A-Za-z0-9-]+\s+(?:{_DOT})\s+)+(?:{_TOP})\b)",
    re.I)
#: A usual top-level domain, in one case: a sentence that begins with `It` or `In` is none.
_TOP_WORD = rf"(?-i:{_TOP}|{_TOP.upper()})\b"
_BARE_DOT = rf"\s+(?:{_DOT}|\.)\s+"
_DOT_SIGN = re.compile(
    rf"\s*[\[({{<]\s*(?:{_DOT}|\.)\s*[\])}}>]\s*|&#46;|&period;"
    # Bare ones count between digits, in a name before its at sign, and where a domain goes on to its end.
    rf"|(?<=[0-9]){_BARE_DOT}(?=[0-9])"
    rf"|(?<=\w){_BARE_DOT}(?=[\w%+-]+(?:(?:{_BARE_DOT}|\.)[\w%+-]+)*(?:\s*@|\s*[\[({{<]\s*(?:{_AT}|@)|\s+(?:{_AT})\s))"
    rf"|(?<=\w){_BARE_DOT}(?=(?:[A-Za-z0-9-]+(?:{_BARE_DOT}|\.))*{_TOP_WORD})", re.I)

_FOLDED = frozenset(map(chr, LOOKALIKES)) | frozenset(INVISIBLE)
# Apart, because a class that reaches beyond the basic plane is searched entry by entry.
_TRIGGER = re.compile(rf"[{re.escape(''.join(sorted(c for c in _FOLDED if c <= chr(0xFFFF))))}]|[\U00010000-\U0001FFFF]")
#: Stands in every text that _AT_SIGN or _DOT_SIGN matches: a bare `at` needs one of these dots after it.
_SIGN_HINT = re.compile(
    rf"[\[({{<]\s*(?:{_AT}|{_DOT}|@|\.)\s*[\])}}>]|&(?:#64|commat|#46|period);|%40|\s(?:{_DOT}|@|\.)\s", re.I)
#: A digit word in a lower-cased text; spelled numbers hold two.
_DIGIT_WORD = re.compile(rf"(?<!\w)(?:{_DIGIT})(?!\w)")


class Plain(NamedTuple):
    """A rewritten text and its way back: stretch i of `text` starts at `at[i]`, comes from
    `source[i]` on, and is a copy of equal length where `same[i]`."""

    text: str
    at: list[int]
    source: list[int]
    same: list[bool]
    length: int

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """The span's place in the source, and whether any of it was rewritten."""
        first, last = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        begin = self.source[first] + (start - self.at[first]) * self.same[first]
        if self.same[last]:
            stop = self.source[last] + end - self.at[last]
        else:
            stop = self.source[last + 1] if last + 1 < len(self.source) else self.length
        return begin, stop, not all(self.same[first:last + 1])


def _rewrites(text: str) -> list[tuple[int, int, str]]:
    """Stretches of `text` to replace; none overlap."""
    found: list[tuple[int, int, str]] = []
    if not text.isascii() and not _FOLDED.isdisjoint(text):
        found += [(m.start(), m.end(), "" if m[0] in INVISIBLE else m[0].translate(LOOKALIKES))
                  for m in _TRIGGER.finditer(text) if m[0] in _FOLDED]
    return found


def _apply(text: str, changes: list[tuple[int, int, str]]) -> Plain:
    out, at, source, same, done, length = [], [], [], [], 0, 0
    for a, b, new in sorted(changes):
        if a < done:
            continue
        for piece, begin, copied in ((text[done:a], done, True), (new, a, False)):
            if piece or not copied:
                out.append(piece)
                at.append(length)
                source.append(begin)
                same.append(copied)
                length += len(piece)
        done = b
    if done < len(text) or not at:
        out.append(text[done:])
        at.append(length)
        source.append(done)
        same.append(True)
    return Plain("".join(out), at, source, same, len(text))


def _numerals(text: str) -> list[tuple[int, int, str]]:
    """Spelled numbers: words become signs, and what separates two of them goes."""
    found = []
    for m in _SPELLED.finditer(text):
        parts = list(_NUMERAL_PART.finditer(text, m.start(), m.end()))
        if sum(p[0].lower() in DIGIT_WORDS for p in parts) < 2:
            continue
        for p in parts:
            word = p[0].lower()
            if word in DIGIT_WORDS:
                found.append((p.start(), p.end(), DIGIT_WORDS[word]))
            elif word == "plus":
                found.append((p.start(), p.end(), "+"))
            elif word[0].isalpha():
                found.append((p.start(), p.end(), "."))
            elif not word.isdigit() and word.strip() not in ("+", "."):
                found.append((p.start(), p.end(), ""))
    return found


def plain_forms(text: str) -> list[list[Plain]]:
    """Chains of rewritings of `text`; empty for a text without a disguise, which is its own form."""
    first = _apply(text, _rewrites(text)) if not text.isascii() else None
    chain = [first] if first and (first.text != text) else []
    now = chain[-1].text if chain else text
    signs = []
    if _SIGN_HINT.search(now):
        signs = [(m.start(), m.end(), "@") for m in _AT_SIGN.finditer(now)]
        signs += [(m.start(), m.end(), ".") for m in _DOT_SIGN.finditer(now)]
    chains = [chain + [_apply(now, signs)]] if signs else []
    if _DIGIT_WORD.search(now.lower()):
        # Numbers are read in the text as it stands, and again where signs have been put for words.
        for before in [chain, *chains]:
            read = before[-1].text if before else now
            if numbers := _numerals(read):
                chains.append(before + [_apply(read, numbers)])
    return chains or ([chain] if chain else [])


def _held(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of the spans, in order and apart, holds the stretch."""
    i = bisect_right(spans, start, key=lambda s: s[0]) - 1
    return i >= 0 and end <= spans[i][1]


def disguised_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Identifiers of a plain form, as spans of `text`, that no span of their kind holds already.

    A base span that is only a part of one stays beside it.
    """
    # Of one kind, the spans of one form are in order and apart.
    taken: list[dict[str, list[tuple[int, int]]]] = [{k: [] for k in KINDS}]
    for kind, a, b in base:
        taken[0][kind].append((a, b))
    added = []
    for chain in plain_forms(text):
        taken.append({k: [] for k in KINDS})
        for kind, a, b in base_spans(chain[-1].text):
            changed = False
            for form in reversed(chain):
                a, b, touched = form.back(a, b)
                changed |= touched
            if changed and not any(_held(spans[kind], a, b) for spans in taken):
                taken[-1][kind].append((a, b))
                added.append((kind, a, b))
    return added


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Undisguised spans, and all spans, both by kind as listed and then by place."""
    base = base_spans(text)
    added = disguised_spans(text, base)
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), *s[1:])) if added else base


def redact(text: str) -> str:
    """Every span replaced by its kind in angle brackets; overlapping spans become one."""
    spans = sorted((a, b, kind) for kind, a, b in find(text)[1])
    out, done = [], 0
    for a, b, kind in spans:
        if a >= done:
            out += [text[done:a], f"<{kind.upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SPANS = StructType(
    [StructField("doc_id", LongType()), *(StructField(f"n_{k}", LongType()) for k in KINDS),
     StructField("base_sha256", StringType()), StructField("spans", StringType())])


def pii_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document: base spans counted by kind and digested, and all spans (`kind:start:end`)."""
    def kernel(ids: list, texts: list) -> list:
        found = [find(t or "") for t in texts]
        return [ids, *([sum(s[0] == k for s in base) for base, _ in found] for k in KINDS),
                [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found],
                [joined(every) for _, every in found]]
    return map_texts(docs, kernel, SPANS, text)


def redacted(docs: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """`docs` with its text redacted; all columns stay and `n_chars`, if there, follows the text.

    A null text stays null.
    """
    import pyarrow as pa
    from ladle.session import ship_package

    ship_package(docs.sparkSession)
    at = docs.columns.index(text)
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else -1

    def run(batches):
        for batch in sliced(batches, at):
            new = [None if t is None else redact(t) for t in batch.column(at).to_pylist()]
            arrays = list(batch.columns)
            arrays[at] = pa.array(new, batch.schema.field(at).type)
            if counted >= 0:
                arrays[counted] = pa.array([None if t is None else len(t) for t in new],
                                           batch.schema.field(counted).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
