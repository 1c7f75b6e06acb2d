"""Porter stemmer (M. F. Porter, "An algorithm for suffix stripping", 1980) as Columns.

Off by default. Each step is one expression over the word so far, so stemming stays in the JVM
and needs neither a Python worker nor a shuffle of the vocabulary. The paper's conditions on the
stem before a suffix become patterns over whole words: `_M0` is m > 0, `_M1` is m > 1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ladle.functions.binding import let

# The paper's suffix tables of steps 2, 3 and 4.
_STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
_STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP4 = "al ance ence er ic able ible ant ement ment ent sion tion ou ism ate iti ous ive ize".split()

# Word shapes. `y` is a vowel after a consonant, a consonant at the start or after a vowel.
_CON = r"(?:[^aeiouy]|(?<![^aeiou])y)"
_VOW = r"(?:[aeiou]|(?<=[^aeiou])y)"
_HEAD = rf"^{_CON}*"
_GROUP = rf"{_VOW}+{_CON}+"
_M0 = rf"{_HEAD}{_GROUP}"
_M1 = rf"{_HEAD}{_GROUP}{_GROUP}"
_ONE = rf"{_HEAD}{_GROUP}{_VOW}*$"
_HAS_VOWEL = rf"{_HEAD}{_VOW}"
_SHORT_END = rf"{_CON}{_VOW}(?![wxy]){_CON}$"


def _cut(w: Column, n: int, add: str = "") -> Column:
    stem = F.left(w, F.length(w) - n)
    return F.concat(stem, F.lit(add)) if add else stem


def _plural(w: Column) -> Column:
    return (F.when(w.endswith("sses") | w.endswith("ies"), _cut(w, 2))
             .when(w.endswith("ss") | ~w.endswith("s"), w)
             .otherwise(_cut(w, 1)))


def _repair(stem: Column) -> Column:
    """After -ed or -ing is gone."""
    double = stem.rlike(rf"({_CON})\1$") & ~stem.rlike("[lsz]$")
    return (F.when(stem.rlike("(?:at|bl|iz)$"), F.concat(stem, F.lit("e")))
             .when(double, _cut(stem, 1))
             .when(stem.rlike(_ONE) & stem.rlike(_SHORT_END), F.concat(stem, F.lit("e")))
             .otherwise(stem))


def _past(w: Column) -> Column:
    def strip(n: int) -> Column:
        return let(_cut(w, n), lambda stem: F.when(stem.rlike(_HAS_VOWEL), _repair(stem)).otherwise(w))
    return (F.when(w.endswith("eed"), F.when(_cut(w, 3).rlike(_M0), _cut(w, 1)).otherwise(w))
             .when(w.endswith("ed"), strip(2))
             .when(w.endswith("ing"), strip(3))
             .otherwise(w))


def _final_y(w: Column) -> Column:
    return F.when(w.endswith("y") & _cut(w, 1).rlike(_HAS_VOWEL), _cut(w, 1, "i")).otherwise(w)


def _swap(w: Column, table: dict[str, str]) -> Column:
    out = F
    for suffix in sorted(table, key=len, reverse=True):  # the longest suffix decides
        stem_fits = _cut(w, len(suffix)).rlike(_M0)
        out = out.when(w.endswith(suffix),
                       F.when(stem_fits, _cut(w, len(suffix), table[suffix])).otherwise(w))
    return out.otherwise(w)


def _drop(w: Column) -> Column:
    out = F
    for suffix in sorted(_STEP4, key=len, reverse=True):
        n = 3 if suffix in ("sion", "tion") else len(suffix)  # -ion goes, its s or t stays
        out = out.when(w.endswith(suffix), F.when(_cut(w, n).rlike(_M1), _cut(w, n)).otherwise(w))
    return out.otherwise(w)


def _final_e(w: Column) -> Column:
    def without(stem: Column) -> Column:
        return F.when(stem.rlike(_M1) | (stem.rlike(_M0) & ~stem.rlike(_SHORT_END)), stem).otherwise(w)
    return F.when(w.endswith("e"), let(_cut(w, 1), without)).otherwise(w)


def _double_l(w: Column) -> Column:
    return F.when(w.endswith("ll") & w.rlike(_M1), _cut(w, 1)).otherwise(w)


def porter(word: Column) -> Column:
    """Stem of an all-lower-case ASCII word of three letters or more; others stay."""
    out = word
    steps = (_plural, _past, _final_y, lambda w: _swap(w, _STEP2), lambda w: _swap(w, _STEP3),
             _drop, _final_e, _double_l)
    for step in steps:
        out = let(out, step)
    return F.when(word.rlike("^[a-z]{3,}$"), out).otherwise(word)
