"""Text analysis as Column expressions: tokens, stemming, possessives, case, folding.

The chain runs inside whole rows on the JVM, so analysis itself never shuffles.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.porter import porter
from ladle.operators.sizing import small

# Word breaks after UAX #29: letter runs join over . ' ’ : ·, digit runs over . , ; ' ’,
# neighbouring letter and digit runs are one token, Han and Hiragana stand alone; a run of
# underscores alone is no token. Every quantifier is possessive: the plain form overflows the
# stack on long tokens. Han and Hiragana are ranges, since a script test per letter is slow.
_IDEOGRAPHS = (r"\x{2E80}-\x{2FD5}\x{3005}\x{3007}\x{3021}-\x{3029}\x{3038}-\x{303B}\x{3041}-\x{3096}"
               r"\x{309D}-\x{309F}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAD9}\x{20000}-\x{323AF}")
_LETTERS = rf"[\p{{L}}\p{{M}}_&&[^{_IDEOGRAPHS}]]++"
_DIGITS = r"[\p{N}_]++"
TOKEN = (
    rf"[{_IDEOGRAPHS}]\p{{M}}*+"
    rf"|(?=_*+[\p{{L}}\p{{M}}\p{{N}}])(?:{_LETTERS}(?:[.'’:·]{_LETTERS})*+|{_DIGITS}(?:[.,;'’]{_DIGITS})*+)++"
)
MAX_TOKEN = 255

# The default English stop-word set of the search server.
ENGLISH_STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the "
    "their then there these they this to was will with"
).split()


def tokens(text: Column) -> Column:
    """Array of raw tokens in order; longer ones are cut every 255 characters."""
    found = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    cut = F.flatten(F.transform(
        found, lambda t: F.regexp_extract_all(t, F.lit(rf"(?s).{{1,{MAX_TOKEN}}}"), F.lit(0))))
    may_be_long = text.rlike(rf"(?<!\S)\S{{{MAX_TOKEN + 1}}}")
    return F.when(may_be_long, cut).otherwise(found)


def bag_tokens(lines: Column) -> Column:
    """Tokens of a multi-valued field: all lines, one bag."""
    return tokens(F.array_join(lines, "\n"))


def light_stem(t: Column) -> Column:
    """Plural stemmer (Harman 1991); only all-lower-case ASCII tokens change."""
    return (
        F.when(~t.endswith("s") | ~t.rlike(r"^[a-z]{3,}$") | t.endswith("us") | t.endswith("ss"), t)
         .when(t.rlike(r"[^ae]ies$"), F.concat(F.left(t, F.length(t) - 3), F.lit("y")))
         .when(t.rlike(r"[iaoe]es$"), t)
         .otherwise(F.left(t, F.length(t) - 1))
    )


def strip_possessive(t: Column) -> Column:
    return F.when(t.endswith("s") | t.endswith("S"), F.regexp_replace(t, r"['’＇][sS]$", "")).otherwise(t)


def _fold_pairs() -> tuple[str, str, dict[str, str]]:
    """Folding derived from canonical decomposition, plus letters that have none."""
    source, target = [], []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if base.isascii() and base.isalpha() and marks:
            source.append(chr(code))
            target.append(base)
    for code in range(0xFF01, 0xFF5F):  # full-width forms sit at a fixed distance
        source.append(chr(code))
        target.append(chr(code - 0xFEE0))
    # Letters and quotes without a decomposition.
    single = {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L",
              "ħ": "h", "Ħ": "H", "ı": "i", "ŧ": "t", "Ŧ": "T", "ŋ": "n", "Ŋ": "N", "ĸ": "q",
              "ſ": "s", "ƒ": "f", "‘": "'", "’": "'", "‛": "'"}
    double = {"ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th",
              "Þ": "TH", "ĳ": "ij", "Ĳ": "IJ", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl"}
    return "".join(source) + "".join(single), "".join(target) + "".join(single.values()), double


_FOLD_FROM, _FOLD_TO, _FOLD_DOUBLE = _fold_pairs()


def fold_ascii(t: Column) -> Column:
    wide = F.translate(t, _FOLD_FROM, _FOLD_TO)
    for letter, pair in _FOLD_DOUBLE.items():
        wide = F.replace(wide, F.lit(letter), F.lit(pair))
    return F.when(F.octet_length(t) == F.length(t), t).otherwise(wide)


@dataclass(frozen=True)
class Analyzer:
    """Order matters: stemming comes before lower case unless `lowercase_first`.

    `lexicon` is an optional table (token, root) of dictionary stems; a token it lists
    takes its root in place of the plural rule.
    """

    stem: Callable[[Column], Column] | None = light_stem
    lowercase_first: bool = False
    stop_words: tuple[str, ...] = ()
    english: bool = False
    lexicon: DataFrame | None = None

    def steps(self, root: Column | None = None) -> list[Callable[[Column], Column]]:
        """The chain as single steps, each to be applied to the value of the one before."""
        chain: list[Callable[[Column], Column]] = [F.lower] if self.lowercase_first else []
        if self.stem is not None:
            stem = self.stem
            chain.append(stem if root is None else lambda t: F.coalesce(root, stem(t)))
        chain += [strip_possessive, F.lower, fold_ascii]
        return chain + [porter] if self.english else chain

    def kept(self, found: Column) -> Column:
        """Raw tokens of one text that survive the stop filter, which looks at words as
        written: a stemmed `was` or `this` would no longer be recognised."""
        if not self.stop_words:
            return found
        return F.filter(found, lambda t: ~F.lower(t).isin(list(self.stop_words)))

    def terms_of(self, found: Column) -> Column:
        """The term of each token of an array, without a lexicon; one pass for a step, so that its value is had once."""
        for step in self.steps():
            found = F.transform(found, step)
        return found

    def terms(self, df: DataFrame, token: str = "token") -> DataFrame:
        """Replace the column `token` by its `term`, row by row."""
        out, root = df, None
        if self.lexicon is not None:
            key = F.lower(F.col(token)) if self.lowercase_first else F.col(token)
            # An empty root would be no term.
            roots = self.lexicon.where(F.col("root") != "").groupBy(F.col("token").alias("_key")).agg(F.min("root").alias("_root"))
            out = out.withColumn("_key", key).join(small(roots), "_key", "left").drop("_key")
            root = F.col("_root")
        out = out.withColumnRenamed(token, "term")
        for step in self.steps(root):  # one projection per step keeps each in generated code
            out = out.withColumn("term", step(F.col("term")))
        return out.drop("_root")


LIGHT_ENGLISH = Analyzer()
ANALYZERS = {
    "light_english": LIGHT_ENGLISH,
    "light_english_stopped": Analyzer(stop_words=tuple(ENGLISH_STOP_WORDS)),
    "english": Analyzer(stem=None, stop_words=tuple(ENGLISH_STOP_WORDS), english=True),
}
