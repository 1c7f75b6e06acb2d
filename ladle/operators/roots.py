"""Stems validated by the corpus: a word loses its ending only if what is left is a word of the corpus itself.

The result is a lexicon `(token, root)` for `Analyzer`, computed over the distinct tokens, so its cost follows the
vocabulary and not the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.functions.analysis import Analyzer

PLURAL, TENSE = 0, 1
#: Ending, what stands in its place, kind. Order decides between roots of equal support.
ENDINGS = (("ies", "y", PLURAL), ("s", "", PLURAL), ("es", "", PLURAL),
           ("ied", "y", TENSE), ("ed", "e", TENSE), ("ed", "", TENSE), ("ing", "e", TENSE), ("ing", "", TENSE))
#: A doubled consonant before these endings may be a single one in the root.
DOUBLING = ("ed", "ing")


def candidates(token: Column) -> Column:
    """Array of `rank, kind, root` for an all-lower-case ASCII token: at least three letters and a vowel are left."""
    found = []

    def add(when: Column, root: Column, kind: int) -> None:
        found.append(F.when(when, F.struct(F.lit(len(found)).alias("rank"), F.lit(kind).alias("kind"), root.alias("root"))))

    bare = lambda cut: F.left(token, F.greatest(F.length(token) - cut, F.lit(0)))
    for ending, put, kind in ENDINGS:
        # As in the plural rule of `light_stem`, `us` and `ss` are no plurals.
        fits = token.endswith(ending) & ~(token.endswith("us") | token.endswith("ss"))
        add(fits, F.concat(bare(len(ending)), F.lit(put)), kind)
    for ending in DOUBLING:
        fits = token.rlike(rf"([b-df-hj-np-tv-xz])\1{ending}$")
        add(fits, bare(len(ending) + 1), TENSE)
    word = lambda c: c["root"].rlike("^[a-z]{3,}$") & c["root"].rlike("[aeiouy]")
    return F.filter(F.array(*found), lambda c: c.isNotNull() & word(c))


def validated_roots(tokens: DataFrame, least: int = 2, known: DataFrame | None = None) -> DataFrame:
    """Lexicon `token, root` of the words in `tokens(token)`, one row per occurrence.

    Of the candidate roots that occur at least `least` times the most frequent one is taken, of equals the one whose
    rule comes first. What a plural leaves may lose a tense ending too (`paintings`, `painting`, `paint`). `known(token, n)` are
    counts of earlier loads, added to these. Null tokens are ignored; a token without a root has no row.

    Two exchanges of the counted vocabulary by the root looked for; a root is asked for by at most the few tokens that
    the endings can make of it, so no key is hot.
    """
    counts = tokens.where(F.col("token").isNotNull()).groupBy("token").agg(F.count("*").alias("n"))
    if known is not None:
        counts = counts.unionByName(known.select("token", "n")).groupBy("token").agg(F.sum("n").alias("n"))
    words = counts.where(F.col("token").rlike("^[a-z]{3,}$"))
    support = words.where(F.col("n") >= least).select(F.col("token").alias("root"), "n")
    asked = words.where(F.length("token") > 3).select("token", F.inline(candidates(F.col("token"))))
    best = (asked.join(support, "root").groupBy("token")
                 .agg(F.max_by(F.struct("root", "kind"), F.struct("n", -F.col("rank"))).alias("best"))
                 .select("token", "best.root", "best.kind"))
    tense = best.where(F.col("kind") == TENSE).select(F.col("token").alias("root"), F.col("root").alias("_further"))
    return (best.join(tense, "root", "left")
                .select("token", F.when(F.col("kind") == PLURAL, F.coalesce("_further", "root"))
                                  .otherwise(F.col("root")).alias("root")))


def _unchanged(token: Column) -> Column:
    return token


def validated_analyzer(lexicon: DataFrame, **options) -> Analyzer:
    """The analysis chain with roots of `lexicon`; a token without a root keeps its form. Give the settled table."""
    return Analyzer(stem=_unchanged, lexicon=lexicon, **options)
