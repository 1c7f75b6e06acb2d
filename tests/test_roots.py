import random
import re
from collections import Counter


from ladle.operators.roots import validated_analyzer, validated_roots


def brute(words, least):
    """The rules, read as a person would read them."""
    n = Counter(w for w in words if w is not None)

    def roots(w, endings):
        if len(w) < 4 or not re.fullmatch("[a-z]+", w) or w.endswith(("us", "ss")):
            return []
        made = [w[:-len(e)] + put for e, put in endings if w.endswith(e)]
        for e in ("ed", "ing"):
            if ("ed", "") in endings and re.search(rf"([^aeiouy])\1{e}$", w):
                made.append(w[:-len(e) - 1])
        return [r for r in made if len(r) > 2 and re.search("[aeiouy]", r) and n[r] >= least]

    plural = [("ies", "y"), ("s", ""), ("es", "")]
    tense = [("ied", "y"), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", "")]
    out = {}
    for w in n:
        found = roots(w, plural) or roots(w, tense)
        if found:
            out[w] = max(found, key=lambda r: n[r])
            if w.endswith("s") and (further := roots(out[w], tense)):
                out[w] = max(further, key=lambda r: n[r])
    return out


def lexicon(spark, words, **options):
    return validated_roots(spark.createDataFrame([(w,) for w in words], "token string"), **options)


def test_roots(spark, rows):
    words = ("berry berry berries hope hope hop hoped hopping box box boxes horse horse horses paint paint painting painting "
             "paintings plan plan planned cry cry cried class this bus bus buses spring spr spr Boxes évents king kings king").split()
    got = dict(rows(lexicon(spark, [*words, None, ""])))
    assert got == {"berries": "berry", "hoped": "hope", "boxes": "box", "horses": "horse", "painting": "paint",
                   "paintings": "paint", "planned": "plan", "cried": "cry", "buses": "bus", "kings": "king"}
    # A root of too little support is none; counts of earlier loads add to it.
    assert "hopping" not in got
    known = spark.createDataFrame([("hop", 5)], "token string, n bigint")
    assert dict(rows(lexicon(spark, words, known=known)))["hopping"] == "hop"
    assert rows(lexicon(spark, [])) == []


def test_roots_against_brute_force(spark, rows):
    draw = random.Random(5)
    endings = ["", "s", "es", "ies", "y", "ed", "ied", "e", "ing", "ings", "ss", "us", "ped", "pping", "P"]
    for least in (1, 3):
        words = ["".join(draw.choices("aeprt", k=draw.randint(1, 4))) + draw.choice(endings) for _ in range(3000)]
        assert dict(rows(lexicon(spark, words, least=least))) == brute(words, least)


def test_analyzer_with_validated_roots(spark, rows):
    words = "berry berry berries news new news Berries series".split()
    analyzer = validated_analyzer(lexicon(spark, words))
    out = analyzer.terms(spark.createDataFrame([(w,) for w in ("berries", "news", "Berries", "series")], "token string"))
    # `new` occurs once, `seri` and `sery` never: both words keep their form, as do words with a capital.
    assert rows(out, "term") == [("berries",), ("berry",), ("news",), ("series",)]


def test_no_exchange_of_single_occurrences(spark):
    """Occurrences are counted before the first exchange."""
    plan = lexicon(spark, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.count("CartesianProduct") == 0
