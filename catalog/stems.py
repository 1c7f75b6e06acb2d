"""The Porter stemmer as SQL, for the checks: word by word over the consonant and vowel form."""

from __future__ import annotations

# The suffix tables of the paper's steps 2, 3 and 4.
_STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
_STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def _form(x: str) -> str:
    """1 for a consonant, 0 for a vowel; y is a consonant at the start and after a, e, i, o, u."""
    return (f"regexp_replace(translate(regexp_replace({x}, '(^|[aeiou])y', '\\11', 'g'), 'aeiouy', '000000'), "
            "'[a-z]', '1', 'g')")


def _like(x: str, form: str) -> str:
    return f"regexp_matches({_form(x)}, '{form}')"


def _m(x: str, n: int) -> str:
    """The stem holds more than n groups of vowels and consonants."""
    return _like(x, "^1*" + "0+1+" * (n + 1))


def _cvc(x: str) -> str:
    return f"({_like(x, '101$')} and right({x}, 1) not in ('w', 'x', 'y'))"


def _cut(n: int, x: str = "w") -> str:
    return f"left({x}, length({x}) - {n})"


def _swap(table: dict[str, str], over: int) -> str:
    cases = [f"when w like '%{s}' then case when {_m(_cut(len(s)), over)} then {_cut(len(s))} || '{to}' else w end"
             for s, to in sorted(table.items(), key=lambda x: -len(x[0]))]
    return f"case {' '.join(cases)} else w end"


def _drop() -> str:
    cases = []
    for s in sorted(_STEP4, key=len, reverse=True):
        fits = _m(_cut(len(s)), 1)
        if s == "ion":
            cases += [f"when w like '%sion' or w like '%tion' then case when {fits} then {_cut(3)} else w end"]
        else:
            cases += [f"when w like '%{s}' then case when {fits} then {_cut(len(s))} else w end"]
    return f"case {' '.join(cases)} else w end"


_REPAIR = f"""case when not cut or not {_like('w', '0')} then word
    when regexp_matches(w, '(at|bl|iz)$') then w || 'e'
    when right(w, 1) = left(right(w, 2), 1) and length(w) > 1 and {_like(_cut(1), '1$')} and right(w, 1) not in ('l', 's', 'z')
      then {_cut(1)}
    when {_like('w', '^1*0+1+0*$')} and {_cvc('w')} then w || 'e' else w end"""


def sql_porter(source: str) -> str:
    """CTEs from `source(term)` to `stems(term, stem)`: words of three letters a-z or more are stemmed."""
    return f"""
  p0 as (select distinct term, term as w from {source} where regexp_matches(term, '^[a-z]{{3,}}$')),
  p1 as (select term, case when w like '%sses' or w like '%ies' then {_cut(2)}
      when w like '%ss' or w not like '%s' then w else {_cut(1)} end as w from p0),
  p2 as (select term, w as word, (w like '%ed' or w like '%ing') and w not like '%eed' as cut,
      case when w like '%eed' then case when {_m(_cut(3), 0)} then {_cut(1)} else w end
        when w like '%ed' then {_cut(2)} when w like '%ing' then {_cut(3)} else w end as w from p1),
  p3 as (select term, case when cut then {_REPAIR} else w end as w from p2),
  p4 as (select term, case when w like '%y' and {_like(_cut(1), '0')} then {_cut(1)} || 'i' else w end as w from p3),
  p5 as (select term, {_swap(_STEP2, 0)} as w from p4),
  p6 as (select term, {_swap(_STEP3, 0)} as w from p5),
  p7 as (select term, {_drop()} as w from p6),
  p8 as (select term, case when w like '%e' and ({_m(_cut(1), 1)} or ({_m(_cut(1), 0)} and not {_cvc(_cut(1))}))
      then {_cut(1)} else w end as w from p7),
  stems as (select term, case when w like '%ll' and {_m('w', 1)} then {_cut(1)} else w end as stem from p8)"""
