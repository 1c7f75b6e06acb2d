import hashlib
import re

from ladle.llm import pii
from hard_rows import HARD


def brute(text):
    """The base patterns as they are stated."""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        total = sum(int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(digits[::-1]))
        found += [("card", *m.span())] if 16 <= len(digits) <= 19 and total % 10 == 0 else []
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
              if 8 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return found


PLAIN = ["a@b.c, x.y+z@d-e.f.g@h.i 1.2.3.4 1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.255 0256.1.1.1",
         "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 4", "+1 (555) 123-4567. +12 +1 2 3 4 5 6 7 8 9 +",
         "a@b@c.d..e @x.y é@z.z %@-.-", "1.2.3", "9" * 3000 + ".1.1.1", "@" * 500 + "a.b", "+1" * 40]

HIDDEN = {
    "mail john.doe (at) example (dot) com now": ("email", "john.doe (at) example (dot) com"),
    "john dot doe at example dot com": ("email", "john dot doe at example dot com"),
    "write j.d [at] a-b [dot] co [dot] uk!": ("email", "j.d [at] a-b [dot] co [dot] uk"),
    "to jоhn@exаmple.cоm": ("email", "jоhn@exаmple.cоm"),
    "ＪＯＨＮ＠ｅｘａｍｐｌｅ．ｃｏｍ": ("email", "ＪＯＨＮ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    "call plus four nine one seven two three four five six seven": (
        "phone", "plus four nine one seven two three four five six seven"),
    "ip one nine two dot one six eight dot one dot one": ("ip", "one nine two dot one six eight dot one dot one"),
    "at me&#64;home&#46;org": ("email", "me&#64;home&#46;org"),
    "me​@ho​me.org": ("email", "me​@ho​me.org"),
}


def test_base_spans_against_the_stated_patterns():
    for text in PLAIN:
        assert pii.base_spans(text) == brute(text)


def test_disguises_map_back_to_the_source():
    for text, (kind, said) in HIDDEN.items():
        assert [(k, text[a:b]) for k, a, b in pii.find(text)[1]] == [(kind, said)], text
        assert pii.find(text)[0] == []


def test_ordinary_texts_stay_clean():
    for text in ("look at this dot on the page", "one two three go", "we met at noon. It was fine.", "Ночь и день",
                 "at example dot", "einem neun und acht"):
        assert pii.find(text)[1] == []


def test_query_columns(table, rows_of):
    rows = HARD + list(enumerate(PLAIN + list(HIDDEN), 100))
    got = rows_of(pii.pii_spans(table(rows, extra=True)))
    want = []
    for i, t in rows:
        base, every = brute(t or ""), pii.find(t or "")[1]
        say = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        want.append((i, *(sum(s[0] == k for s in base) for k in pii.KINDS), hashlib.sha256(say.encode()).hexdigest(),
                     ",".join(f"{k}:{a}:{b}" for k, a, b in every)))
    assert got == sorted(want, key=repr)
    assert pii.pii_spans(table([])).collect() == []


def test_redaction_keeps_columns(table):
    docs = table([(1, "a@b.cc or 1.2.3.4"), (2, None), (3, "nothing")])
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["lang"]) for r in pii.redacted(docs).collect()}
    assert got == {1: ("<EMAIL> or <IP>", 15, "en"), 2: (None, None, "en"), 3: ("nothing", 7, None)}
