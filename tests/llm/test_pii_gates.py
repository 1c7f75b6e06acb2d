"""What decides whether a text is rewritten at all must not be narrower than the rules themselves."""

import pytest

from ladle.llm import pii


@pytest.mark.parametrize("text", [
    "jane.doe (at) example.com", "jane.doe [at] example.org", "jane.doe {at} example.com", "jane.doe <at> example.com",
    "jane.doe (arroba) example.com", "jane.doe ( ät ) example.com", "jane.doe@example&#46;com", "jane&period;doe@example.com",
    "jane.doe@example{.}com", "jane.doe@example < . > com", "jane.doe\n@\nexample.com", "jane.doe@example . com"])
def test_every_sign_opens_the_gate(text):
    assert pii._SIGN_HINT.search(text)
    assert any(form[-1].text == "jane.doe@example." + text[-3:] for form in pii.plain_forms(text)), text


@pytest.mark.parametrize("text", ["jane.doe (at) example.com", "jane.doe [at] example.org", "jane.doe <AT> example.com"])
def test_bracketed_at_with_an_ordinary_dot(text):
    assert pii.find(f"to {text}, now") == ([], [("email", 3, 3 + len(text))])
    assert pii.redact(f"to {text}, now") == "to <EMAIL>, now"


@pytest.mark.parametrize("text, kind", [
    ("+49 30 123 four five", "phone"), ("192.168.one.one", "ip"), ("4111 1111 1111 11 one one", "card")])
def test_digit_words_may_stand_last(text, kind):
    assert (kind, 3, 3 + len(text)) in pii.find(f"at {text} or so")[1]
    assert pii.redact(f"at {text} or so") == f"at <{kind.upper()}> or so"


@pytest.mark.parametrize("text, kind, part", [
    ("jane (dot) doe@example.com", "email", "doe@example.com"),
    ("jane@mail.example (dot) com", "email", "jane@mail.example"),
    ("jоhn@example.com", "email", "hn@example.com"),
    ("+1 555 12 34 five six seven", "phone", "+1 555 12 34")])
def test_partly_disguised_identifiers_are_found_whole(text, kind, part):
    at = text.index(part)
    base, every = pii.find(text + ", so")
    assert base == [(kind, at, at + len(part))]
    assert every == sorted({*base, (kind, 0, len(text))}, key=lambda s: s[1:])
    assert pii.redact(text + ", so") == f"<{kind.upper()}>, so"


def test_a_span_inside_another_adds_nothing():
    assert pii.find("a@b.cc and x (at) d.ee")[1] == [("email", 0, 6), ("email", 11, 22)]
    assert pii._held([(0, 6), (8, 12)], 9, 12) and not pii._held([(0, 6), (8, 12)], 5, 9)


@pytest.mark.parametrize("text, redacted", [
    ("mail jane@example.com . Thanks for all", "mail <EMAIL> . Thanks for all"),
    ("see jane@example.com dot Next we go", "see <EMAIL> dot Next we go"),
    ("to jane@example.com . It was late", "to <EMAIL> . It was late"),
    ("at 10.0.0.1 . Then more", "at <IP> . Then more"),
    ("write jane@mail . example . com today", "write <EMAIL> today"),
    ("write jane dot doe at mail dot example dot com today", "write <EMAIL> today"),
    ("write JANE AT EXAMPLE DOT COM today", "write <EMAIL> today"),
    ("write jane at example dot social today", "write <EMAIL> today"),
    ("host 192 dot 168 dot 1 dot 1 is up", "host <IP> is up")])
def test_words_after_an_address_stay(text, redacted):
    assert pii.redact(text) == redacted


@pytest.mark.parametrize("text, kind", [
    ("192 [dot] 168 [dot] one [dot] one", "ip"), ("jιm@example.com", "email"), ("+①② ③④⑤ ⑥⑦⑧ ⑨⓪", "phone"),
    ("".join(chr(0x1D41A + ord(c) - 97) for c in "jane") + "@example.com", "email")])
def test_signs_before_numerals_and_folded_letters(text, kind):
    assert (kind, 3, 3 + len(text)) in pii.find(f"at {text}, so")[1]
    assert pii.redact(f"at {text}, so") == f"at <{kind.upper()}>, so"
