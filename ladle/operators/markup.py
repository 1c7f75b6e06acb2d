"""Markup of one page -> flat element columns. The only Python that sees page text.

A linear scan: each character is looked at a bounded number of times, whatever the nesting.
Covers void elements, implied end tags, raw text, comments and entities; it does not
rebuild misnested formatting elements or synthesize missing html/head/body.
"""

from __future__ import annotations

import re
from html import unescape
from html.entities import html5

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*|(?=>)))?""")
_TAG_END = re.compile(r"[\s/]*>")
_REFERENCE = re.compile(r"&(?:#\d+;?|#[xX][0-9a-fA-F]+;?|([a-zA-Z][a-zA-Z0-9]*)(;?))")


def _words(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Element categories of the HTML standard.
VOID = _words("area base br col embed hr img input link meta param source track wbr")
RAW = _words("script style xmp iframe noembed noframes")
RAW_DECODED = _words("title textarea")
CLOSES_P = _words(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section "
    "summary table ul")
SCOPE = _words("applet button caption html marquee object table td template th")
SPECIAL = CLOSES_P | SCOPE | _words("body head tbody tfoot thead tr select textarea title noscript")
HEADINGS = _words("h1 h2 h3 h4 h5 h6")

# What an opening tag ends, and the elements that shield it from doing so.
IMPLIED = {
    "li": (_words("li"), SPECIAL - _words("address div p")),
    "dd": (_words("dd dt"), SPECIAL - _words("address div p")),
    "dt": (_words("dd dt"), SPECIAL - _words("address div p")),
    "a": (_words("a"), SCOPE),
    "option": (_words("option"), SPECIAL),
    "optgroup": (_words("option optgroup"), _words("select") | SCOPE),
    "td": (_words("td th"), _words("tr table template html")),
    "th": (_words("td th"), _words("tr table template html")),
    "tr": (_words("tr"), _words("tbody thead tfoot table template html")),
    "tbody": (_words("tbody thead tfoot"), _words("table template html")),
    "thead": (_words("tbody thead tfoot"), _words("table template html")),
    "tfoot": (_words("tbody thead tfoot"), _words("table template html")),
}

_TABLE_PARTS = _words("table tr tbody thead tfoot td th")
_TABLE_SCOPE = _words("table template html")

_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW | RAW_DECODED}


def attribute_text(value: str) -> str:
    """Decode references, but leave `&copy=1` style query strings alone."""
    if "&" not in value:
        return value

    def decode(m: re.Match) -> str:
        name, semicolon = m.group(1), m.group(2)
        if name and not semicolon:
            following = value[m.end():m.end() + 1]
            if name not in html5 or following == "=":
                return m.group(0)
        return unescape(m.group(0))

    return _REFERENCE.sub(decode, value)


class Page:
    """Elements in document order as parallel lists, and the page's whole text."""

    def __init__(self, markup: str):
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.post: list[int] = []
        self.attrs: list[dict[str, str]] = []
        self.text_from: list[int] = []
        self.text_to: list[int] = []
        self.inner_from: list[int] = []
        self.inner_to: list[int] = []
        self._runs: list[str] = []
        self._chars = 0
        self._open: list[int] = []
        self._depths: dict[str, list[int]] = {}  # open elements per tag, by their depth
        self._foreign = 0
        self._scan(markup)
        self.text = "".join(self._runs)

    # -- tree ------------------------------------------------------------------------

    def _add_text(self, run: str, decode: bool = True) -> None:
        if run:
            if decode and "&" in run:
                run = unescape(run)
            if "\r" in run:
                run = run.replace("\r\n", "\n").replace("\r", "\n")
            self._runs.append(run)
            self._chars += len(run)

    def _push(self, tag: str, attrs: dict[str, str], inner: int, leaf: bool) -> None:
        node = len(self.tag)
        self.tag.append(tag)
        self.parent.append(self._open[-1] if self._open else -1)
        self.post.append(node)
        self.attrs.append(attrs)
        self.text_from.append(self._chars)
        self.text_to.append(self._chars)
        self.inner_from.append(inner)
        self.inner_to.append(inner)
        if not leaf:
            self._depths.setdefault(tag, []).append(len(self._open))
            self._open.append(node)
            self._foreign += tag in ("svg", "math")

    def _pop_through(self, depth: int, at: int) -> None:
        while len(self._open) > depth:
            node = self._open.pop()
            self._depths[self.tag[node]].pop()
            self.post[node] = len(self.tag) - 1
            self.text_to[node] = self._chars
            self.inner_to[node] = at
            self._foreign -= self.tag[node] in ("svg", "math")

    def _innermost(self, tags) -> int:
        return max((at[-1] for t in tags if (at := self._depths.get(t))), default=-1)

    def _find_open(self, wanted, barrier) -> int:
        """Depth of the innermost open element in `wanted`, -1 if a barrier lies above it.

        Looks at a fixed number of tags, never along the open elements.
        """
        found = self._innermost(wanted)
        return found if found >= 0 and found >= self._innermost(barrier) else -1

    def _close_open(self, wanted, barrier, at: int) -> bool:
        depth = self._find_open(wanted, barrier)
        if depth >= 0:
            self._pop_through(depth, at)
        return depth >= 0

    def _start(self, tag: str, attrs: dict[str, str], at: int, inner: int, closed: bool) -> None:
        if self._foreign:
            self._push(tag, attrs, inner, leaf=closed or tag in VOID)
            return
        if tag in CLOSES_P:
            self._close_open(("p",), SCOPE, at)
        if tag in IMPLIED:
            self._close_open(*IMPLIED[tag], at)
        if tag in HEADINGS and self._open and self.tag[self._open[-1]] in HEADINGS:
            self._pop_through(len(self._open) - 1, at)
        self._push(tag, attrs, inner, leaf=tag in VOID)

    def _end(self, tag: str, at: int, after: int) -> None:
        if tag in VOID and not self._foreign:
            return
        # A block's end tag closes what is open inside it; an inline one stops at blocks.
        barrier = _TABLE_SCOPE if tag in _TABLE_PARTS else SCOPE if tag in SPECIAL else SPECIAL
        if not self._close_open((tag,), barrier, at) and tag == "p" and not self._foreign:
            self._push("p", {}, after, leaf=True)

    # -- scan ------------------------------------------------------------------------

    def _scan(self, s: str) -> None:
        pos, size = 0, len(s)
        while pos < size:
            lt = s.find("<", pos)
            if lt < 0:
                self._add_text(s[pos:])
                break
            following = s[lt + 1:lt + 2]
            if following.isascii() and following.isalpha():
                self._add_text(s[pos:lt])
                pos = self._start_tag(s, lt)
            elif following == "/" and s[lt + 2:lt + 3].isascii() and s[lt + 2:lt + 3].isalpha():
                self._add_text(s[pos:lt])
                name = _NAME.match(s, lt + 2)
                end = s.find(">", name.end())
                end = size if end < 0 else end + 1
                self._end(name.group().lower(), lt, end)
                pos = end
            elif following and following in "!?/":
                self._add_text(s[pos:lt])
                if s.startswith("<!--", lt) and not s.startswith(("<!-->", "<!--->"), lt):
                    end = s.find("-->", lt + 4)
                    pos = size if end < 0 else end + 3
                else:
                    end = s.find(">", lt + 1)
                    pos = size if end < 0 else end + 1
            else:
                self._add_text(s[pos:lt + 1])
                pos = lt + 1
        self._pop_through(0, size)

    def _start_tag(self, s: str, lt: int) -> int:
        name = _NAME.match(s, lt + 1)
        tag = name.group().lower()
        pos, attrs = name.end(), {}
        while not (end := _TAG_END.match(s, pos)):
            attr = _ATTR.match(s, pos)
            if attr is None or s[attr.end():attr.end() + 1] == "":
                return len(s)  # end of input inside a tag: the tag is dropped
            value = attr.group(2) or ""
            if value[:1] in "\"'" and value:
                value = value[1:-1]
            elif attr.group(2) is None and re.match(r"\s*=\s*[\"']", s[attr.end():attr.end() + 64]):
                return len(s)  # a quote that never closes
            attrs.setdefault(attr.group(1).lower(), attribute_text(value))
            pos = attr.end()
        inner = end.end()
        closed = end.group().rstrip(">").endswith("/")
        self._start(tag, attrs, lt, inner, closed)
        if tag in _RAW_END and not self._foreign:
            stop = _RAW_END[tag].search(s, inner)
            at = stop.start() if stop else len(s)
            self._add_text(s[inner:at], decode=tag in RAW_DECODED)
            return at
        return inner
