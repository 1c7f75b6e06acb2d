"""Secrets in texts by many rules, through a trigram index.

Each rule's regular expression gives a Boolean query over trigrams that every match must contain
(an AND of ORs of ANDs). A task indexes each of its blocks of documents: trigram -> postings, for the trigrams
that some query asks for. Postings are intersected per rule and only the candidates are verified with
the expression. A rule without mandatory trigrams scans every document. Blocks are the segments of an
index split by document, so nothing is shuffled and no posting outgrows a block.

Defined results: a null text is an empty one and has no spans; repeated rows are answered one by one;
other columns of the input are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ladle.llm.mapping import map_texts

try:
    from re import _constants as _c, _parser
except ImportError:  # Python 3.10
    import sre_constants as _c
    import sre_parse as _parser


class Rule(NamedTuple):
    """`accept` looks at a leftmost, non-overlapping match; a match that fails is dropped."""

    kind: str
    pattern: str
    accept: Callable[[re.Match], bool] = bool
    base: bool = False


BASE = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         lambda m: len(m[2]) >= 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 16, True),
    # A run shorter than 32 would be dropped, so only longer ones are looked for.
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", base=True),
)
# Published shapes of further credentials.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("bearer", r"(?i:bearer) [A-Za-z0-9+/_.=-]{20,}"),
)
RULES = BASE + MORE

# -- Boolean trigram queries ----------------------------------------------------------

#: A query is an AND of clauses, a clause an OR of alternatives, an alternative an AND of trigrams.
Query = frozenset[frozenset[frozenset[bytes]]]
_SPREAD = 16  # a set of strings wider than this is no longer multiplied out


class _Info(NamedTuple):
    """`exact`: all strings the part can match (None if too many); `need`: clauses of every match."""

    exact: frozenset[str] | None
    need: Query


def _grams(s: str) -> frozenset[bytes]:
    raw = s.encode()
    return frozenset(raw[i:i + 3] for i in range(len(raw) - 2))


def _clause(exact: frozenset[str] | None) -> Query:
    """"One of these strings occurs", if each of them holds a trigram."""
    alternatives = frozenset(map(_grams, exact or ()))
    return frozenset([alternatives]) if alternatives and all(alternatives) else frozenset()


def _analyse(parts) -> tuple[Query, _Info]:
    """Clauses of a sequence: neighbours that can be enumerated are joined to longer strings."""
    need: Query = frozenset()
    run, whole = frozenset([""]), True
    for op, arg in parts:
        info = _part(op, arg)
        need |= info.need
        if info.exact is not None and len(run) * len(info.exact) <= _SPREAD:
            run = frozenset(x + y for x in run for y in info.exact)
            continue
        need |= _clause(run)
        run, whole = (frozenset([""]) if info.exact is None else info.exact), False
    return need | _clause(run), _Info(run if whole else None, need | (frozenset() if whole else _clause(run)))


def _part(op, arg) -> _Info:
    free = _Info(None, frozenset())
    if op is _c.LITERAL:
        return _Info(frozenset([chr(arg)]), frozenset())
    if op is _c.SUBPATTERN:
        return _analyse(arg[-1])[1]
    if op is _c.BRANCH:
        branches = [_analyse(b) for b in arg[1]]
        if all(i.exact is not None for _, i in branches):
            return _Info(frozenset().union(*(i.exact for _, i in branches)), frozenset())
        if all(q for q, _ in branches):  # one clause of each branch, together
            return _Info(None, frozenset([frozenset().union(*(min(q, key=len) for q, _ in branches))]))
        return free
    if op in (_c.MAX_REPEAT, _c.MIN_REPEAT, getattr(_c, "POSSESSIVE_REPEAT", None)):
        low, high, inner = arg
        query, info = _analyse(inner)
        if (low, high) == (0, 1) and info.exact is not None:
            return _Info(info.exact | {""}, frozenset())
        return _Info(None, query) if low else free
    if op is _c.IN and len(arg) <= 8 and all(o is _c.LITERAL for o, _ in arg):
        return _Info(frozenset(chr(v) for _, v in arg), frozenset())
    if op in (_c.AT, _c.ASSERT, _c.ASSERT_NOT):
        return _Info(frozenset([""]), frozenset())
    return free


def trigram_query(pattern: str) -> Query | None:
    """Trigrams that every match holds, in lower case; None if none is mandatory.

    ASCII lower case on both sides only widens a query, so it serves rules with and without case.
    """
    need = _analyse(_parser.parse(pattern))[0]
    return frozenset(frozenset(frozenset(g.lower() for g in a) for a in c) for c in need) or None


class Index:
    """Postings of one block of documents for the trigrams some rule asks for."""

    def __init__(self, texts: list[bytes], asked: list[bytes]):
        table = _slots(tuple(asked))
        buffer = np.frombuffer(b"\0\0\0".join(texts).lower() + b"\0\0\0", np.uint8)
        ends = np.cumsum([len(t) + 3 for t in texts])
        code = buffer[:-2].astype(np.int32) << 16
        code |= buffer[1:-1].astype(np.int32) << 8
        code |= buffer[2:]
        slot = table[code]
        at = np.flatnonzero(slot)
        pairs = np.unique(slot[at].astype(np.int64) * len(texts) + np.searchsorted(ends, at, "right"))
        cut = np.searchsorted(pairs, np.arange(1, len(asked) + 2) * len(texts))
        rows = pairs % len(texts)
        self.postings = {g: rows[cut[i]:cut[i + 1]] for i, g in enumerate(asked)}

    def candidates(self, query: Query) -> np.ndarray:
        """Rows that meet every clause."""
        def every(sets: list[np.ndarray]) -> np.ndarray:
            return reduce(np.intersect1d, sorted(sets, key=len))
        return every([reduce(np.union1d, [every([self.postings[g] for g in a]) for a in clause])
                      for clause in query])


_SLOTS: dict[tuple[bytes, ...], np.ndarray] = {}


def _slots(asked: tuple[bytes, ...]) -> np.ndarray:
    """Trigram code -> 1 + its place in `asked`, 0 for all others; made once per worker."""
    if asked not in _SLOTS:
        table = np.zeros(1 << 24, np.int16)
        for i, g in enumerate(asked):
            table[g[0] << 16 | g[1] << 8 | g[2]] = i + 1
        _SLOTS.clear()
        _SLOTS[asked] = table
    return _SLOTS[asked]


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = [(r, re.compile(r.pattern, re.A), trigram_query(r.pattern)) for r in rules]
        self.asked = sorted({g for *_, q in self.rules if q for clause in q for a in clause for g in a})

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text: (start, end, rule), by start and then by rule as listed."""
        index = Index([t.encode() for t in texts], self.asked)
        found: list[list] = [[] for _ in texts]
        for n, (rule, pattern, query) in enumerate(self.rules):
            rows = range(len(texts)) if query is None else index.candidates(query).tolist()
            for row in rows:
                found[row] += [(m.start(), m.end(), n) for m in pattern.finditer(texts[row]) if rule.accept(m)]
        for spans in found:
            spans.sort(key=lambda s: (s[0], s[2]))
        return found


BASE_KINDS = tuple(r.kind for r in BASE)
SPANS = StructType(
    [StructField("doc_id", LongType()), *(StructField(f"n_{k}", LongType()) for k in BASE_KINDS),
     StructField("base_sha256", StringType()), StructField("spans", StringType())])


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = MORE, text: str = "text") -> DataFrame:
    """Per document: base spans counted by kind and digested, and all spans (`kind:start:end`).

    `rules` are looked for besides the base rules.
    """
    extra = tuple(r[:2] for r in rules)  # functions of a rule stay here: patterns alone are sent
    accepts = tuple(r.accept for r in rules)
    state: dict[str, Scanner] = {}

    def kernel(ids: list, texts: list) -> list:
        if "scanner" not in state:
            state["scanner"] = Scanner(BASE + tuple(Rule(*e, a) for e, a in zip(extra, accepts)))
        scanner = state["scanner"]
        kinds = [r.kind for r, *_ in scanner.rules]
        every = scanner.scan([t or "" for t in texts])
        base = [[s for s in spans if s[2] < len(BASE)] for spans in every]
        say = lambda spans: ",".join(f"{kinds[n]}:{a}:{b}" for a, b, n in spans)
        return [ids, *([sum(s[2] == n for s in spans) for spans in base] for n in range(len(BASE))),
                [hashlib.sha256(say(spans).encode()).hexdigest() for spans in base], [say(s) for s in every]]

    return map_texts(docs, kernel, SPANS, text)
