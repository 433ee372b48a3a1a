"""Boolean trigram queries of regular expressions: what the lower-cased text of every match must hold.

A query is None (anything), a trigram, or ("and" | "or", queries).  An expression's parts are known by
the set of strings that they match (``exact``), or else by sets of what matches begin and end with;
where such a set grows past LIMIT, its trigrams go into the query and the set is cut to less.
A cut loses detail, never a match.  Characters beyond ASCII and classes of more than CLASS characters are unknown.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _parser

LIMIT, CLASS = 24, 16
Query = None | str | tuple


def both(*queries: Query) -> Query:
    return _join("and", [q for q in queries if q is not None])


def either(*queries: Query) -> Query:
    return None if any(q is None for q in queries) else _join("or", queries)


def _join(how: str, queries) -> Query:
    flat = {x for q in queries for x in (q[1] if isinstance(q, tuple) and q[0] == how else (q,))}
    if how == "or":  # an alternative that asks for another one and more adds nothing
        flat = {q for q in flat if not any(p != q and _asks(q, p) for p in flat)}
    return None if not flat else flat.pop() if len(flat) == 1 else (how, tuple(sorted(flat, key=repr)))


def _asks(q: Query, p: Query) -> bool:
    parts = lambda x: set(x[1]) if isinstance(x, tuple) and x[0] == "and" else {x}
    return parts(p) <= parts(q)


def of_strings(strings: set[str]) -> Query:
    """One of ``strings`` is held."""
    return either(*[both(*[s[i : i + 3] for i in range(len(s) - 2)]) for s in strings]) if strings else None


def holds(query: Query, text: str) -> bool:
    """Whether a lower-cased text fulfils the query."""
    if query is None or isinstance(query, str):
        return query is None or query in text
    return (all if query[0] == "and" else any)(holds(q, text) for q in query[1])


def trigrams(query: Query) -> set[str]:
    return set() if query is None else {query} if isinstance(query, str) else {t for q in query[1] for t in trigrams(q)}


@dataclass(frozen=True)
class _Part:
    """``exact``: all that it matches, if known; else what matches begin and end with, and a query."""

    exact: frozenset | None = None
    first: frozenset = frozenset({""})
    last: frozenset = frozenset({""})
    query: Query = None

    def heads(self) -> frozenset:
        return self.first if self.exact is None else self.exact

    def tails(self) -> frozenset:
        return self.last if self.exact is None else self.exact

    def whole(self) -> Query:
        return both(self.query, of_strings(self.heads()), of_strings(self.tails()))


_EMPTY, _ANY = _Part(frozenset({""})), _Part()


def _cut(strings: frozenset, end: bool) -> tuple[frozenset, Query]:
    """Few enough strings, each a head (or the end) of one of ``strings``, and what the cut loses of the query."""
    query, n = of_strings(strings), 2
    out = strings
    while len(out) > LIMIT or max(map(len, out)) > 2:
        out = frozenset((s[len(s) - n :] if len(s) > n else s) if end else s[:n] for s in strings)
        if n == 0:
            break
        n -= 1
    return out, query


def _bounded(p: _Part) -> _Part:
    if p.exact is not None and len(p.exact) <= LIMIT:
        return p
    first, a = _cut(p.heads(), False)
    last, b = _cut(p.tails(), True)
    return _Part(None, first, last, both(p.query, a, b))


def _then(x: _Part, y: _Part) -> _Part:
    join = lambda a, b: frozenset(s + t for s, t in product(a, b))
    if x.exact is not None and y.exact is not None:
        return _bounded(_Part(join(x.exact, y.exact), query=both(x.query, y.query)))
    border = [join(x.tails(), y.heads())] if len(x.tails()) * len(y.heads()) <= 2 * LIMIT else [x.tails(), y.heads()]
    first = x.first if x.exact is None else join(x.exact, y.first)
    last = y.last if y.exact is None else join(x.last, y.exact)
    return _bounded(_Part(None, first, last, both(x.query, y.query, *map(of_strings, border))))


def _or(x: _Part, y: _Part) -> _Part:
    if x.exact is not None and y.exact is not None:
        return _bounded(_Part(x.exact | y.exact, query=either(x.query, y.query)))
    return _bounded(_Part(None, x.heads() | y.heads(), x.tails() | y.tails(), either(x.whole(), y.whole())))


def _one(items) -> _Part:
    """One character of a class."""
    found: set[str] = set()
    for op, arg in items:
        name = str(op)
        if name == "LITERAL" and arg < 128:
            found.add(chr(arg).lower())
        elif name == "RANGE" and arg[1] < 128:
            found |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return _ANY
    return _Part(frozenset(found)) if 0 < len(found) <= CLASS else _ANY


def _parts(items) -> _Part:
    out = _EMPTY
    for op, arg in items:
        name, part = str(op), _ANY
        if name == "LITERAL":
            part = _one([(op, arg)])
        elif name == "IN":
            part = _one(arg)
        elif name == "SUBPATTERN":
            part = _parts(arg[-1])
        elif name == "ATOMIC_GROUP":
            part = _parts(arg)
        elif name == "BRANCH":
            ways = [_parts(x) for x in arg[1]]
            part = ways[0]
            for way in ways[1:]:
                part = _or(part, way)
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            part = _EMPTY
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, inner = arg
            once = _parts(inner)
            if least == 0:
                part = _or(once, _EMPTY) if most == 1 else _ANY
            else:
                part = once
                for _ in range(min(least, 4) - 1):
                    part = _then(part, once)
                if least > 4 or most != least:
                    part = _then(_then(part, _ANY), _Part(None, frozenset({""}), once.tails()))
        out = _then(out, part)
    return out


def query_of(pattern: str) -> Query:
    """The trigram query of a regular expression; None if no trigram is mandatory."""
    return _parts(_parser.parse(pattern)).whole()
