"""Boolean trigram queries that every match of a regular expression satisfies."""

from __future__ import annotations

import re
from re import _constants as kinds
from re import _parser as parser

#: Classes up to this size are spelled out; more spelled strings than this are cut.
MAX_CLASS = 8
MAX_STRINGS = 64

#: A query is None (anything may match), a trigram, or ("and" | "or", parts).
Query = None | str | tuple


def join(kind: str, parts: list[Query]) -> Query:
    """Conjunctions drop open parts; a disjunction with one is open itself."""
    if kind == "or" and (not parts or None in parts):
        return None
    distinct = list(dict.fromkeys(p for p in parts if p is not None))
    if len(distinct) < 2:
        return distinct[0] if distinct else None
    return (kind, tuple(distinct))


def trigram_query(pattern: str) -> Query:
    """The query over lower-case text for ``pattern``; None if it has no mandatory trigram."""
    return _sequence(parser.parse(pattern))


def trigrams_of(query: Query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


def _of_strings(strings: set[str]) -> Query:
    """One of the strings occurs, with all its trigrams."""
    return join("or", [join("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _sequence(items) -> Query:
    """Spelled-out strings grow along the sequence; what cannot be spelled closes them."""
    parts: list[Query] = []
    strings = {""}
    for item in items:
        spelled, inner, closed = _item(*item)
        if spelled is None or len(spelled) * len(strings) > MAX_STRINGS:
            parts += [_of_strings(strings), inner]
            strings = {""} if spelled is None or len(spelled) > MAX_STRINGS else spelled
        else:
            strings = {a + b for a in strings for b in spelled}
        if closed:
            parts.append(_of_strings(strings))
            strings = {""}
    return join("and", [*parts, _of_strings(strings)])


def _item(op, value) -> tuple[set[str] | None, Query, bool]:
    """All strings an item can match (or None), a query it implies, and whether more may follow inside it."""
    if op is kinds.LITERAL:
        return {chr(value).lower()}, None, False
    if op is kinds.IN:
        members = _members(value)
        return members, None, False
    if op is kinds.AT:
        return {""}, None, False
    if op is kinds.SUBPATTERN:
        return _group(value[3])
    if op is kinds.BRANCH:
        groups = [_group(branch) for branch in value[1]]
        if all(g[0] is not None and not g[2] for g in groups):
            return set().union(*(g[0] for g in groups)), None, False
        return None, join("or", [_sequence(branch) for branch in value[1]]), True
    if op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
        least, most, body = value
        spelled, inner, closed = _group(body)
        if spelled is None or closed or len(spelled) ** max(1, least) > MAX_STRINGS:
            return None, inner if least else None, True
        times = {""}
        for _ in range(min(least, 8)):
            times = {a + b for a in times for b in spelled}
        if least == 0 and most == 1:
            return times | spelled, None, False
        return times, None, most != least or least > 8
    return None, None, True


def _group(items) -> tuple[set[str] | None, Query, bool]:
    strings = {""}
    for item in items:
        spelled, _, closed = _item(*item)
        if spelled is None or closed or len(spelled) * len(strings) > MAX_STRINGS:
            return None, _sequence(items), True
        strings = {a + b for a in strings for b in spelled}
    return strings, None, False


def _members(members) -> set[str] | None:
    found: set[str] = set()
    for op, value in members:
        if op is kinds.LITERAL:
            found.add(chr(value).lower())
        elif op is kinds.RANGE and value[1] - value[0] < 128:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= MAX_CLASS else None


def checked(pattern: str) -> str:
    """The pattern, if Python reads it too (the queries are derived from that reading)."""
    re.compile(pattern)
    return pattern
