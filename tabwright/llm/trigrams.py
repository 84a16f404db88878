"""Boolean trigram queries that every match of a regular expression must satisfy."""

from __future__ import annotations

import itertools
import re._constants as kinds
import re._parser as parser
from dataclasses import dataclass

SET_LIMIT = 32
TRIGRAMS_PER_STRING = 6


@dataclass(frozen=True)
class Query:
    """Alternatives, each a set of trigrams that must all occur. An empty alternative, or none at all, says nothing."""

    alternatives: tuple[frozenset[str], ...] = (frozenset(),)

    @property
    def scans_all(self) -> bool:
        return any(not a for a in self.alternatives)

    def trigrams(self) -> set[str]:
        return set() if self.scans_all else set().union(*self.alternatives)

    def both(self, other: Query) -> Query:
        """Either side's demands together; where that would be too many alternatives, the more telling side alone."""
        if len(self.alternatives) * len(other.alternatives) > SET_LIMIT:
            return other if self.scans_all or len(other.alternatives) < len(self.alternatives) and not other.scans_all else self
        return _absorbed(a | b for a in self.alternatives for b in other.alternatives)

    def either(self, other: Query) -> Query:
        return _absorbed((*self.alternatives, *other.alternatives))


def _absorbed(alternatives) -> Query:
    unique = sorted(set(alternatives), key=lambda a: (len(a), sorted(a)))
    kept: list[frozenset[str]] = []
    for a in unique:
        if not any(k <= a for k in kept):
            kept.append(a)
    return Query(tuple(kept))


def _of_strings(strings: set[str]) -> Query:
    found = []
    for s in strings:
        runs = list(dict.fromkeys(s[i : i + 3] for i in range(len(s) - 2)))
        found.append(frozenset(runs[:TRIGRAMS_PER_STRING]))
    return _absorbed(found)


def _exact(op, value) -> set[str] | None:
    """All strings the node can match, lower-cased, where they are few."""
    if op is kinds.LITERAL:
        return {chr(value).lower()}
    if op is kinds.IN:
        out: set[str] = set()
        for kind, x in value:
            if kind is kinds.LITERAL:
                out.add(chr(x).lower())
            elif kind is kinds.RANGE and x[1] - x[0] < SET_LIMIT // 4:
                out |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return out if len(out) <= SET_LIMIT // 4 else None
    if op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
        low, high, body = value
        one = _exact_run(body)
        if one is None or high is kinds.MAXREPEAT or high > 3 or len(one) ** high > SET_LIMIT:
            return None
        return {"".join(t) for n in range(low, high + 1) for t in itertools.product(one, repeat=n)}
    if op is kinds.SUBPATTERN:
        return _exact_run(value[3])
    if op is kinds.BRANCH:
        parts = [_exact_run(b) for b in value[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op is kinds.AT:
        return {""}
    return None


def _exact_run(nodes) -> set[str] | None:
    found = {""}
    for op, value in nodes:
        one = _exact(op, value)
        if one is None or len(found) * len(one) > SET_LIMIT:
            return None
        found = {a + b for a in found for b in one}
    return found


def _query_run(nodes) -> Query:
    query, strings = Query(), {""}
    for op, value in nodes:
        one = _exact(op, value)
        if one is not None and len(strings) * len(one) <= SET_LIMIT:
            strings = {a + b for a in strings for b in one}
            continue
        query, strings = query.both(_of_strings(strings)), {""} if one is None else one
        if one is None:
            query = query.both(_query(op, value))
    return query.both(_of_strings(strings))


def _query(op, value) -> Query:
    if op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
        return _query_run(value[2]) if value[0] else Query()
    if op is kinds.SUBPATTERN:
        return _query_run(value[3])
    if op is kinds.BRANCH:
        parts = [_query_run(b) for b in value[1]]
        out = parts[0]
        for p in parts[1:]:
            out = out.either(p)
        return out
    return Query()


def query_of(pattern: str) -> Query:
    """The query of a pattern, over lower-cased text: a text that fails it holds no match."""
    return _query_run(parser.parse(pattern))
