"""Which trigrams a text must hold for a pattern to match: Boolean queries from regular expressions.

A query is a list of clauses, any of which may hold; a clause is a set of trigrams, all of which must
be in the text. The clause without trigrams always holds: such a pattern has to scan every text.
Trigrams are of the lower-cased text, so that one index serves patterns of either case.
"""

from __future__ import annotations

import re._constants as op
import re._parser as parser
from itertools import product

Query = list[frozenset[str]]

# Sets of exact strings, and of clauses, are followed up to this size, beyond it less exactly.
MOST = 64
ANY: Query = [frozenset()]


def _simple(query: Query) -> Query:
    """Without clauses that another one implies."""
    out: Query = []
    for clause in sorted(set(query), key=len):
        if not any(less <= clause for less in out):
            out.append(clause)
    return out if len(out) <= MOST else ANY


def _both(a: Query, b: Query) -> Query:
    return _simple([x | y for x, y in product(a, b)])


def _of_strings(strings: set[str]) -> Query:
    return _simple([frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings])


def _chars(members: list) -> set[str] | None:
    out: set[str] = set()
    for kind, value in members:
        if kind is op.LITERAL:
            out.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < 8:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _node(kind, value) -> tuple[set[str] | None, Query]:
    """The exact set of strings a part matches if it is small, else a query that it implies."""
    if kind is op.LITERAL:
        return {chr(value).lower()}, ANY
    if kind is op.IN:
        return _chars(value), ANY
    if kind is op.SUBPATTERN:
        return _sequence(value[3])
    if kind is op.BRANCH:
        parts = [_sequence(branch) for branch in value[1]]
        if all(exact is not None for exact, _ in parts):
            exact = set().union(*(exact for exact, _ in parts))
            if len(exact) <= MOST:
                return exact, ANY
        return None, _simple([c for exact, query in parts for c in (query if exact is None else _of_strings(exact))])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, inner = value
        exact, query = _sequence(inner)
        if (least, most) == (0, 1) and exact is not None:
            return exact | {""}, ANY
        return None, (query if exact is None else _of_strings(exact)) if least else ANY
    return ({""}, ANY) if kind is op.AT else (None, ANY)


def _sequence(parts) -> tuple[set[str] | None, Query]:
    exact: set[str] | None = {""}
    run, query = {""}, ANY
    for kind, value in parts:
        strings, implied = _node(kind, value)
        if strings is not None and len(run) * len(strings) <= MOST:
            run = {a + b for a, b in product(run, strings)}
            continue
        # The run of exact strings ends here; what follows is required besides.
        query = _both(_both(query, _of_strings(run)), implied if strings is None else _of_strings(strings))
        run, exact = {""}, None
    return (run, ANY) if exact is not None else (None, _both(query, _of_strings(run)))


def trigram_query(pattern: str) -> Query:
    exact, query = _sequence(parser.parse(pattern))
    return query if exact is None else _of_strings(exact)
