"""Boolean trigram queries from regular expressions.

A query is in disjunctive form: a list of clauses, each a set of lower-case trigrams. A text can
match the expression only if it holds all trigrams of at least one clause; an empty clause (no
mandatory trigram on some path) means that every text must be scanned.
"""

from __future__ import annotations

from itertools import product
from re import _constants as C
from re import _parser

Clause = frozenset[str]

ALL: list[Clause] = [frozenset()]
# Beyond these the query is relaxed (fewer conditions), never narrowed.
MAX_STRINGS = 64
MAX_CLAUSES = 64


def absorb(clauses: set[Clause]) -> list[Clause]:
    """Clauses without those that another one already implies."""
    return sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


def both(a: list[Clause], b: list[Clause]) -> list[Clause]:
    joined = absorb({x | y for x, y in product(a, b)})
    return joined if len(joined) <= MAX_CLAUSES else min(a, b, key=len)


def either(a: list[Clause], b: list[Clause]) -> list[Clause]:
    joined = absorb({*a, *b})
    return joined if len(joined) <= MAX_CLAUSES else ALL


def of_strings(strings: set[str]) -> list[Clause]:
    """One of these strings occurs."""
    return absorb({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def characters(items: list) -> set[str] | None:
    """The lower-case members of a small character class; None for a large or negated one."""
    found: set[str] = set()
    for kind, value in items:
        if kind is C.LITERAL:
            found.add(chr(value).lower())
        elif kind is C.RANGE and value[1] - value[0] < 8:
            found.update(chr(v).lower() for v in range(value[0], value[1] + 1))
        else:
            return None
    return found if len(found) <= 8 else None


def analyse(nodes) -> tuple[set[str] | None, list[Clause]]:
    """All strings that a sequence can match, if few; and a query that each match fulfils."""
    run, query, exact = {""}, ALL, True

    for kind, value in nodes:
        strings, part = None, ALL
        if kind is C.LITERAL:
            strings = {chr(value).lower()}
        elif kind is C.IN:
            strings = characters(value)
        elif kind is C.AT:
            strings = {""}
        elif kind is C.SUBPATTERN:
            strings, part = analyse(value[-1])
        elif kind is C.BRANCH:
            branches = [analyse(branch) for branch in value[1]]
            if all(s is not None for s, _ in branches):
                strings = set().union(*(s for s, _ in branches))
            part = branches[0][1]
            for _, other in branches[1:]:
                part = either(part, other)
        elif kind in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, inner = value
            inner_strings, inner_query = analyse(inner)
            if (low, high) == (0, 1) and inner_strings is not None:
                strings = inner_strings | {""}
            elif low:
                part = inner_query
                if inner_strings is not None and low == high and len(inner_strings) ** low <= MAX_STRINGS:
                    strings = {"".join(p) for p in product(inner_strings, repeat=low)}
        if strings is not None and len(run) * len(strings) <= MAX_STRINGS:
            run = {a + b for a, b in product(run, strings)}
            continue
        query = both(both(query, of_strings(run)), part if strings is None else of_strings(strings))
        run, exact = {""}, False
    query = both(query, of_strings(run))
    return (run if exact else None), query


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses of a pattern in the syntax that Python's and Java's expressions share."""
    return analyse(_parser.parse(pattern))[1]
