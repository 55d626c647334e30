"""Boolean trigram queries: which trigrams a text must hold if a regular expression matches in it."""

from __future__ import annotations

from functools import reduce
from itertools import islice, product
from re import _constants as codes
from re import _parser

# Strings that a part of an expression is spelled out to, at most; a part with more gives a weaker query.
MOST_STRINGS = 24
MOST_REPEATS = 4

# A query is a list of clauses that all hold; a clause is a set of alternatives, one of which holds; an alternative is a
# set of trigrams that all stand in the text, in lower case. An empty query holds for every text.
Clause = frozenset[frozenset[str]]
REPEATS = (codes.MAX_REPEAT, codes.MIN_REPEAT, codes.POSSESSIVE_REPEAT)


def _joined(left: set[str], right: set[str] | None) -> set[str] | None:
    if right is None or len(left) * len(right) > MOST_STRINGS:
        return None
    return {a + b for a, b in product(left, right)}


def _letters(members: list) -> set[str] | None:
    """The characters of a class, in lower case."""
    out: set[str] = set()
    for op, value in members:
        if op is codes.LITERAL:
            out.add(chr(value).lower())
        elif op is codes.RANGE and value[1] - value[0] < 2 * MOST_STRINGS:
            out.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return None
    return out if len(out) <= MOST_STRINGS else None


def _strings(op, value) -> set[str] | None:
    """All strings that a part can stand for, in lower case; None if they are too many or not known."""
    if op is codes.LITERAL:
        return {chr(value).lower()}
    if op is codes.IN:
        return _letters(value)
    if op in (codes.AT, codes.ASSERT, codes.ASSERT_NOT):
        return {""}
    if op is codes.SUBPATTERN or op is codes.ATOMIC_GROUP:
        return _all(value[-1] if op is codes.SUBPATTERN else value)
    if op is codes.BRANCH:
        ways = [_all(way) for way in value[1]]
        out = None if None in ways else set().union(*ways)
        return out if out is not None and len(out) <= MOST_STRINGS else None
    if op in REPEATS and value[1] <= MOST_REPEATS:
        once = _all(value[2])
        counts = [reduce(lambda s, _: None if s is None else _joined(s, once), range(n), {""}) for n in range(value[0], int(value[1]) + 1)]
        out = None if None in counts else set().union(*counts)
        return out if out is not None and len(out) <= MOST_STRINGS else None
    return None


def _all(parts) -> set[str] | None:
    return reduce(lambda s, part: None if s is None else _joined(s, _strings(*part)), parts, {""})


def _clause(strings: set[str]) -> list[Clause]:
    """What a text that holds one of the strings must hold; nothing certain if one has no trigram in ASCII."""
    ways = {frozenset(t for t in (s[i : i + 3] for i in range(len(s) - 2)) if t.isascii()) for s in strings}
    if frozenset() in ways:
        return []
    return [frozenset(w for w in ways if not any(other < w for other in ways))]


def _inside(op, value) -> list[Clause]:
    """Clauses of a part that can't be spelled out."""
    if op is codes.SUBPATTERN or op is codes.ATOMIC_GROUP:
        return _query(value[-1] if op is codes.SUBPATTERN else value)
    if op in REPEATS and value[0] >= 1:
        return _query(value[2])
    if op is codes.BRANCH:
        # Whichever way matches, all its clauses hold: so does any union of one clause of every way.
        return [frozenset().union(*clauses) for clauses in islice(product(*map(_query, value[1])), MOST_STRINGS)]
    return []


def _query(parts) -> list[Clause]:
    clauses, run = [], {""}
    for op, value in parts:
        own = _strings(op, value)
        longer = _joined(run, own)
        if longer is not None:
            run = longer
            continue
        once = _all(value[2]) if op in REPEATS and value[0] >= 1 else None
        if once is not None:
            # However often it repeats, the first time follows what came before, and the last is followed by what comes next.
            clauses += _clause(_joined(run, once) or run)
            run = once
            continue
        clauses += _clause(run)
        if own is None:
            clauses += _inside(op, value)
        run = own or {""}
    return clauses + _clause(run)


def trigram_query(pattern: str) -> list[Clause]:
    """The Boolean query of a regular expression; case is ignored throughout, so that it holds for any text that matches."""
    return list(dict.fromkeys(_query(_parser.parse(pattern))))


def trigrams_of(query: list[Clause]) -> set[str]:
    return set().union(*(way for clause in query for way in clause))
