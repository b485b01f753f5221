"""What a regular expression cannot match without: its mandatory literal strings."""

from __future__ import annotations

import re
from itertools import product
from re import _constants as C
from re import _parser

#: Alternatives that are followed one by one before a part counts as "anything".
FOLLOWED = 64
#: Stands in a literal for a place where no letter or digit can be: an anchor or a word boundary.
EDGE = "\0"


def mandatory(pattern: str) -> list[frozenset[str]]:
    """Sets of strings; every match holds a string of each set, in lower case. Empty: nothing is mandatory."""
    required: list[frozenset[str]] = []
    _walk(_parser.parse(pattern), {""}, required, True)
    return [s for s in required if all(x.strip(EDGE) for x in s)]


def _walk(sequence, exact: set[str], required: list, close: bool) -> set[str]:
    """Follow a sequence from the strings that end before it; parts that can't be followed close them."""

    def shut(after: set[str] | None = None) -> set[str]:
        required.append(frozenset(exact))
        return after or {""}

    for op, arg in sequence:
        part = _strings(op, arg)
        if part is not None and len(part) * len(exact) <= FOLLOWED:
            exact = {a + b for a, b in product(exact, part)}
            continue
        exact = shut()
        if part is not None:
            exact = set(part)
        elif op is C.SUBPATTERN:
            exact = _walk(arg[3], {""}, required, True)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] > 0:
            _walk(arg[2], {""}, required, True)
        elif op is C.ATOMIC_GROUP:
            _walk(arg, {""}, required, True)
    return shut() if close else exact


def _strings(op, arg) -> set[str] | None:
    """All strings of one element, in lower case, or None where there are too many to follow."""
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.AT:
        return {EDGE} if arg in (C.AT_BEGINNING, C.AT_BEGINNING_STRING, C.AT_END, C.AT_END_STRING, C.AT_BOUNDARY) else {""}
    if op is C.IN:
        out: set[str] = set()
        for kind, x in arg:
            if kind is C.LITERAL:
                out.add(chr(x).lower())
            elif kind is C.RANGE and x[1] - x[0] < 8:
                out |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is C.SUBPATTERN:
        return _sequence(arg[3])
    if op is C.BRANCH:
        parts = [_sequence(s) for s in arg[1]]
        return set().union(*parts) if all(p is not None for p in parts) else None
    if op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[1] <= 4:
        once = _sequence(arg[2])
        if once is None or (len(once) + 1) ** arg[1] > FOLLOWED:
            return None
        return {"".join(t) for n in range(arg[0], arg[1] + 1) for t in product(once, repeat=n)}
    if op in (C.ASSERT, C.ASSERT_NOT):
        return {""}
    return None


def _sequence(sequence) -> set[str] | None:
    out = {""}
    for op, arg in sequence:
        part = _strings(op, arg)
        if part is None or len(part) * len(out) > FOLLOWED:
            return None
        out = {a + b for a, b in product(out, part)}
    return out


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """A Boolean query as an AND of ORs of ANDs of trigrams; empty: every text is a candidate."""
    out = []
    for strings in mandatory(pattern):
        # an edge takes no place in the text: the literal on either side of it still holds its own trigrams
        sets = [frozenset(p[i : i + 3] for p in s.split(EDGE) for i in range(len(p) - 2)) for s in strings]
        if sets and all(sets):
            least = [a for a in set(sets) if not any(b < a for b in sets)]
            out.append(least)
    return out


_TOKEN = re.compile(r"[0-9a-z]+")


def tokens(text: str) -> set[str]:
    return set(_TOKEN.findall(text.lower()))


def whole_tokens(literal: str) -> set[str]:
    """Runs of letters and digits that have a neighbour in the literal on both sides, so they are whole in any match."""
    return {m.group() for m in _TOKEN.finditer(literal) if m.start() > 0 and m.end() < len(literal)}


def token_choices(pattern: str) -> list[list[set[str]]]:
    """Ways to index a rule: each is one set of whole tokens per alternative, any of which a match must hold."""
    ways = [[whole_tokens(s) for s in strings] for strings in mandatory(pattern)]
    return [w for w in ways if all(w)]
