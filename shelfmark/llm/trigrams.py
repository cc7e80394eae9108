"""Boolean trigram queries that every match of a regular expression satisfies."""

from __future__ import annotations

from itertools import product
from re import _constants as op
from re import _parser

#: Most strings that a part of an expression is spelled out to; trigrams taken of one string.
SPELLED, TAKEN = 64, 3

#: A query is None (no condition) or alternatives, each a set of trigrams that must all occur.
Query = list[frozenset[str]] | None


def query(pattern: str) -> Query:
    """Lower-case trigrams of which one alternative's must all occur in the lower-cased text.

    None if the expression has no mandatory trigram. Only what must be matched counts: optional
    parts, classes and repeats break a run of fixed letters. Matches are found among the texts that
    satisfy the query; texts that do need not match.
    """
    return _sequence(list(_parser.parse(pattern)))


def _sequence(nodes: list) -> Query:
    """Of the runs of spelled-out parts in a sequence, the conditions of all."""
    found: Query = None
    run = [""]
    for node in nodes:
        texts, inner = _node(node)
        if texts is not None and len(run) * len(texts) <= SPELLED:
            run = [a + b for a, b in product(run, texts)]
            continue
        found = _both(_both(found, _of(run)), inner)
        run = texts if texts is not None else [""]
    return _both(found, _of(run))


def _node(node: tuple) -> tuple[list[str] | None, Query]:
    """(all strings that the part may match, or None; else its own condition)."""
    kind, value = node
    if kind is op.LITERAL:
        return [chr(value).lower()], None
    if kind is op.IN and all(k is op.LITERAL and (chr(c).isalnum() or c == ord("_")) for k, c in value):
        return sorted({chr(c).lower() for _, c in value}), None
    if kind is op.SUBPATTERN:
        nodes = list(value[3])
        spelled = [""]
        for x in nodes:
            texts, _ = _node(x)
            if texts is None or len(spelled) * len(texts) > SPELLED:
                return None, _sequence(nodes)
            spelled = [a + b for a, b in product(spelled, texts)]
        return spelled, None
    if kind is op.BRANCH:
        parts = [_node((op.SUBPATTERN, (None, 0, 0, branch))) for branch in value[1]]
        if all(t is not None for t, _ in parts) and sum(len(t) for t, _ in parts) <= SPELLED:
            return sorted({s for t, _ in parts for s in t}), None
        each = [_of(t) if t is not None else q for t, q in parts]
        return None, None if any(q is None for q in each) else [s for q in each for s in q]
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, inner = value
        texts, _ = _node((op.SUBPATTERN, (None, 0, 0, inner)))
        if (least, most) == (0, 1) and texts is not None:
            return sorted({"", *texts}), None
        return None, _sequence(list(inner)) if least else None
    return None, None


def _of(texts: list[str]) -> Query:
    if any(len(t) < 3 for t in texts):
        return None
    every = ([t[i : i + 3] for i in range(len(t) - 2)] for t in texts)
    found = {frozenset(t[:: max(1, -(-len(t) // TAKEN))]) for t in every}
    return sorted((s for s in found if not any(o < s for o in found)), key=sorted)  # others follow


def _both(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return a if b is None else b
    return [x | y for x, y in product(a, b)] if len(a) * len(b) <= SPELLED else min(a, b, key=len)
