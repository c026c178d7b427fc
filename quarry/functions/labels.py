"""The label patterns of the layout rules as one dictionary of spellings.

Every label pattern is a finite language of short phrases: words, alternatives,
optional letters, and optional blanks between words. ``spellings`` lists it;
``LABELS`` merges all patterns of all label sets into one dictionary from
phrase to the numbers of the patterns that match it in full. A page is then
matched against all patterns at once: by first word, then by whole phrase.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable
from typing import NamedTuple

from . import fixed

parser = re._parser                # the standard library's own pattern parser

LABEL_SETS = {
    "number": fixed.NUMBER_LABELS, "issue": fixed.INVOICE_DATE_LABELS, "due": fixed.DUE_DATE_LABELS,
    "issuer": fixed.ISSUER_LABELS, "recipient": fixed.RECIPIENT_LABELS, "total": fixed.TOTAL_LABELS,
}


def spellings(pattern: str) -> set[str]:
    """All strings that ``pattern`` matches in full, a run of blanks written as
    one. Raises for a pattern that is not finite up to that."""
    def of(nodes: Iterable) -> set[str]:
        return {"".join(p) for p in itertools.product(*(one(op, arg) for op, arg in nodes))}

    def one(op, arg) -> set[str]:
        match str(op):
            case "LITERAL":
                return {chr(arg)}
            case "AT":
                return {""}
            case "SUBPATTERN":
                return of(arg[3])
            case "BRANCH":
                return set().union(*(of(b) for b in arg[1]))
            case "IN" if all(str(o) == "LITERAL" for o, _ in arg):
                return {chr(a) for _, a in arg}
            case "MAX_REPEAT":
                low, high, body = arg
                if [(str(o), str(a[0][1]) if str(o) == "IN" else "") for o, a in body] == [("IN", "CATEGORY_SPACE")] and low == 0:
                    return {"", " "}
                if (low, high) == (0, 1):
                    return {""} | of(body)
        raise ValueError(f"not a finite label pattern: {pattern}")

    return of(parser.parse(pattern))


class Pattern(NamedTuple):
    label_set: str
    rank: int                      # place in its set
    pattern: str


PATTERNS = [Pattern(name, k, p) for name, patterns in LABEL_SETS.items() for k, p in enumerate(patterns)]
LABELS: dict[str, list[int]] = {}
for _number, _p in enumerate(PATTERNS):
    for _s in spellings(_p.pattern):
        LABELS.setdefault(_s, []).append(_number)
FIRST_WORDS = sorted({s.split(" ")[0] for s in LABELS})


def numbers(label_set: str) -> list[int]:
    """Pattern numbers of a set, in the set's order."""
    return [i for i, p in enumerate(PATTERNS) if p.label_set == label_set]
