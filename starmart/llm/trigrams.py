"""Boolean trigram queries that every match of a regular expression satisfies."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as op
from re import _parser as parser

# More alternatives than this end the literal run they belong to.
MOST_STRINGS = 64
Alternative = frozenset[str]


@dataclass(frozen=True)
class TrigramQuery:
    """AND of clauses; a clause is an OR of trigram sets, each all of which must
    be present. No clause: nothing is mandatory, the rule scans every text.
    Trigrams are lower case: the index folds case."""

    clauses: tuple[tuple[Alternative, ...], ...]

    @property
    def trigrams(self) -> set[str]:
        return {t for clause in self.clauses for alternative in clause for t in alternative}


def trigrams(text: str) -> Alternative:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _strings(node) -> set[str] | None:
    """All strings that a part can match, None if they are too many to list."""
    kind, value = node
    if kind is op.LITERAL:
        return {chr(value).lower()}
    if kind is op.SUBPATTERN:
        return _sequence(value[3])
    if kind is op.BRANCH:
        found = [_sequence(branch) for branch in value[1]]
        if any(x is None for x in found):
            return None
        joined = set().union(*found)
        return joined if len(joined) <= MOST_STRINGS else None
    if kind is op.MAX_REPEAT and value[1] <= 2:
        low, high, inner = value
        each = _sequence(inner)
        if each is None:
            return None
        found = {"".join(x) for n in range(low, high + 1) for x in product(each, repeat=n)}
        return found if len(found) <= MOST_STRINGS else None
    if kind is op.IN and all(k is op.LITERAL for k, _ in value):
        return {chr(v).lower() for _, v in value}
    return None


def _sequence(nodes) -> set[str] | None:
    found = {""}
    for node in nodes:
        more = _strings(node)
        if more is None:
            return None
        found = {a + b for a in found for b in more}
        if len(found) > MOST_STRINGS:
            return None
    return found


def trigram_query(pattern: str) -> TrigramQuery:
    """Literal runs of the top-level sequence, one clause each. A run with an
    alternative shorter than a trigram demands nothing."""
    clauses, run = [], {""}

    def flush():
        if all(len(s) >= 3 for s in run):
            sets = {trigrams(s) for s in run}
            # A set that holds another one adds nothing to the OR.
            least = [s for s in sets if not any(other < s for other in sets)]
            clauses.append(tuple(sorted(least, key=sorted)))

    for node in parser.parse(pattern):
        more = _strings(node)
        longer = None if more is None else {a + b for a in run for b in more}
        if longer is None or len(longer) > MOST_STRINGS:
            flush()
            run = {""} if longer is None else more
        else:
            run = longer
    flush()
    return TrigramQuery(tuple(clauses))
