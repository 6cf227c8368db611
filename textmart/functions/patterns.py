"""What a text must contain for a pattern to be found in it.

From a regular expression follow strings of which at least one occurs, in small letters,
in every text it matches (in small letters, too). A table of very many patterns is indexed by such strings,
so that a text is tested against those patterns only that can match it.

Only ASCII characters count, since case beyond them differs between languages. A
pattern that needs no string, or that is not understood here, gets none: it can match any text.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from re import _constants as op
from re import _parser as parser

import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Sets of strings beyond this are split or given up.
MOST = 64
LONGEST = 64
Strings = frozenset[str] | None


def better(a: Strings, b: Strings) -> Strings:
    """Of two requirements that both hold the more selective one: that of the longer shortest string."""
    usable = [s for s in (a, b) if s and min(map(len, s)) > 0]
    return max(usable, key=lambda s: (min(map(len, s)), -len(s)), default=None)


def of_sequence(items) -> tuple[Strings, Strings]:
    """(all strings it can be, or None if they are not few; strings of which one must be in it)."""
    now, need, whole = frozenset([""]), None, True
    for kind, value in items:
        exact, inner = of_item(kind, value)
        need = better(need, inner)
        if exact is not None and len(now) * len(exact) <= MOST and max(map(len, now)) + max(map(len, exact)) <= LONGEST:
            now = frozenset(a + b for a in now for b in exact)
            continue
        need, whole = better(need, now), False
        now = exact if exact is not None else frozenset([""])
    return (now, need) if whole else (None, better(need, now))


def of_item(kind, value) -> tuple[Strings, Strings]:
    if kind is op.LITERAL:
        return (frozenset([chr(value).lower()]), None) if value < 128 else (None, None)
    if kind is op.IN:
        if len(value) <= 8 and all(k is op.LITERAL and v < 128 for k, v in value):
            return frozenset(chr(v).lower() for _, v in value), None
        return None, None
    if kind is op.BRANCH:
        branches = [of_sequence(b) for b in value[1]]
        if all(e is not None for e, _ in branches) and sum(len(e) for e, _ in branches) <= MOST:
            return frozenset().union(*[e for e, _ in branches]), None
        needs = [better(e, n) for e, n in branches]
        return None, frozenset().union(*needs) if all(needs) and sum(map(len, needs)) <= MOST else None
    if kind is op.SUBPATTERN:
        return of_sequence(value[3])
    if kind is getattr(op, "ATOMIC_GROUP", None):
        return of_sequence(value)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, getattr(op, "POSSESSIVE_REPEAT", None)):
        least, most, inner = value
        exact, need = of_sequence(inner)
        if most == 1 and exact is not None:
            return exact if least else exact | {""}, None
        return None, better(exact, need) if least else None
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return frozenset([""]), None
    return None, None


# Where Java's patterns mean something else than Python's parser takes them for.
DIFFERENT = re.compile(r"\[[^\]]*\[|&&|\\[v0]")


def required(pattern: str) -> list[str]:
    """Strings in small letters of which one is in each text where the pattern is found; none: it can match any text."""
    if DIFFERENT.search(pattern):
        return []
    try:
        tree = parser.parse(pattern)
    except Exception:  # a construct of another dialect
        return []
    if tree.state.flags & parser.SRE_FLAG_VERBOSE:
        return []
    need = better(*of_sequence(tree))
    return sorted(need) if need else []


def literals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For `mapInArrow`: (rule, pattern) with the pattern's required strings."""
    for batch in batches:
        found = [required(p) for p in batch.column("pattern").to_pylist()]
        yield pa.record_batch([*batch.columns, pa.array(found, pa.list_(pa.string()))], names=[*batch.schema.names, "strings"])
