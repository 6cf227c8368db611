"""Selectors with combinators, compiled to a state machine over the stack of open elements.

A selector `a > b c + d, e` is a list of steps, each a compound and how it hangs on the step
before. The state of an element is a number whose bit i says that it ends step i. The bits an
element may get follow from the states of its parent, its ancestors and its siblings before
it, so one pass over the tags decides, with a few integers for each open element.

Read are tag names, `*`, `#id`, `.class`, `[name]` and `[name op value]` with the operators
`= ~= |= ^= $= *=` and the flag `i`; blank, `>`, `+` and `~` between compounds; commas.
Pseudo-classes and escapes are refused.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass

from pyspark import cloudpickle

# Goes to the Python workers with the query, like the parser that uses it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s\]"']+)"""
_TEST = rf"\[\s*([\w-]+)\s*(?:([~|^$*]?=)\s*({_VALUE})\s*([iI]?)\s*)?\]"
_PART = re.compile(rf"#([\w-]+)|\.([\w-]+)|{_TEST}")
_COMPOUND = re.compile(rf"(\*|[a-zA-Z][\w-]*)?((?:#[\w-]+|\.[\w-]+|{_TEST})*)")
_COMBINATOR = re.compile(r"\s*([>+~,])\s*|\s+")


@dataclass(frozen=True)
class Test:
    """A condition on one attribute; op '' asks only that it is there."""

    name: str
    op: str = ""
    value: str = ""
    any_case: bool = False

    def holds(self, attrs: dict[str, str | None]) -> bool:
        if self.name not in attrs:
            return False
        given, value = attrs[self.name] or "", self.value
        if self.any_case:
            given, value = given.lower(), value.lower()
        match self.op:
            case "":
                return True
            case "=":
                return given == value
            case "~=":
                return value in given.split()
            case "|=":
                return given == value or given.startswith(value + "-")
            case "^=":
                return value != "" and given.startswith(value)
            case "$=":
                return value != "" and given.endswith(value)
        return value != "" and value in given


@dataclass(frozen=True)
class Compound:
    """Conditions on one element; classes and ids are tests, too."""

    tag: str
    tests: tuple[Test, ...]

    def matches(self, tag: str, attrs: dict[str, str | None]) -> bool:
        return self.tag in ("", tag) and all(t.holds(attrs) for t in self.tests)


def _compound(tag: str | None, parts: str) -> Compound:
    tests = []
    for id_, class_, name, op, value, flag in _PART.findall(parts):
        if id_:
            tests.append(Test("id", "=", id_))
        elif class_:
            tests.append(Test("class", "~=", class_))
        else:
            tests.append(Test(name.lower(), op, value.strip("\"'") if op else "", bool(flag)))
    return Compound("" if tag in (None, "*") else tag.lower(), tuple(tests))


@dataclass
class Frame:
    """What the steps need to know of an open element."""

    own: int = 0
    # Bits of the element and of its ancestors.
    inside: int = 0
    # Bits of its last child so far, and of all of them.
    last: int = 0
    before: int = 0


@dataclass(frozen=True)
class Path:
    """A compiled selector: compounds by bit, and the bits that hang on each kind of neighbour."""

    compounds: tuple[Compound, ...]
    starts: int
    descendants: int
    children: int
    adjacent: int
    siblings: int
    ends: int

    @staticmethod
    def of(text: str) -> Path:
        compounds: list[Compound] = []
        masks = dict.fromkeys(", >+~", 0)
        ends, at, relation, selector = 0, 0, ",", text.strip()
        while True:
            found = _COMPOUND.match(selector, at)
            if found.end() == at:
                raise ValueError(f"not a selector: {text!r}")
            masks[relation] |= 1 << len(compounds)
            compounds.append(_compound(found[1], found[2]))
            at = found.end()
            between = _COMBINATOR.match(selector, at) if at < len(selector) else None
            if between is None and at < len(selector):
                raise ValueError(f"not a selector: {text!r}")
            relation = "," if between is None else between[1] or " "
            if relation == ",":
                ends |= 1 << len(compounds) - 1
            if between is None:
                return Path(tuple(compounds), *(masks[r] for r in ", >+~"), ends)
            at = between.end()

    def attributes(self) -> set[str]:
        return {t.name for c in self.compounds for t in c.tests}

    def state(self, tag: str, attrs: dict[str, str | None], parent: Frame) -> int:
        """The bits of an element from its parent's frame, which is brought up to date."""
        may = self.starts
        may |= parent.inside << 1 & self.descendants | parent.own << 1 & self.children
        may |= parent.last << 1 & self.adjacent | parent.before << 1 & self.siblings
        own = 0
        for i, compound in enumerate(self.compounds):
            if may >> i & 1 and compound.matches(tag, attrs):
                own |= 1 << i
        parent.last = own
        parent.before |= own
        return own
