"""Patterns over the events of one key: elements, combinators, and explicit automata.

A pattern compiles to plain tables (arcs per state, start states, final states) that travel to the tasks. Register
and accumulator functions are small Python callables; conditions may be native boolean columns, which are
evaluated by Spark before the automaton sees the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from .time import INF


@dataclass(frozen=True)
class Element:
    """What one arc consumes: a lone event (`single`) or all events of one instant (`list`).

    `cond(t, event(s), register)` may be a Column for single elements. `update` makes the new register.
    """

    kind: str
    cond: object
    update: Callable | None = None


class Pattern:
    """Position sets of a regular pattern: every element occurrence is a position."""

    def __init__(self, elements, first, last, follow, nullable):
        self.elements = elements
        self.first, self.last = frozenset(first), frozenset(last)
        self.follow = follow
        self.nullable = nullable

    def _moved(self, by: int) -> Pattern:
        return Pattern(
            self.elements,
            {p + by for p in self.first},
            {p + by for p in self.last},
            {p + by: {q + by for q in qs} for p, qs in self.follow.items()},
            self.nullable,
        )

    def then(self, other: Pattern) -> Pattern:
        """Concatenation."""
        b = other._moved(len(self.elements))
        follow = {p: set(q) for p, q in (self.follow | b.follow).items()}
        for p in self.last:
            follow[p] |= b.first
        first = self.first | (b.first if self.nullable else frozenset())
        last = b.last | (self.last if b.nullable else frozenset())
        return Pattern(self.elements + b.elements, first, last, follow, self.nullable and b.nullable)

    def either(self, other: Pattern) -> Pattern:
        b = other._moved(len(self.elements))
        return Pattern(
            self.elements + b.elements,
            self.first | b.first,
            self.last | b.last,
            {p: set(q) for p, q in (self.follow | b.follow).items()},
            self.nullable or b.nullable,
        )

    def repeated(self) -> Pattern:
        """One or more."""
        follow = {p: set(q) | (self.first if p in self.last else set()) for p, q in self.follow.items()}
        return Pattern(self.elements, self.first, self.last, follow, self.nullable)

    def optional(self) -> Pattern:
        return Pattern(self.elements, self.first, self.last, self.follow, True)

    def any_number(self) -> Pattern:
        """Zero or more."""
        return self.repeated().optional()

    def compile(self) -> Automaton:
        a = Automaton()
        for p in self.first:
            a.arc(0, p + 1, self.elements[p])
        for p, nexts in sorted(self.follow.items()):
            for q in sorted(nexts):
                a.arc(p + 1, q + 1, self.elements[q])
        for p in self.last:
            a.final(p + 1)
        return a


def _leaf(element: Element) -> Pattern:
    return Pattern([element], {0}, {0}, {0: set()}, False)


def single(cond, update=None) -> Pattern:
    """A lone event at its instant. Simultaneous events of the key break the match."""
    return _leaf(Element("single", cond, update))


def listed(cond, update=None) -> Pattern:
    """All events of one instant together: `cond(t, events, register)`."""
    return _leaf(Element("list", cond, update))


def folded(start, step, accept, update=None, stop=None) -> Pattern:
    """Fold over the events of one instant.

    `start(t, reg)` begins, `step(t, event, reg, acc)` accumulates until `stop(t, event, acc)`, `accept(t, acc,
    reg)` decides and `update(t, acc, reg)` makes the register.
    """

    def fold(t, events, reg):
        acc = start(t, reg)
        for e in events:
            acc = step(t, e, reg, acc)
            if stop is not None and stop(t, e, acc):
                break
        return acc

    def cond(t, events, reg):
        return accept(t, fold(t, events, reg), reg)

    new = None if update is None else lambda t, events, reg: update(t, fold(t, events, reg), reg)
    return listed(cond, new)


def any_of(cond, update=None) -> Pattern:
    """At least one event of the instant satisfies `cond(t, event, reg)`."""
    return listed(lambda t, events, reg: any(cond(t, e, reg) for e in events), update)


def all_of(cond, update=None) -> Pattern:
    """Every event of the instant satisfies `cond(t, event, reg)`."""
    return listed(lambda t, events, reg: all(cond(t, e, reg) for e in events), update)


def nothing() -> Pattern:
    """The empty pattern: a move without an event."""
    return Pattern([], set(), set(), {}, True)


def sequence(*patterns) -> Pattern:
    out = patterns[0]
    for p in patterns[1:]:
        out = out.then(p)
    return out


def sequence_prefixes(*patterns) -> Pattern:
    """A sequence of which each prefix is a match too."""
    out, ends = patterns[0], set(patterns[0].last)
    for p in patterns[1:]:
        out = out.then(p)
        ends |= out.last
    return Pattern(out.elements, out.first, ends, out.follow, out.nullable)


def one_of(*patterns) -> Pattern:
    out = patterns[0]
    for p in patterns[1:]:
        out = out.either(p)
    return out


@dataclass
class Automaton:
    """Explicit states and arcs. State 0 starts unless `start` says otherwise."""

    arcs: dict[int, list] = field(default_factory=dict)
    free: dict[int, list] = field(default_factory=dict)
    finals: set = field(default_factory=set)
    start: int = 0
    register: object = None

    def arc(self, source: int, target: int, element: Element) -> Automaton:
        self.arcs.setdefault(source, []).append((element, target))
        return self

    def single(self, source, target, cond, update=None) -> Automaton:
        return self.arc(source, target, Element("single", cond, update))

    def listed(self, source, target, cond, update=None) -> Automaton:
        return self.arc(source, target, Element("list", cond, update))

    def epsilon(self, source, target) -> Automaton:
        self.free.setdefault(source, []).append(target)
        return self

    def final(self, state) -> Automaton:
        self.finals.add(state)
        return self

    def not_final(self, state) -> Automaton:
        self.finals.discard(state)
        return self

    def default_register(self, value) -> Automaton:
        self.register = value
        return self

    def compile(self) -> Automaton:
        return self

    def reach(self, state) -> list[int]:
        """The state and all states reachable from it by free moves."""
        seen, todo = [], [state]
        while todo:
            s = todo.pop()
            if s not in seen:
                seen.append(s)
                todo.extend(self.free.get(s, ()))
        return seen

    def conditions(self) -> list[Column]:
        """Native conditions, in arc order."""
        found = []
        for arcs in self.arcs.values():
            for element, _ in arcs:
                if isinstance(element.cond, Column) and not any(element.cond is c for c in found):
                    found.append(element.cond)
        return found

    def tables(self, register=None) -> dict:
        """Plain tables for the tasks: native conditions become column numbers."""
        native = self.conditions()

        def test(element):
            for i, c in enumerate(native):
                if element.cond is c:
                    return i
            return element.cond

        arcs = {
            s: [(e.kind == "single", test(e), e.update, self.reach(t)) for e, t in out]
            for s, out in self.arcs.items()
        }
        start = register if register is not None else self.register
        return {"arcs": arcs, "starts": self.reach(self.start), "finals": set(self.finals), "register": start}


class Matcher:
    """Runs one key's events, instant by instant. Instances are (state, register, start time)."""

    def __init__(self, tables, max_duration, overlapping=True, deterministic=False, instances=()):
        self.arcs, self.finals = tables["arcs"], tables["finals"]
        self.starts, self.register = tables["starts"], tables["register"]
        self.max_duration, self.overlapping, self.deterministic = max_duration, overlapping, deterministic
        self.instances = list(instances)
        self.lists = any(not single for out in self.arcs.values() for single, *_ in out)

    def _moves(self, state, t, events, reg):
        for is_single, cond, update, reach in self.arcs.get(state, ()):
            if is_single:
                if len(events) != 1:
                    continue
                seen = events[0]
                ok = seen[1][cond] if isinstance(cond, int) else cond(t, seen[0], reg)
                given = seen[0]
            else:
                given = [e for e, _ in events]
                ok = cond(t, given, reg)
            if ok:
                yield (reg if update is None else update(t, given, reg)), reach
                if self.deterministic:
                    return

    def at(self, t, events, may_start=True):
        """Process the events of one instant, as (event, native condition values); returns the matches."""
        found, alive = [], []
        for state, reg, began in self.instances:
            if began + self.max_duration <= t:
                continue
            for new, reach in self._moves(state, t, events, reg):
                self._enter(new, reach, began, alive, found)
        self.instances = alive
        if may_start and (self.overlapping or not alive):
            fresh = []
            for state in self.starts:
                for new, reach in self._moves(state, t, events, self.register):
                    self._enter(new, reach, t, fresh, found)
            self.instances = alive + fresh
        return [(t, min(began + self.max_duration, INF), reg) for began, reg in found]

    def _enter(self, reg, reach, began, alive, found):
        for s in reach:
            if s in self.finals:
                found.append((began, reg))
            if s in self.arcs:
                alive.append((s, reg, began))
