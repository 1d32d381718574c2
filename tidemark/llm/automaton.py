"""Regexes to one deterministic automaton: subset construction and minimisation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

BYTES = 256
# A set of byte values is an int with one bit for each.
ANY = (1 << BYTES) - 1


class _Rule:
    """Reads one rule into fragments of a nondeterministic automaton.

    Known: literals, ``.``, ``\\xHH`` and escaped characters, classes with ranges and ``^``,
    groups, ``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}``. A rule matches bytes.
    ``reverse`` builds the automaton of the reversed matches.
    """

    def __init__(self, rule: str, states: list, reverse: bool) -> None:
        self.rule, self.at, self.states, self.reverse = rule, 0, states, reverse

    def state(self) -> int:
        self.states.append(([], []))  # (bytes, next) pairs; empty moves
        return len(self.states) - 1

    def peek(self) -> str:
        return self.rule[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.rule[self.at - 1]

    def alternatives(self) -> tuple[int, int]:
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        start, end = self.state(), self.state()
        for a, b in options:
            self.states[start][1].append(a)
            self.states[b][1].append(end)
        return start, end

    def sequence(self) -> tuple[int, int]:
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        if self.reverse:
            parts.reverse()
        start = end = self.state()
        for a, b in parts:
            self.states[end][1].append(a)
            end = b
        return start, end

    def repeated(self) -> tuple[int, int]:
        begin = self.at
        part = self.atom()
        after = self.at
        least, most = 1, 1
        mark = self.peek()
        if mark and mark in "?*+":
            self.take()
            least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[mark]
        elif mark == "{":
            low, comma, high = self.rule[self.at + 1 : self.rule.index("}", self.at)].partition(",")
            self.at = self.rule.index("}", self.at) + 1
            least, most = int(low), int(high) if high else None if comma else int(low)
        else:
            return part
        resume = self.at
        copies = [part]
        while len(copies) < max(least + (most is None), most or 0, 1):
            self.at = begin
            copies.append(self.atom())
        assert most is not None or self.at in (after, resume)
        self.at = resume
        start = end = self.state()
        stop = self.state()
        for i, (a, b) in enumerate(copies):
            if i >= least:
                self.states[end][1].append(stop)
            self.states[end][1].append(a)
            end = b
        if most is None:
            self.states[end][1].append(copies[-1][0])
        if least == 0 and most is None:
            self.states[start][1].append(stop)
        if most is None and len(copies) > least:
            # The last copy is the one that repeats; it may also be left out.
            before = copies[-2][1] if len(copies) > 1 else start
            self.states[before][1].append(stop)
        self.states[end][1].append(stop)
        return start, stop

    def atom(self) -> tuple[int, int]:
        mark = self.take()
        if mark == "(":
            part = self.alternatives()
            assert self.take() == ")"
            return part
        values = self.byte_class() if mark == "[" else self.single(mark)
        start, end = self.state(), self.state()
        self.states[start][0].append((values, end))
        return start, end

    def single(self, mark: str) -> int:
        if mark == ".":
            return ANY
        return 1 << self.code(mark)

    def code(self, mark: str) -> int:
        if mark != "\\":
            return ord(mark)
        mark = self.take()
        if mark != "x":
            return ord(mark)
        self.at += 2
        return int(self.rule[self.at - 2 : self.at], 16)

    def byte_class(self) -> int:
        negated = self.peek() == "^"
        if negated:
            self.take()
        values = 0
        while self.peek() != "]":
            low = high = self.code(self.take())
            if self.peek() == "-" and self.rule[self.at + 1] != "]":
                self.take()
                high = self.code(self.take())
            for value in range(low, high + 1):
                values |= 1 << value
        self.take()
        return ANY & ~values if negated else values


@dataclass(frozen=True)
class Automaton:
    """``moves[state + byte]`` is the next state, states being multiples of 256; ``accepts[state
    >> 8]`` is a bit set of the rules that match up to here; state 0 is the start, ``stuck``
    the one that nothing leads out of, -1 if there is none."""

    moves: list[int]
    accepts: list[int]
    stuck: int


def either_case(rule: str) -> str:
    """``rule``, a plain text of letters and rule marks, with every letter in either case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in rule)


def _classes(states: list) -> list[int]:
    """For every byte value a number; bytes that no state tells apart share one."""
    sets = {values for moves, _ in states for values, _ in moves}
    listed = sorted(sets)
    seen: dict[tuple, int] = {}
    return [
        seen.setdefault(tuple(values >> byte & 1 for values in listed), len(seen))
        for byte in range(BYTES)
    ]


def compiled(rules: Sequence[str], unanchored: bool, reverse: bool = False) -> Automaton:
    """One automaton for all ``rules``; ``unanchored``: matches may start at every byte."""
    states: list = []
    root = _Rule("", states, reverse).state()
    finals = {}
    for k, rule in enumerate(rules):
        start, end = _Rule(rule, states, reverse).alternatives()
        states[root][1].append(start)
        finals[end] = 1 << k
    if unanchored:
        states[root][0].append((ANY, root))

    def closed(found: set[int]) -> frozenset[int]:
        todo = list(found)
        while todo:
            for other in states[todo.pop()][1]:
                if other not in found:
                    found.add(other)
                    todo.append(other)
        return frozenset(found)

    # Subset construction over classes of bytes.
    classes = _classes(states)
    samples = [classes.index(k) for k in range(max(classes) + 1)]
    numbers = {closed({root}): 0}
    order, table = list(numbers), []
    for subset in order:
        row = []
        for byte in samples:
            target = closed(
                {to for s in subset for values, to in states[s][0] if values >> byte & 1}
            )
            if target not in numbers:
                numbers[target] = len(numbers)
                order.append(target)
            row.append(numbers[target])
        table.append(row)
    accepts = []
    for subset in order:
        bits = 0
        for s in subset:
            bits |= finals.get(s, 0)
        accepts.append(bits)

    # Minimisation: blocks of states are split until all in a block move alike.
    block = accepts
    count = len(set(block))
    while True:
        names: dict[tuple, int] = {}
        block = [
            names.setdefault((block[s], *[block[t] for t in row]), len(names))
            for s, row in enumerate(table)
        ]
        if len(names) == count:
            break
        count = len(names)
    moves, least_accepts = [0] * (count * BYTES), [0] * count
    for s, row in enumerate(table):
        least_accepts[block[s]] = accepts[s]
        for byte in range(BYTES):
            moves[block[s] * BYTES + byte] = block[row[classes[byte]]] * BYTES
    stuck = [
        s * BYTES
        for s, bits in enumerate(least_accepts)
        if not bits and set(moves[s * BYTES : (s + 1) * BYTES]) == {s * BYTES}
    ]
    return Automaton(moves, least_accepts, stuck[0] if stuck else -1)
