"""Secret scan: all rules in one deterministic automaton, one pass over the bytes of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from operator import length_hint

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from tidemark.llm.automaton import BYTES, Automaton, compiled, either_case
from tidemark.llm.common import texts, utf8

VALUE = "[A-Za-z0-9+/_.=-]"
LEAD = (
    "("
    + "|".join(either_case(name) for name in ("password", "passwd", "secret", "token", "api_?key"))
    + ")[\"']?\\x20*[:=]\\x20*[\"']?"
)


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``scan`` is compiled into the automaton. If ``full`` is given, a match
    counts only if that rule matches all of it; the others still use up their text."""

    kind: str
    scan: str
    full: str | None = None


# In the order of kinds. A rule that starts with a rare text leaves its length to ``full``,
# which keeps the automaton small; only runs of hex digits are counted while scanning, as
# ordinary words are full of shorter ones.
RULES = (
    Rule("assign", f"{LEAD}{VALUE}+", f"{LEAD}{VALUE}{{12,}}"),
    Rule("access", "AKIA[A-Z0-9]+", "AKIA[A-Z0-9]{14,}"),
    Rule("hex", "[0-9a-f]{16,}"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("pem", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)
BASE = 3

SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType()),
            StructField("start", LongType()),
            StructField("end", LongType()),
            StructField("base", BooleanType()),
        ]
    )
)


@cache
def _automata() -> tuple[list[list], list[Automaton], list[Automaton | None]]:
    """All rules as rows of the transition array, each with its states' rows by byte and its
    rules last; then one automaton for each rule's reversed matches, and for its full form."""
    scan = compiled([rule.scan for rule in RULES], unanchored=True)
    forward: list[list] = [[] for _ in scan.accepts]
    for state, row in enumerate(forward):
        moves = scan.moves[state * BYTES : (state + 1) * BYTES]
        row.extend(forward[to // BYTES] for to in moves)
        row.append(scan.accepts[state])
    backward = [compiled([rule.scan], unanchored=False, reverse=True) for rule in RULES]
    full = [compiled([rule.full], unanchored=False) if rule.full else None for rule in RULES]
    return forward, backward, full


def _ends(data: bytes, rows: list[list]) -> list[list[int]]:
    """For each rule the ends of its runs: matches end there, and none one byte further."""
    ends: list[list[int]] = [[] for _ in RULES]
    state, before, size = rows[0], 0, len(data)
    rest = iter(data)
    for byte in rest:
        state = state[byte]
        if state[BYTES] != before:
            gone = before & ~state[BYTES]
            for k in range(len(RULES)):
                if gone >> k & 1:
                    ends[k].append(size - length_hint(rest) - 1)
            before = state[BYTES]
    for k in range(len(RULES)):
        if before >> k & 1:
            ends[k].append(size)
    return ends


def _starts(data: bytes, end: int, floor: int, backward: Automaton) -> list[int]:
    """Where matches that end at ``end`` start, from the last to the first, none below ``floor``."""
    moves, accepts = backward.moves, backward.accepts
    dead = backward.stuck
    state, starts = 0, []
    for at in range(end - 1, floor - 1, -1):
        state = moves[state + data[at]]
        if state == dead:
            break
        if accepts[state >> 8]:
            starts.append(at)
    return starts


def _matches(automaton: Automaton, data: bytes) -> bool:
    state = 0
    for byte in data:
        state = automaton.moves[state + byte]
    return bool(automaton.accepts[state >> 8])


def _code_points(data: bytes, places: set[int]) -> dict[int, int]:
    """For places in UTF-8 ``data`` the number of characters before them, counted in one pass."""
    lead = np.frombuffer(data, dtype=np.uint8) & 0xC0 != 0x80
    count, before, out = 0, 0, {}
    for place in sorted(places):
        count += int(np.count_nonzero(lead[before:place]))
        before = place
        out[place] = count
    return out


def found(text: str | None) -> list[tuple[str, int, int, bool]]:
    """Spans of secrets in a text: (kind, start, end, base), in code points, in text order.

    Base spans are, kind by kind, leftmost and do not overlap, and those that fall short of
    their rule are left out after that. Further spans are assignments of full length that
    start inside the value of one that fell short, and the kinds beyond the base ones.
    """
    data = utf8(text)
    forward, backward, full = _automata()
    spans = []
    for k, ends in enumerate(_ends(data, forward)):
        rule, floor, taken = RULES[k], 0, 0
        for end in ends:
            starts = _starts(data, end, taken, backward[k])
            outside = [start for start in starts if start >= floor]
            if outside:
                start = min(outside)
                floor = end
                if full[k] is None or _matches(full[k], data[start:end]):
                    spans.append((start, k, end, k < BASE))
                    taken = end
                continue
            # Hidden by a match that fell short: kept beside the base ones.
            inside = [s for s in starts if full[k] and _matches(full[k], data[s:end])]
            if inside:
                spans.append((min(inside), k, end, False))
                taken = end
    spans.sort()
    if len(data) == len(text or ""):
        return [(RULES[k].kind, start, end, base) for start, k, end, base in spans]
    place = _code_points(data, {b for start, _, end, _ in spans for b in (start, end)})
    return [(RULES[k].kind, place[start], place[end], base) for start, k, end, base in spans]


@F.pandas_udf(SPANS)
def _secrets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([found(text) for text in texts(batch)], dtype=object)


def secret_spans(text: Column) -> Column:
    """All secrets of a text as ``array<struct<kind, start, end, base>>``.

    One pass of one automaton over the bytes finds where matches end; only there a second
    automaton walks back to where they start. NULL and empty texts have none. A text is
    scanned whole, whatever its length, in memory of its own size. Each row stands alone, so
    ties, repeated rows and other columns change nothing.
    """
    return _secrets(text)
