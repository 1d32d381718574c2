"""Words of many texts at once, as byte positions and 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np

# Bytes of text handled at once; a longer text is handled alone.
SLICE = 1 << 19
MASK = (1 << 64) - 1


@dataclass
class Words:
    data: np.ndarray  # bytes of the texts, A-Z lowered, white space as 0x20
    starts: np.ndarray  # of the words in data
    ends: np.ndarray
    texts: np.ndarray  # which text a word is in
    hashes: np.ndarray
    firsts: np.ndarray  # where the texts start in data


def slices(values: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about SLICE bytes, each with the place of its first text."""
    begin = held = 0
    for i, value in enumerate(values):
        held += len(value)
        if held >= SLICE:
            yield begin, values[begin : i + 1]
            begin, held = i + 1, 0
    if begin < len(values):
        yield begin, values[begin:]


def words_of(values: list[bytes], space: bytes, apart: bytes = b"\n", seed: int = 1) -> Words:
    """The words of ``values`` (UTF-8): runs of bytes that are not in ``space``.

    Texts are joined by ``apart``, one of ``space``. Equal words have equal hashes.
    """
    raw = np.frombuffer(apart.join(values), dtype=np.uint8)
    lower, gap = _tables(space)
    data, inside = lower[raw], ~gap[raw]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    sizes = np.array([len(value) + 1 for value in values], dtype=np.int64)
    firsts = np.cumsum(sizes) - sizes
    texts = np.searchsorted(firsts, starts, side="right") - 1
    return Words(data, starts, ends, texts, _hashes(data, starts, ends, seed), firsts)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result hangs on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(hashes: np.ndarray, count: int, start: np.ndarray | int = 0) -> np.ndarray:
    """Hashes of every ``count`` words in a row, in order; ``start`` is hashed before them."""
    most = len(hashes) - count + 1
    if most <= 0:
        return np.zeros(0, dtype=np.uint64)
    held = np.broadcast_to(np.asarray(start, dtype=np.uint64), len(hashes))[:most]
    for i in range(count):
        held = mixed(held * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + most])
    return held


@cache
def _tables(space: bytes) -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    gap = np.zeros(256, dtype=bool)
    gap[list(space)] = True
    lower[gap & np.isin(np.arange(256), [9, 10, 11, 12, 13])] = 32
    return lower, gap


@cache
def _values(seed: int) -> tuple[np.ndarray, int]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 64, 256, dtype=np.uint64), int(rng.integers(0, 1 << 62)) * 2 + 1


@cache
def _powers(seed: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    _, base = _values(seed)
    out = []
    for factor in (base, pow(base, -1, 1 << 64)):
        row = np.full(1 << bits, factor, dtype=np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A word's hash: the sum of a random value of each byte times a power of its place, from
    differences of running sums, modulo 2**64."""
    values, _ = _values(seed)
    out = np.zeros(len(starts), dtype=np.uint64)
    # A very long text goes in parts that end between words, so powers stay a bounded table.
    begin = 0
    while begin < len(starts):
        low = starts[begin]
        stop = max(begin + 1, int(np.searchsorted(ends, low + SLICE, side="right")))
        high = ends[stop - 1]
        powers, inverse = _powers(seed, max(int(high - low).bit_length(), 16))
        held = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(values[data[low:high]] * powers[: high - low], out=held[1:])
        first, last = starts[begin:stop] - low, ends[begin:stop] - low
        out[begin:stop] = (held[last] - held[first]) * inverse[first]
        begin = stop
    return mixed(out)
