"""Substring dedup by sliding spans of units that the words alone decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.llm.common import texts
from tidemark.llm.sentences import KEPT, cut_out, later_spans

# A unit ends at a sentence mark, and at one word at least of every WINDOW without a mark. Words
# nearer than WINDOW to the ends of a passage may be cut in other ways; of 50 words, the 32
# between have ends from their 10th to their 23rd word, three at least: a span of 2 units
# and 10 words.
WINDOW = 10
SENTENCES = 2
WORDS = 10
# Spans made before they are handed over.
ROWS = 1 << 16

_MARKS = ".!?…‼⁇⁈⁉。．｡！？।॥؟۔։።፧។៕᠃᠉။๏"
_CLOSERS = "\"')]}»’”›」』】）〉》"
# Scripts without spaces between words: each character is a word.
_ALONE = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3001, 0x30FF), (0x3400, 0x4DBF),
    (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF01, 0xFF9F), (0x20000, 0x3FFFF),
)


def _kinds() -> np.ndarray:
    kinds = np.zeros(0x110000, dtype=np.uint8)
    kinds[[code for code in range(0x3001) if chr(code).isspace()]] = 1
    for first, last in _ALONE:
        kinds[first : last + 1] |= 2
    kinds[[ord(mark) for mark in _MARKS]] |= 4
    kinds[[ord(closer) for closer in _CLOSERS]] |= 8
    return kinds


_kind = _kinds()


def units(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bounds, places, offsets, words): word numbers and characters at which units start, with
    the ends of the text, then where each word starts in ``words``, the words as compared.

    Words are apart at white space, A-Z lowered; where they end does not depend on it: a text in
    other lines has the same units.
    """
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = _kind[codes]
    solid = (kind & 1) == 0
    alone = (kind & 2) > 0
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | alone[1:] | alone[:-1]
    count = int(starts.sum())
    if not count:
        none = np.zeros(1, dtype=np.int64)
        return none, none, none, np.zeros(0, dtype=np.uint32)
    low = codes[solid]
    low = np.where((low >= 65) & (low <= 90), low + 32, low).astype(np.uint32)
    first = np.flatnonzero(starts[solid])
    offsets = np.append(first, len(low)) + np.arange(count + 1)
    words = np.full(len(low) + count, 32, dtype=np.uint32)
    words[np.arange(len(low)) + np.repeat(np.arange(count), np.diff(first, append=len(low)))] = low
    last = np.append(first[1:], len(low)) - 1
    kind = kind[solid]
    marked = (kind[last] & 4) > 0
    marked |= ((kind[last] & 8) > 0) & (last > first) & ((kind[last - 1] & 4) > 0)
    ends = marked.copy()
    ends[-1] = True
    if count >= WINDOW:
        mixed = (low.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        place = np.add.reduceat(mixed * np.uint64(0xBF58476D1CE4E5B9), first)
        place = (place ^ (place >> np.uint64(32))) * np.uint64(0x94D049BB133111EB) | np.uint64(1)
        place[marked] = 0
        # Of equal words the last one ends the unit.
        seen = np.lib.stride_tricks.sliding_window_view(place[::-1], WINDOW).argmin(axis=1)
        ends[count - 1 - np.unique(seen + np.arange(len(seen)))] = True
    bounds = np.append(0, np.flatnonzero(ends) + 1)
    characters = np.flatnonzero(starts)
    places = np.append(0, np.append(characters, len(codes))[bounds[1:]])
    places[-1] = len(codes)
    return bounds, places, offsets, words


def runs(bounds: np.ndarray, least: int = SENTENCES, words_least: int = WORDS) -> np.ndarray:
    """Spans, as rows of first unit and last unit: for every unit the shortest run from there that
    has ``least`` units and ``words_least`` words.

    A text too short for any is one span as a whole, unless it has no words.
    """
    count = len(bounds) - 1
    ends = np.searchsorted(bounds, bounds[:-1] + words_least)
    ends = np.maximum(ends, np.arange(count) + least)
    found = np.stack([np.arange(count), ends - 1], axis=1)[ends <= count]
    if not len(found) and count:
        found = np.array([[0, count - 1]])
    return found


def _spans_of(least: int, words_least: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            held: list[np.ndarray] = []
            digests: list[bytes] = []
            for i, text in enumerate(batch.column("_text")):
                bounds, _, offsets, words = units(text.as_py())
                found = runs(bounds, least, words_least)
                raw = memoryview(words.tobytes())
                at = 4 * offsets[bounds]
                digests += [
                    xxhash.xxh3_128_digest(raw[a:b])
                    for a, b in zip(at[found[:, 0]].tolist(), at[found[:, 1] + 1].tolist())
                ]
                held.append(found)
                rows += [i] * len(found)
                if len(rows) >= ROWS:
                    yield made(batch, rows, held, digests)
                    rows, held, digests = [], [], []
            if rows:
                yield made(batch, rows, held, digests)

    def made(batch, rows, held, digests) -> pa.RecordBatch:
        pairs = np.concatenate(held).astype(np.int32)
        halves = np.frombuffer(b"".join(digests), dtype=">i8").reshape(-1, 2).astype(np.int64)
        columns = [batch.column(name).take(pa.array(rows)) for name in ("_key", "_text_hash")]
        columns += [pa.array(np.ascontiguousarray(pairs[:, k])) for k in (0, 1)]
        columns += [pa.array(np.ascontiguousarray(halves[:, k])) for k in (0, 1)]
        names = ["_key", "_text_hash", "first", "last", "high", "low"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    return of


@F.pandas_udf(KEPT)
def _without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for batch, removed in batches:
        rows = []
        for text, gone in zip(texts(batch), removed):
            _, places, _, _ = units(text)
            keep = np.ones(len(places) - 1, dtype=bool)
            for first, last in gone if gone is not None else ():
                keep[first : last + 1] = False
            kept = text
            if not keep.all():
                kept = "".join(text[places[i] : places[i + 1]] for i in np.flatnonzero(keep))
            rows.append((len(keep), kept))
        yield pd.DataFrame(rows, columns=KEPT.names)


def repeated_passages(
    docs: DataFrame,
    key: Column,
    text: str = "text",
    least: int = SENTENCES,
    words_least: int = WORDS,
) -> DataFrame:
    """Spans of units that are not the first of their kind, as ``repeated_spans`` has them."""
    rows = docs.select(
        key.alias("_key"), F.xxhash64(F.col(text)).alias("_text_hash"), F.col(text).alias("_text")
    )
    numbers = [StructField(name, IntegerType()) for name in ("first", "last")]
    numbers += [StructField(name, LongType()) for name in ("high", "low")]
    schema = StructType([*rows.schema.fields[:2], *numbers])
    return later_spans(rows.mapInArrow(_spans_of(least, words_least), schema))


def without_passages(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    out: str = "deduplicated",
    least: int = SENTENCES,
    words_least: int = WORDS,
) -> DataFrame:
    """``docs`` with ``out``, as ``without_repeats`` makes it, but of units instead of sentences:
    passages of 50 words that are alike lose all but less than 20 words at each end, whatever
    stands around them, with or without sentence marks, in lines or not.
    """
    removed = repeated_passages(docs, F.col(f"`{key}`"), text, least, words_least)
    return cut_out(docs, removed, _without, key, text, out)
