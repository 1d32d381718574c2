"""Substring dedup by sliding spans of sentences."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidemark.llm.common import free_name, kept, texts, utf8

# A span is the shortest run of at least SENTENCES sentences with at least WORDS words.
SENTENCES = 2
WORDS = 10

# A sentence with the marks and line ends after it; the sentences of a text add up to it.
_sentence = re.compile(r"[^.!?\n]+[.!?\n]*|[.!?\n]+")
_sentence_bytes = re.compile(rb"[^.!?\n]+[.!?\n]*|[.!?\n]+")

SPANS = ArrayType(
    StructType(
        [
            StructField("first", IntegerType()),
            StructField("last", IntegerType()),
            StructField("high", LongType()),
            StructField("low", LongType()),
        ]
    )
)
KEPT = StructType([StructField("n_sentences", LongType()), StructField("kept", StringType())])


def sentences(text: str | None) -> list[str]:
    return _sentence.findall(text or "")


def compared(text: str | None) -> list[list[bytes]]:
    """The words of every sentence as compared: A-Z lowered, apart at ASCII white space.

    The text is lowered and cut once, as UTF-8: its marks and white space are ASCII, and on
    bytes ``lower`` and ``split`` know no others.
    """
    return [sentence.split() for sentence in _sentence_bytes.findall(utf8(text).lower())]


def spans(text: str | None, least: int = SENTENCES, words_least: int = WORDS) -> list[tuple]:
    """(first, last, high, low) for every sentence at which a span starts.

    A span is the shortest run from there that has ``least`` sentences and ``words_least``
    words; the text's last sentences, where no such run starts, are covered by earlier spans.
    A text too short for any span is one span as a whole, unless it has no words. high and
    low are a 128-bit hash of the words.
    """
    cut = compared(text)
    sizes = [len(part) for part in cut]
    joined = [b" ".join(part) for part in cut]
    found, last, held = [], -1, 0
    for first in range(len(cut)):
        while last + 1 < len(cut) and (last - first + 1 < least or held < words_least):
            last += 1
            held += sizes[last]
        if last - first + 1 < least or held < words_least:
            break
        found.append((first, last))
        held -= sizes[first]
    if not found and any(sizes):
        found = [(0, len(cut) - 1)]
    out = []
    for first, last in found:
        digest = xxhash.xxh3_128_intdigest(b"\n".join(joined[first : last + 1]))
        out.append((first, last, _signed(digest >> 64), _signed(digest & (1 << 64) - 1)))
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _spans_of(least: int, words_least: int):
    @F.pandas_udf(SPANS)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                [spans(text, least, words_least) for text in texts(batch)], dtype=object
            )

    return of


@F.pandas_udf(KEPT)
def _without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for batch, removed in batches:
        rows = []
        for text, runs in zip(texts(batch), removed):
            cut = sentences(text)
            gone: set[int] = set()
            for first, last in runs if runs is not None else ():
                gone.update(range(first, last + 1))
            kept = text if not gone else "".join(s for i, s in enumerate(cut) if i not in gone)
            rows.append((len(cut), kept))
        yield pd.DataFrame(rows, columns=KEPT.names)


def repeated_spans(
    docs: DataFrame,
    key: Column,
    text: str = "text",
    least: int = SENTENCES,
    words_least: int = WORDS,
) -> DataFrame:
    """Spans that are not the first of their kind: _key, _text_hash, _removed (runs of sentences).

    Spans are alike if their words are. The first one is that with the smallest key (NULL
    first), then text hash, then sentence. Every span goes to the shuffle as a few numbers;
    first ones are found map-side, and adaptive execution splits a span that is everywhere.
    """
    found = docs.select(
        key.alias("_key"),
        F.xxhash64(F.col(text)).alias("_text_hash"),
        F.explode(_spans_of(least, words_least)(F.col(text))).alias("_span"),
    ).select("_key", "_text_hash", "_span.*")
    return later_spans(found)


def later_spans(found: DataFrame) -> DataFrame:
    """The spans (_key, _text_hash, first, last, high, low) that are not the first of their kind."""
    place = F.struct("_key", "_text_hash", "first")
    firsts = found.groupBy("high", "low").agg(
        F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    # Stored, so that the join deals both sides anew; adaptive execution splits only such joins.
    firsts = kept(firsts.where("_n > 1").drop("_n"), "spans")
    later = found.join(firsts, ["high", "low"]).where(~place.eqNullSafe(F.col("_first")))
    return later.groupBy("_key", "_text_hash").agg(
        F.collect_set(F.array("first", "last")).alias("_removed")
    )


def without_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    out: str = "deduplicated",
    least: int = SENTENCES,
    words_least: int = WORDS,
) -> DataFrame:
    """``docs`` with ``out``: struct of n_sentences, removed (runs [first, last] of sentences) and
    kept (the text without them).

    Removed is every sentence that a non-first repeated span covers; a span may repeat within
    one text. Rows alike in ``key`` and text are one document: each is cut the same way, and
    none counts as a repeat of the other. A NULL text stays NULL, a text without words is kept.
    Other columns stay; one named ``out`` is replaced. Whole texts, no cap on repeats.
    """
    removed = repeated_spans(docs, F.col(f"`{key}`"), text, least, words_least)
    return cut_out(docs, removed, _without, key, text, out)


def cut_out(
    docs: DataFrame,
    removed: DataFrame,
    without: Callable[[Column, Column], Column],
    key: str,
    text: str,
    out: str,
) -> DataFrame:
    """``docs`` with ``out``: what ``without`` makes of each text and its ``removed`` spans."""
    key_name, hash_name, gone = (free_name(docs, n) for n in ("_key", "_text_hash", "_removed"))
    removed = removed.select(
        F.col("_key").alias(key_name),
        F.col("_text_hash").alias(hash_name),
        F.col("_removed").alias(gone),
    )
    rows = docs.alias("docs").join(
        removed,
        F.col(f"docs.`{key}`").eqNullSafe(F.col(key_name))
        & (F.xxhash64(F.col(f"docs.`{text}`")) == F.col(hash_name)),
        "left",
    )
    made = without(F.col(f"docs.`{text}`"), F.col(gone))
    names = [name for name in docs.columns if name.lower() != out.lower()]
    made_name = free_name(docs, "_made")
    rows = rows.select(*[F.col(f"docs.`{name}`") for name in names], gone, made.alias(made_name))
    empty = F.array().cast("array<array<int>>")
    return rows.select(
        *[F.col(f"`{name}`") for name in names],
        F.struct(
            F.col(f"{made_name}.n_sentences").alias("n_sentences"),
            F.sort_array(F.coalesce(F.col(gone), empty)).alias("removed"),
            F.col(f"{made_name}.kept").alias("kept"),
        ).alias(out),
    )
