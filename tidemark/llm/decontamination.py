"""Benchmark decontamination with a generalised suffix automaton of the items' words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.common import free_name, kept, numbered, texts

# Fixed by the data contract: a word is a run of anything but these ASCII characters.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13

# Items are cut into overlapping pieces of this many words and dealt to blocks of about so
# many; one automaton holds one block. It takes about 400 bytes a word.
PIECE_WORDS = 2_048
BLOCK_WORDS = 200_000

_word = re.compile(WORD)
_lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})

MATCHED = StructType(
    [
        StructField("n_words", LongType()),
        StructField("spans", ArrayType(ArrayType(IntegerType()))),
        StructField("items", ArrayType(StringType())),
    ]
)


def words(text: str | None) -> list[str]:
    return [] if text is None else _word.findall(text.translate(_lower))


@dataclass
class SuffixAutomaton:
    """Automaton of all substrings of some word sequences.

    ``moves[state * base + word]`` is the next state, ``link`` the state of the longest suffix
    in another state, ``longest`` the length of a state's longest substring. ``window`` is the
    ancestor that holds the window-long suffix (-1: none), ``items`` the items in which the
    window, or whole short item, of a state occurs, ``short`` the ancestor-or-self states that
    are whole short items.
    """

    ids: dict[str, int]
    base: int
    moves: dict[int, int]
    link: list[int]
    longest: list[int]
    window: list[int]
    items: dict[int, list[str]]
    short: list[tuple[int, ...]]
    short_items: dict[int, list[str]]


def built(pieces: list[tuple[str, list[str], bool]], window: int = WINDOW) -> SuffixAutomaton:
    """The automaton of ``pieces``: (item, words, whole item shorter than a window)."""
    ids: dict[str, int] = {}
    for _, piece, _ in pieces:
        for word in piece:
            ids.setdefault(word, len(ids))
    base = max(1, len(ids))
    moves: dict[int, int] = {}
    outgoing: list[list[int]] = [[]]
    link, longest = [-1], [0]

    def state(length: int, suffix: int, words_out: list[int]) -> int:
        longest.append(length)
        link.append(suffix)
        outgoing.append(words_out)
        return len(link) - 1

    def split(p: int, q: int, c: int) -> int:
        copy = state(longest[p] + 1, link[q], list(outgoing[q]))
        for w in outgoing[q]:
            moves[copy * base + w] = moves[q * base + w]
        link[q] = copy
        while p >= 0 and moves.get(p * base + c) == q:
            moves[p * base + c] = copy
            p = link[p]
        return copy

    def extended(last: int, c: int) -> int:
        q = moves.get(last * base + c)
        if q is not None:
            return q if longest[q] == longest[last] + 1 else split(last, q, c)
        new = state(longest[last] + 1, 0, [])
        p = last
        while p >= 0 and (p * base + c) not in moves:
            moves[p * base + c] = new
            outgoing[p].append(c)
            p = link[p]
        if p >= 0:
            q = moves[p * base + c]
            link[new] = q if longest[q] == longest[p] + 1 else split(p, q, c)
        return new

    for _, piece, _ in pieces:
        last = 0
        for word in piece:
            last = extended(last, ids[word])

    order = sorted(range(len(link)), key=longest.__getitem__)
    anchor = [-1] * len(link)
    for s in order[1:]:
        above = link[s]
        if longest[above] >= window:
            anchor[s] = anchor[above]
        elif longest[s] >= window:
            anchor[s] = s

    found: dict[int, set[str]] = {}
    whole: dict[int, set[str]] = {}
    for item, piece, is_short in pieces:
        s = 0
        for i, word in enumerate(piece):
            s = moves[s * base + ids[word]]
            if i + 1 >= window:
                found.setdefault(anchor[s], set()).add(item)
        if is_short and piece:
            # The state whose longest substring may be longer than the item: climb to its own.
            while longest[link[s]] >= len(piece):
                s = link[s]
            whole.setdefault(s, set()).add(item)
    lengths: dict[int, int] = {}
    for _, piece, is_short in pieces:
        if is_short and piece:
            s = 0
            for word in piece:
                s = moves[s * base + ids[word]]
            while longest[link[s]] >= len(piece):
                s = link[s]
            lengths[s] = len(piece)
    short: list[tuple[int, ...]] = [()] * len(link)
    for s in order[1:]:
        own = (s, lengths[s]) if s in lengths else ()
        short[s] = own + short[link[s]]
    return SuffixAutomaton(
        ids,
        base,
        moves,
        link,
        longest,
        anchor,
        {s: sorted(names) for s, names in found.items()},
        short,
        {s: sorted(names) for s, names in whole.items()},
    )


def matched(
    found_words: list[str], automaton: SuffixAutomaton, window: int = WINDOW
) -> tuple[list[tuple[int, int]], set[str]]:
    """Spans of words covered by windows, in order, and the items whose windows occur."""
    moves, base, link, longest = automaton.moves, automaton.base, automaton.link, automaton.longest
    short, anchor, get = automaton.short, automaton.window, automaton.ids.get
    spans: list[tuple[int, int]] = []
    windows: set[int] = set()
    wholes: set[int] = set()
    state = length = 0
    step = moves.get
    for at, word in enumerate(found_words):
        c = get(word)
        if c is None:
            state = length = 0
            continue
        to = step(state * base + c)
        if to is None:
            while state and to is None:
                state = link[state]
                to = step(state * base + c)
            # Every word of an item leads on from the start.
            length = longest[state]
        state = to
        length += 1
        reach = 0
        if length >= window:
            windows.add(anchor[state])
            reach = window
        if own := short[state]:
            for i in range(0, len(own), 2):
                if own[i + 1] <= length:
                    wholes.add(own[i])
                    reach = max(reach, own[i + 1])
        if reach:
            start = at + 1 - reach
            # A longer reach may swallow earlier spans.
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, at + 1))
    items = {item for s in windows for item in automaton.items[s]}
    items.update(item for s in wholes for item in automaton.short_items[s])
    return spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


@F.pandas_udf(ArrayType(StringType()))
def _words(batch: pd.Series) -> pd.Series:
    return pd.Series([words(text) for text in texts(batch)], dtype=object)


def _pieces(items: DataFrame, item: str, text: str, window: int, piece: int) -> DataFrame:
    """Overlapping pieces of items: _item, _piece (words), _short. Every window of an item lies
    in one of them; an item without words gives none."""
    all_words = items.select(F.col(item).cast("string").alias("_item"), _words(text).alias("_all"))
    size = F.size("_all")
    starts = F.sequence(F.lit(0), F.greatest(size - window, F.lit(0)), F.lit(piece - window + 1))
    cut = all_words.where(size > 0).withColumn("_start", F.explode(starts))
    return cut.select(
        F.coalesce("_item", F.lit("")).alias("_item"),
        F.slice("_all", F.col("_start") + 1, piece).alias("_piece"),
        (F.size("_all") < window).alias("_short"),
    )


def _matcher(automaton: Broadcast, window: int):
    @F.pandas_udf(MATCHED)
    def match(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        own = automaton.value
        for batch, earlier_spans, earlier_items in batches:
            rows = []
            for text, old_spans, old_items in zip(texts(batch), earlier_spans, earlier_items):
                found_words = words(text)
                spans, items = matched(found_words, own, window)
                if old_spans is not None:
                    spans = merged(spans + [tuple(s) for s in old_spans])
                    items.update(old_items)
                rows.append((len(found_words), spans, sorted(items)))
            yield pd.DataFrame(rows, columns=MATCHED.names)

    return match


def with_contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    out: str = "contamination",
    window: int = WINDOW,
    piece_words: int = PIECE_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with ``out``: struct of n_words, spans ([start, end) in words, in order, apart)
    and items (ids, sorted as strings).

    Words are normalised, a window is ``window`` consecutive words of an item, a shorter item
    is one window, an item without words none. Spans cover every word inside an occurrence of
    any window. NULL texts have no words. Rows keep their other columns; one named ``out`` is
    replaced. Repeated rows and ids are marked each by itself; an item id that comes twice
    counts once; a NULL item id counts as the empty string. Without items nothing is marked.

    The items' words are cut into pieces of at most ``piece_words`` that share ``window`` - 1
    words, and dealt by hash to blocks of about ``block_words``. Only one block at a time
    reaches the driver and, as an automaton, the tasks; documents are streamed past it without
    a shuffle. With more than one block the documents are stored once, with a number; of a block
    only the spans of the documents that it hits are stored, and joined by number to the last
    pass. So memory is that of one block and texts are stored once, however many items there are.
    """
    spark = docs.sparkSession
    pieces = kept(_pieces(items, item, item_text, window, piece_words), "pieces")
    total = pieces.agg(F.coalesce(F.sum(F.size("_piece")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("_item", "_piece"), F.lit(blocks))

    def match(k: int, spans: F.Column, ids: F.Column) -> F.Column:
        own = pieces.where(block == k).select("_item", "_piece", "_short").collect()
        automaton = built([(row[0], list(row[1]), row[2]) for row in own], window)
        return _matcher(spark.sparkContext.broadcast(automaton), window)(F.col(f"`{text}`"), spans, ids)

    none = F.lit(None).cast(MATCHED)
    rows, row, earlier = docs, None, None
    if blocks > 1:
        rows, row = numbered(docs)
    for k in range(1, blocks):
        hits = rows.select(row, match(k, none["spans"], none["items"]).alias("_hit"))
        hits = kept(hits.where(F.size("_hit.spans") > 0), "hits")
        earlier = hits if earlier is None else earlier.unionByName(hits)
    if earlier is None:
        spans, ids = none["spans"], none["items"]
    else:
        # A document has at most one row of each block.
        spans, ids = (free_name(rows, name) for name in ("_spans", "_items"))
        earlier = earlier.groupBy(row).agg(
            F.flatten(F.collect_list("_hit.spans")).alias(spans),
            F.flatten(F.collect_list("_hit.items")).alias(ids),
        )
        rows = rows.join(earlier, row, "left")
        spans, ids = F.col(spans), F.col(ids)
    names = [F.col(f"`{name}`") for name in docs.columns if name != out]
    return rows.select(*names, match(0, spans, ids).alias(out))


def hit_words(contamination: str) -> F.Column:
    """How many words the spans of a `with_contamination` struct cover."""
    return F.aggregate(
        F.col(f"{contamination}.spans"),
        F.lit(0).cast("long"),
        lambda total, span: total + (span[1] - span[0]).cast("long"),
    )


def is_contaminated(contamination: str, share: float = 0.05) -> F.Column:
    """Whether any word is hit and the hit words reach ``share`` of all words."""
    hit = hit_words(contamination)
    return (hit > 0) & (hit * round(1 / share) >= F.col(f"{contamination}.n_words"))
