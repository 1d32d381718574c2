"""Phrase collocation mining: phrases counted in burstable tries, level by level."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept
from tidemark.llm.tokens import Words, mixed, runs, slices, words_of
from tidemark.storage import new_folder, remove_folder

# Pieces of a text end at these bytes; words in a piece lie between spaces and tabs.
MARKS = b".,;:!?\n\x0b\x0c\r"
SPACE = b" \t" + MARKS
LONGEST = 5
LEAST = 100
BEST = 2000
NO_LANGUAGE = "und"
# A container with more phrases bursts into two. Phrases that the tries of a task hold before their
# largest subtrees are spilled.
BURST = 1 << 16
HELD = 1_500_000
# Bits of the filter of frequent phrases, in slices that are made side by side.
FILTER_BITS = 26
SLICE_BITS = 16

RUN = "lang string, phrase string, n long"


class Vocabulary:
    """Numbers of the words that a task has met, told apart by their 64-bit hashes."""

    def __init__(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.ids = np.zeros(0, dtype=np.int32)
        self.words: list[bytes] = []

    def numbers(self, cut: Words) -> np.ndarray:
        found, first, inverse = np.unique(cut.hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, found)
        known = np.zeros(len(found), dtype=bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == found[inside]
        new = first[~known]
        ids = np.arange(len(self.words), len(self.words) + len(new), dtype=np.int32)
        data, starts, ends = cut.data.tobytes(), cut.starts[new].tolist(), cut.ends[new].tolist()
        self.words += [data[s:e] for s, e in zip(starts, ends)]
        self.hashes = np.insert(self.hashes, place[~known], found[~known])
        self.ids = np.insert(self.ids, place[~known], ids)
        return self.ids[np.searchsorted(self.hashes, found)][inverse]


class Container:
    """Phrases of one range of prefixes: word numbers and counts by the hash of the phrase."""

    __slots__ = ("hashes", "words", "counts", "added", "waiting")

    def __init__(self, hashes: np.ndarray, words: np.ndarray, counts: np.ndarray) -> None:
        self.hashes, self.words, self.counts = hashes, words, counts
        self.added: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, hashes: np.ndarray, words: np.ndarray, counts: np.ndarray) -> None:
        self.added.append((hashes, words, counts))
        self.waiting += len(hashes)

    def merge(self) -> None:
        if self.waiting:
            parts = [(self.hashes, self.words, self.counts), *self.added]
            self.hashes, self.words, self.counts = summed(*map(np.concatenate, zip(*parts)))
            self.added, self.waiting = [], 0


def summed(hashes: np.ndarray, words: np.ndarray, counts: np.ndarray) -> tuple:
    """Each phrase once, with its count. Phrases of one hash are told apart by their words."""
    order = np.argsort(hashes, kind="stable")
    same = np.diff(hashes[order]) == 0
    if np.any(same & (words[order[1:]] != words[order[:-1]]).any(axis=1)):
        order = np.lexsort((*words.T, hashes))
        same = np.diff(hashes[order]) == 0
    hashes, words, counts = hashes[order], words[order], counts[order]
    same &= (words[1:] == words[:-1]).all(axis=1)
    heads = np.flatnonzero(np.append(True, ~same)[: len(hashes)])
    if not len(heads):
        return hashes, words, counts
    return hashes[heads], words[heads], np.add.reduceat(counts, heads)


class PhraseTrie:
    """Counts of phrases of ``words`` words, given by their numbers.

    The trie is shallow: it goes over the first two words of a phrase and is kept as the sorted
    starts of its ranges of prefixes. Below each is a container that maps the phrases of the range
    to their counts by hash. A container that grows beyond ``burst`` bursts into two at its middle
    prefix, down to a single one. The largest containers can be taken out as runs.
    """

    def __init__(self, words: int, burst: int = BURST) -> None:
        self.words, self.burst = words, burst
        self.starts = np.zeros(1, dtype=np.uint64)
        self.containers = [self._empty()]
        self.size = 0

    def _empty(self) -> Container:
        words = np.zeros((0, self.words), dtype=np.int32)
        return Container(np.zeros(0, np.uint64), words, np.zeros(0, np.int64))

    def _prefix(self, words: np.ndarray) -> np.ndarray:
        first = words[:, 0].astype(np.uint64) << np.uint64(32)
        return first | words[:, 1].astype(np.uint64) if self.words > 1 else first

    def add(self, hashes: np.ndarray, words: np.ndarray, counts: np.ndarray) -> None:
        prefix = self._prefix(words)
        order = np.argsort(prefix, kind="stable")
        ends = np.searchsorted(prefix[order], self.starts[1:])
        places = np.split(order, ends)
        for k in range(len(self.containers) - 1, -1, -1):
            at, own = places[k], self.containers[k]
            if not len(at):
                continue
            before = len(own.hashes) + own.waiting
            own.add(hashes[at], words[at], counts[at])
            if own.waiting > max(len(own.hashes), self.burst // 8):
                own.merge()
                if len(own.hashes) > self.burst:
                    self._burst(k)
            self.size += sum(len(c.hashes) + c.waiting for c in self._of(own, k)) - before

    def _of(self, own: Container, k: int) -> list[Container]:
        """``own`` at place ``k``, or the two that it has burst into."""
        return [own] if self.containers[k] is own else self.containers[k : k + 2]

    def _burst(self, k: int) -> None:
        own = self.containers[k]
        prefix = self._prefix(own.words)
        middle = np.partition(prefix, len(prefix) // 2)[len(prefix) // 2]
        if middle == prefix.min():
            above = prefix[prefix > middle]
            if not len(above):
                return
            middle = above.min()
        parts = [
            Container(own.hashes[at], own.words[at], own.counts[at])
            for at in (prefix < middle, prefix >= middle)
        ]
        self.containers[k : k + 1] = parts
        self.starts = np.insert(self.starts, k + 1, middle)

    def merge(self) -> None:
        for own in self.containers:
            own.merge()
        self.size = sum(len(own.hashes) for own in self.containers)

    def spilled(self, least: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out the largest subtrees until no more than ``least`` phrases are left: the words
        and counts of each."""
        self.merge()
        sizes = [len(own.hashes) for own in self.containers]
        for k in np.argsort(sizes)[::-1]:
            if self.size <= least:
                break
            own, self.containers[k] = self.containers[k], self._empty()
            self.size -= len(own.hashes)
            yield own.words, own.counts


def _bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a phrase in the filter."""
    places = mixed(keys)
    shift = np.uint64(64 - FILTER_BITS)
    return (places >> shift).astype(np.int64), (mixed(places) >> shift).astype(np.int64)


def _language_keys(langs: list[str]) -> np.ndarray:
    names = [name.encode("utf-8", "surrogatepass") + b"\n" for name in langs]
    cut = words_of(names, b"\n", seed=5) if names else None
    out = np.zeros(len(names), dtype=np.uint64)
    for text, hashed in zip(cut.texts, cut.hashes) if cut else ():
        out[text] = mixed(out[text : text + 1] + hashed)[0]
    return out


def phrase_counts(
    langs: list[str],
    values: list[bytes],
    count: int,
    frequent: np.ndarray | None,
    vocabulary: Vocabulary,
) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """(language, hashes, words, counts) of the phrases of ``count`` words in some texts, of each
    slice of texts on its own. A phrase whose first or last ``count`` - 1 words are not in the
    filter ``frequent`` is left out."""
    names = sorted(set(langs))
    keys = _language_keys(names)
    number = {name: k for k, name in enumerate(names)}
    marks = np.zeros(256, dtype=bool)
    marks[list(MARKS)] = True
    for begin, part in slices(values):
        cut = words_of(part, SPACE)
        most = len(cut.starts) - count + 1
        if most <= 0:
            continue
        lang = np.array([number[name] for name in langs[begin : begin + len(part)]])[cut.texts]
        # Words of one piece have no mark between them, and texts are joined by a mark.
        piece = np.cumsum(marks[np.frombuffer(b"\n".join(part), np.uint8)])[cut.starts]
        whole = piece[:most] == piece[count - 1 :]
        if frequent is not None:
            a, b = _bits(runs(cut.hashes, count - 1, keys[lang]))
            known = _set_at(frequent, a) & _set_at(frequent, b)
            whole &= known[:most] & known[1 : most + 1]
        at = np.flatnonzero(whole)
        if not len(at):
            continue
        hashes = runs(cut.hashes, count)[at]
        ids = vocabulary.numbers(cut)
        words = np.stack([ids[at + i] for i in range(count)], axis=1)
        for k in np.unique(lang[at]):
            own = lang[at] == k
            ones = np.ones(int(own.sum()), dtype=np.int64)
            yield names[k], *summed(hashes[own], words[own], ones)


def _set_at(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 > 0


def _counter(count: int, held: int, shared: Broadcast | None):
    def count_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = None if shared is None else np.frombuffer(shared.value, np.uint8)
        vocabulary = Vocabulary()
        tries: dict[str, PhraseTrie] = {}

        def run(lang: str, least: int) -> Iterator[pa.RecordBatch]:
            known = pa.array(vocabulary.words, pa.large_binary())
            for words, counts in tries[lang].spilled(least):
                for start in range(0, len(words), BURST):
                    part = slice(start, start + BURST)
                    columns = [known.take(pa.array(column)) for column in words[part].T]
                    phrases = pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary()))
                    order = pc.sort_indices(phrases)
                    rows = [
                        pa.repeat(pa.scalar(lang, pa.string()), len(phrases)),
                        phrases.take(order).cast(pa.large_string()).cast(pa.string()),
                        pa.array(counts[part], pa.int64()).take(order),
                    ]
                    yield pa.RecordBatch.from_arrays(rows, names=["lang", "phrase", "n"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            values = [v or b"" for v in batch.column(1).cast(pa.binary()).to_pylist()]
            for lang, *found in phrase_counts(langs, values, count, frequent, vocabulary):
                tries.setdefault(lang, PhraseTrie(count)).add(*found)
                if sum(own.size for own in tries.values()) > held:
                    for own in tries.values():
                        own.merge()
                    while sum(own.size for own in tries.values()) > held // 2:
                        largest = max(tries, key=lambda name: tries[name].size)
                        yield from run(largest, tries[largest].size // 2)
        for lang in tries:
            yield from run(lang, 0)

    return count_phrases


def _filter_of(frequent: DataFrame, count: int) -> bytes:
    """A filter of 2**FILTER_BITS bits that knows every phrase of ``frequent``, made in slices;
    its size is fixed, however many phrases there are."""

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs = batch["lang"].tolist()
            names = sorted(set(langs))
            keys = _language_keys(names)
            number = {name: k for k, name in enumerate(names)}
            values = [phrase.encode("utf-8", "surrogatepass") for phrase in batch["phrase"]]
            cut = words_of(values, b" \n")
            # All of ``count`` words, so every count-th run is a phrase.
            hashed = runs(cut.hashes, count, keys[[number[langs[t]] for t in cut.texts]])[::count]
            both = np.concatenate(_bits(hashed))
            yield pd.DataFrame({"slot": both >> SLICE_BITS, "bit": both & (1 << SLICE_BITS) - 1})

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << SLICE_BITS, dtype=bool)
        bits[group["bit"].to_numpy()] = True
        row = {"slot": group["slot"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]}
        return pd.DataFrame(row)

    rows = frequent.mapInPandas(places, "slot long, bit long").distinct()
    out = bytearray(1 << (FILTER_BITS - 3))
    width = 1 << (SLICE_BITS - 3)
    for row in rows.groupBy("slot").applyInPandas(packed, "slot long, bits binary").collect():
        out[row["slot"] * width : (row["slot"] + 1) * width] = row["bits"]
    return bytes(out)


def frequent_phrases(
    docs: DataFrame,
    text: Column,
    lang: Column,
    longest: int = LONGEST,
    least: int = LEAST,
    held: int = HELD,
) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``longest`` words with at least ``least`` occurrences in a language (lang,
    words, phrase, n), and the number of words of every language (lang, total); both stored.

    A level for each length. A phrase can only be frequent if the shorter ones at its two ends are,
    which a filter of fixed size tells (it may take an infrequent one for frequent, never the
    reverse). A task counts in a trie and spills subtrees as sorted runs; the runs are stored,
    dealt out by ranges of phrases, so a prefix with most of the phrases is several ranges, and
    merged there.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(lang.cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    found = totals = shared = None
    for count in range(1, longest + 1):
        folder = new_folder(spark, "llm-phrase-runs")
        counted = rows.mapInArrow(_counter(count, held, shared), RUN)
        counted.write.option("compression", "zstd").parquet(folder)
        counted = spark.read.schema(RUN).parquet(folder)
        if count == 1:
            totals = kept(counted.groupBy("lang").agg(F.sum("n").alias("total")), "phrase-totals")
        merged = counted.repartitionByRange("lang", "phrase")
        merged = merged.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        merged = merged.where(F.col("n") >= least)
        level = kept(merged.select("lang", F.lit(count).alias("words"), "phrase", "n"), "phrases")
        # The runs are merged and stored.
        remove_folder(spark, folder)
        found = level if found is None else found.unionByName(level)
        if count < longest:
            shared = spark.sparkContext.broadcast(_filter_of(level, count))
    return found, totals


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    best: int = BEST,
    held: int = HELD,
) -> DataFrame:
    """The ``best`` collocations of every language: lang, rank, phrase, a, l, r, n, score.

    Words are runs without space or tab within a piece; pieces end at ``. , ; : ! ?`` and line
    ends; A-Z are lowered. A phrase of 2 to ``longest`` words with at least ``least`` occurrences a
    is a candidate. Cut after its first words into parts with l and r occurrences it scores
    floor(1000 * a * n / (l * r)), n being the words of its language; the lowest score of all cuts
    counts, the first such cut. A candidate inside a longer one that occurs as often is dropped.
    Ranks go by score, then a, both descending, then phrase in byte order.

    A NULL language is ``und``, NULL and empty texts have no words, rows alike count each, an empty
    table or one without candidates gives no rows. Other columns are ignored. Exact: decimals of 38
    digits hold the products.
    """
    frequent, totals = frequent_phrases(
        docs, F.col(f"`{text}`"), F.col(f"`{lang}`"), longest, least, held
    )
    words = F.split("phrase", " ")
    candidates = frequent.where("words > 1").withColumnRenamed("n", "a")

    def part(first: Column, size: Column) -> Column:
        return F.array_join(F.slice(F.col("_words"), first, size), " ")

    listed = candidates.withColumn("_words", words)
    cuts = listed.withColumn("_cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns(
        {
            "_left": part(F.lit(1), F.col("_cut")),
            "_right": part(F.col("_cut") + 1, F.col("words") - F.col("_cut")),
        }
    ).drop("_words")
    for side, out in (("_left", "l"), ("_right", "r")):
        counts = frequent.select("lang", F.col("phrase").alias(side), F.col("n").alias(out))
        cuts = cuts.join(counts, ["lang", side])
    cuts = cuts.join(totals.withColumnRenamed("total", "n"), "lang")
    exact = {name: f"cast({name} as decimal(18, 0))" for name in "alrn"}
    score = F.expr(
        f"(cast(1000 as decimal(4, 0)) * {exact['a']} * {exact['n']})"
        f" div ({exact['l']} * {exact['r']})"
    )
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct(score.alias("score"), "_cut", "l", "r")).alias("_best")
    )
    inner = listed.where("words > 2").select(
        "lang",
        F.col("a").alias("_longer"),
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(2), F.col("words") - 1),
                    lambda size: F.transform(
                        F.sequence(F.lit(1), F.col("words") - size + 1),
                        lambda first: part(first, size),
                    ),
                )
            )
        ).alias("phrase"),
    )
    inner = inner.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    free = scored.join(inner, ["lang", "phrase"], "left")
    free = free.where(F.col("_longer").isNull() | (F.col("_longer") < F.col("a")))
    order = Window.partitionBy("lang").orderBy(
        F.desc("_best.score"), F.desc("a"), F.asc("phrase")
    )
    ranked = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        F.col("_best.l").alias("l"),
        F.col("_best.r").alias("r"),
        "n",
        F.col("_best.score").alias("score"),
    )
