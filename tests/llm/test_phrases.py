"""Phrase mining against counts of every phrase in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import phrases, tokens
from tidemark.llm.phrases import PhraseTrie, collocations, summed

ROWS = "lang string, text string, n string, phrase int, words int"


def brute_force(rows, longest, least, best):
    """Rows of `collocations` from counts of all phrases."""
    found, totals = Counter(), Counter()
    for lang, text in ((row[0] if row[0] is not None else "und", row[1] or "") for row in rows):
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text)
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    found[lang, tuple(words[i : i + size])] += 1
    frequent = {key: n for key, n in found.items() if len(key[1]) > 1 and n >= least}
    out = []
    for (lang, phrase), a in frequent.items():
        if any(
            own == lang and n >= a and len(other) > len(phrase)
            and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))
            for (own, other), n in frequent.items()
        ):
            continue
        cuts = []
        for k in range(1, len(phrase)):
            l, r = found[lang, phrase[:k]], found[lang, phrase[k:]]
            cuts.append((1000 * a * totals[lang] // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.append((lang, -score, -a, " ".join(phrase).encode(), l, r))
    ranked, place = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        place[lang] += 1
        if place[lang] <= best:
            row = (lang, place[lang], phrase.decode(), -a, l, r, totals[lang], -score)
            ranked.append(row)
    return ranked


def sample(rng, count):
    vocabulary = ["a", "b", "The", "the", "c", "é", "z\x0b", "漢字"]
    apart = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!"]
    for _ in range(count):
        words = rng.choices(vocabulary, [5, 5, 2, 2, 1, 1, 1, 1], k=rng.randint(0, 40))
        yield "".join(word + rng.choice(apart) for word in words)


@pytest.mark.parametrize("held, best", [(400_000, 2000), (15, 7)])
def test_equals_brute_force(spark, monkeypatch, held, best):
    """Also with spills after a few phrases and with tiny containers."""
    rng = random.Random(4)
    if held < 100:
        monkeypatch.setattr(phrases, "BURST", 8)
        monkeypatch.setattr(tokens, "SLICE", 200)
    rows = [(rng.choice(["en", "fr", None, ""]), text, "n", 1, 2) for text in sample(rng, 300)]
    rows += [("en", None, None, None, None), ("xx", "", "n", 1, 1), (None, None, None, 0, 0)]
    rows += [("de", "eins zwei drei " * 4000, "n", 1, 1)] + rows[:9]
    docs = spark.createDataFrame(rows, ROWS).repartition(4)
    found = collocations(docs, least=12, held=held, best=best)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = brute_force(rows, 5, 12, best)
    assert len(expected) > 20
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_empty_tables(spark):
    assert collocations(spark.createDataFrame([], ROWS)).count() == 0
    none = spark.createDataFrame([("en", None), (None, "")], "lang string, text string")
    assert collocations(none).count() == 0


def test_trie_bursts_spills_and_keeps_counts():
    rng = np.random.default_rng(8)
    for words in (1, 2, 3, 5):
        trie, expected, spilled = PhraseTrie(words, burst=16), Counter(), Counter()

        def take(least):
            for rows, counts in trie.spilled(least):
                for row, n in zip(rows.tolist(), counts.tolist()):
                    spilled[tuple(row)] += n

        for _ in range(60):
            rows = rng.integers(0, 6, (40, words)).astype(np.int32)
            # Hashes that meet are told apart by the words.
            hashes = (rows.sum(axis=1) % 7).astype(np.uint64)
            counts = np.full(40, 2, dtype=np.int64)
            trie.add(*summed(hashes, rows, counts))
            for row in rows.tolist():
                expected[tuple(row)] += 2
            if trie.size > 200:
                take(50)
                assert trie.size <= 50
        assert len(trie.containers) > 1 or words == 1
        assert (np.diff(trie.starts.astype(float)) > 0).all()
        take(0)
        assert spilled == expected and trie.size == 0


def test_a_full_filter_only_lets_more_through(spark, monkeypatch):
    rows = [("en", "a b c d e f. " * 20), ("en", "a c b d. " * 15)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    expected = sorted(brute_force(rows, 5, 12, 50))
    assert sorted(map(tuple, collocations(docs, least=12, best=50).collect())) == expected
    full = bytes([255]) * (1 << (phrases.FILTER_BITS - 3))
    monkeypatch.setattr(phrases, "_filter_of", lambda frequent, count: full)
    assert sorted(map(tuple, collocations(docs, least=12, best=50).collect())) == expected


def test_products_beyond_64_bits_are_exact(spark):
    row = spark.createDataFrame([(9 * 10**13, 8 * 10**13, 7 * 10**13, 10**11 - 1)], "a long, n long, l long, r long")
    exact = "(cast(1000 as decimal(4, 0)) * cast(a as decimal(18, 0)) * cast(n as decimal(18, 0)))"
    exact += " div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))"
    expected = 1000 * 9 * 10**13 * 8 * 10**13 // (7 * 10**13 * (10**11 - 1))
    assert row.select(F.expr(exact)).first()[0] == expected
