"""Near-dedup by SetSketch against all pairs of full sets in plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, setsketch, tokens

ROWS = "doc_id long, text string, high int, n string, near int"


def full_set(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = [word for word in re.split(r"[\x20\x09-\x0D]+", lowered) if word]
    return {tuple(words[i : i + 2]) for i in range(max(1, len(words) - 1))} if words else set()


def brute_force(rows):
    """Sorted (doc_id, n_shingles, component_id) over all pairs."""
    sets = [full_set(row[1]) for row in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        least.setdefault(find(i), []).append(row[0])
    ids = {k: min((v for v in found if v is not None), default=None) for k, found in least.items()}
    return sorted(
        ((row[0], len(sets[i]), ids[find(i)]) for i, row in enumerate(rows)), key=str
    )


def near_copies(rng, count):
    """Texts about a template, some of them linked only over others."""
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    for _ in range(count):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 8, 12])):
            words[rng.randrange(len(words))] = f"x{rng.randint(0, 10**6)}"
        yield " ".join(words)


def test_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "one", "One", "two", "one two", "ONE\x0btwo", "one two"]
    texts += ["é ü", "É ü", "a b a b a b", "b a b a", "word " * 30000, "word " * 5]
    for _ in range(6):
        texts += near_copies(rng, 60)
    texts += [" ".join(f"u{rng.randint(0, 10**6)}" for _ in range(80)) for _ in range(60)]
    rows = [(i * 3 % 1009, text, i, "n", i) for i, text in enumerate(texts)]
    rows += rows[:20] + [(None, "one", 0, "n", 0), (None, "nothing like it", 0, None, None)]
    docs = spark.createDataFrame(rows, ROWS).repartition(5)
    grouped = setsketch.with_near_group(docs)
    assert grouped.columns == ["doc_id", "high", "n", "near"]
    found = [(r["doc_id"], r["near"]["n"], r["near"]["group"]) for r in grouped.collect()]
    assert sorted(found, key=str) == brute_force(rows)


def test_the_registered_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = list(enumerate([*near_copies(rng, 80), None, "", "solo", "solo"], start=10))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_setsketch(spark, str(tmp_path)).collect()
    assert sorted((tuple(r)[:3] for r in found), key=str) == brute_force(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_empty_table(spark):
    docs = spark.createDataFrame([], ROWS)
    assert setsketch.with_near_group(docs).count() == 0


def test_a_bucket_of_unlinked_sets_goes_on_until_all_leaders_are_done(spark, monkeypatch):
    """Texts that agree in bands but are not linked: links among the last ones are found too."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(4):
        words = [w if rng.random() < 0.85 else f"y{k}-{i}" for i, w in enumerate(base)]
        texts += [" ".join(words), " ".join(words[:-3])]
    rows = list(enumerate(texts))
    monkeypatch.setattr(setsketch, "LEADERS", 1)
    monkeypatch.setattr(setsketch, "WIDER", 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    grouped = setsketch.with_near_group(docs).collect()
    found = sorted(((r["doc_id"], r["near"]["n"], r["near"]["group"]) for r in grouped), key=str)
    assert found == brute_force(rows)


def test_near_copies_with_words_of_their_own_do_not_meet_pair_by_pair(spark, monkeypatch):
    """They agree in bands; what each has alone tells all apart after the first round."""
    rng = random.Random(4)
    texts = []
    for k in range(60):
        words = [f"w{i}" for i in range(150)]
        for place in rng.sample(range(2, 148, 2), 9):
            words[place] = f"own{k}-{place}"
        texts.append(" ".join(words))
    texts.append(texts[7] + " end")
    rows = list(enumerate(texts))
    monkeypatch.setattr(setsketch, "LEADERS", 1)
    pairs, kept = [], setsketch.kept

    def counted(df, purpose):
        out = kept(df, purpose)
        if purpose == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(setsketch, "kept", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    grouped = setsketch.with_near_group(docs).collect()
    found = sorted(((r["doc_id"], r["near"]["n"], r["near"]["group"]) for r in grouped), key=str)
    assert found == brute_force(rows)
    assert sum(pairs[1:]) <= 1


def test_near_copies_a_little_too_far_from_each_other_do_not_meet_pair_by_pair(spark, monkeypatch):
    """No set has enough words of its own to be told from all others by them alone."""
    rng = random.Random(6)
    texts = []
    for k in range(80):
        words = [f"w{i}" for i in range(150)]
        for place in rng.sample(range(2, 148, 2), 8):
            words[place] = f"own{k}-{place}"
        texts.append(" ".join(words))
    texts.append(texts[7] + " end")
    rows = list(enumerate(texts))
    monkeypatch.setattr(setsketch, "LEADERS", 1)
    pairs, kept = [], setsketch.kept

    def counted(df, purpose):
        out = kept(df, purpose)
        if purpose == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(setsketch, "kept", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    grouped = setsketch.with_near_group(docs).collect()
    found = sorted(((r["doc_id"], r["near"]["n"], r["near"]["group"]) for r in grouped), key=str)
    assert found == brute_force(rows)
    assert sum(pairs[1:]) <= 2 * len(rows)


def test_registers_merge_and_agree_as_the_likelihood_says():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 1 << 64, 700, dtype=np.uint64) for _ in range(2))
    both = np.unique(np.concatenate([a, b]))
    merged = np.maximum(setsketch.registers(a), setsketch.registers(b))
    assert (merged == setsketch.registers(both)).all()
    for shared, expected in ((900, True), (600, False)):
        many = rng.integers(0, 1 << 64, (300, 2 * 1000 - shared), dtype=np.uint64)
        sides = [
            np.stack([setsketch.registers(row[part]) for row in many])
            for part in (slice(0, 1000), slice(1000 - shared, None))
        ]
        size = np.full(300, 1000.0)
        alike = setsketch.plausible(*sides, size, size, 80)
        similarity = shared / (2000 - shared)
        agree = (sides[0] == sides[1]).mean()
        u = (1 - similarity) / 2
        p = 1 + 2 * np.log1p(-u * (setsketch.BASE - 1) / setsketch.BASE) / np.log(setsketch.BASE)
        assert abs(agree - p) < 0.01
        if expected:
            assert alike.all()
        else:
            assert not alike.any()


@pytest.mark.parametrize("space", [setsketch.SPACE, b" \t\n.,"])
def test_word_hashes_are_those_of_the_words(space, monkeypatch):
    rng = random.Random(2)
    values = ["".join(rng.choices("ab A\t.é\n", k=rng.randint(0, 60))).encode() for _ in range(200)]
    monkeypatch.setattr(tokens, "SLICE", 100)
    seen, total = {}, 0
    for begin, part in tokens.slices(values):
        cut = tokens.words_of(part, space)
        for s, e, own, hashed in zip(cut.starts, cut.ends, cut.texts, cut.hashes):
            word = cut.data[s:e].tobytes()
            assert word == values[begin + own][s - cut.firsts[own] : e - cut.firsts[own]].lower()
            assert seen.setdefault(word, hashed) == hashed
            total += 1
    pattern = b"[^" + re.escape(space) + b"]+"
    assert total == sum(len(re.findall(pattern, value)) for value in values)
    assert len(set(seen.values())) == len(seen) > 20
