"""Long texts and crowded groups: bounded work, results unchanged."""

from __future__ import annotations

import time

import numpy as np
import pytest

from tidemark.llm import quality, secrets, sentences, simhash

GOOD = ("the quiet river runs past green hills and the old mill stands near its bank . ").split()
BAD = "BUY!!! NOW!!! $$$ 99 FREE!!! $$$ CLICK!!! 77".split()


def prose(rng, words, count):
    return " ".join(rng.choice(words, count))


def quality_model(rng):
    bags = [quality.sampled(prose(rng, GOOD, 200)) for _ in range(60)]
    bags += [quality.sampled(prose(rng, GOOD, 96) + " " + prose(rng, BAD, 96)) for _ in range(60)]
    return quality.trained(bags, [1] * 60 + [0] * 60, 0.5)


def test_a_bad_passage_of_a_long_text_has_its_own_weight():
    rng = np.random.default_rng(2)
    model = quality_model(rng)
    at = 123
    text = prose(rng, GOOD, at * 48) + " " + prose(rng, BAD, 48) + " "
    text += prose(rng, GOOD, 20_000 - (at + 1) * 48)
    score, attention = quality.scored([text], model)[0]
    assert len(attention) == -(-20_000 // 48)
    others = np.delete(attention, at)
    assert abs(attention[at] - others.mean()) > 10 * others.std()
    # Prose of any length is the same passages.
    scores = [quality.scored([prose(rng, GOOD, n)], model)[0][0] for n in (480, 4_800, 48_000)]
    assert max(scores) - min(scores) < 0.02 and min(scores) > 0.5


def test_streamed_weights_equal_those_of_one_softmax(monkeypatch):
    rng = np.random.default_rng(3)
    model = quality_model(rng)
    texts = [None, "", "one", prose(rng, GOOD, 48), prose(rng, BAD, 5_000), prose(rng, GOOD, 700)]
    bags = [np.concatenate(list(quality.passages(text))) for text in texts]
    sizes = np.array([len(bag) for bag in bags])
    whole = model.forward(np.concatenate(bags), np.cumsum(sizes) - sizes, sizes)
    for piece, lot in ((256, 4096), (7, 20), (1, 1)):
        monkeypatch.setattr(quality, "PIECE", piece)
        monkeypatch.setattr(quality, "LOT", lot)
        found = quality.scored(texts, model)
        assert np.allclose([score for score, _ in found], whole["y"])
        assert np.allclose(np.concatenate([weights for _, weights in found]), whole["a"], atol=1e-6)
    assert quality.scored([], model) == []


def test_a_long_text_is_sampled_evenly():
    text = " ".join(f"w{i}" for i in range(48 * 1000))
    every = np.concatenate(list(quality.passages(text)))
    some = quality.sampled(text)
    assert every.shape == (1000, quality.WIDTH) and len(some) == quality.PASSAGES
    assert (some[0] == every[0]).all() and (some[-1] == every[-1]).all()
    assert (every[:, -1] == 1).all()


def test_places_in_a_long_text_of_wide_characters():
    part = "é漢𝄞 token=abcdefghijklmnop \ud800 "
    text = part * 100_000
    begun = time.monotonic()
    found = secrets.found(text)
    assert time.monotonic() - begun < 60
    width = len(part)
    assert [s[:3] for s in found] == [
        ("assign", i * width + 4, i * width + 26) for i in range(100_000)
    ]


def test_words_are_cut_at_ascii_marks_and_spaces_only():
    text = "A\x0bÄb C d. e。F!?\n\x1cg\x85h \ud800.\n"
    expected = [s.translate({c: c + 32 for c in range(65, 91)}) for s in sentences.sentences(text)]
    got = [b" ".join(words).decode("utf-8", "surrogatepass") for words in sentences.compared(text)]
    spaced = [" ".join("".join(" " if c in " \t\n\v\f\r" else c for c in s).split(" ")) for s in expected]
    assert got == [" ".join(w for w in s.split(" ") if w) for s in spaced]
    assert sentences.compared(None) == sentences.compared("") == []


def crowded(rng, count, flips):
    """Fingerprints with one and the same upper 16 bits, many of them near copies."""
    prints = rng.integers(0, 2**48, count // 3, dtype=np.uint64)[rng.integers(0, count // 3, count)]
    for _ in range(flips):
        prints = prints ^ (np.uint64(1) << rng.integers(0, 48, count).astype(np.uint64))
    return prints | np.uint64(0xBEEF << 48)


def test_crowded_prefixes_are_cut_further(spark):
    prints = np.unique(crowded(np.random.default_rng(5), 20_000, 2))
    prints = np.append(prints, np.array([0, 1, 2**64 - 1], dtype=np.uint64))
    rows = spark.createDataFrame([(p,) for p in prints.view(np.int64).tolist()], "_print long")
    for largest in (700, 10**6):
        starts, depths = simhash._cut(rows, largest)
        assert (starts[1:] > starts[:-1]).all()
        place = np.searchsorted(starts, prints, side="right") - 1
        assert np.bincount(place).max() <= largest
        shift = (64 - depths[place]).astype(np.uint64)
        same = (prints >> np.minimum(shift, 63)) == (starts[place] >> np.minimum(shift, 63))
        assert (same | (shift == 64)).all()


def test_near_subtrees_equal_brute_force(spark):
    prints = np.unique(crowded(np.random.default_rng(6), 900, 2))
    rows = spark.createDataFrame([(p,) for p in prints.view(np.int64).tolist()], "_print long")
    starts, depths = simhash._cut(rows, 5)
    assert depths.max() > simhash.HALF // 2
    for own in range(0, len(starts), 17):
        for first, budget in ((2, 4), (1, 4), (0, 0)):
            expected = []
            for other in range(len(starts)):
                depth = int(min(depths[own], depths[other]))
                bits = int(starts[own] ^ starts[other]) >> (64 - depth)
                upper = bits >> max(0, depth - simhash.HALF)
                if bits.bit_count() <= budget and upper.bit_count() <= first:
                    expected.append(other)
            assert sorted(simhash._near(own, starts, depths, first, budget)) == expected


@pytest.mark.parametrize("subtree", [200, 5_000])
def test_crowded_groups_equal_brute_force(spark, subtree, monkeypatch):
    monkeypatch.setattr(simhash.near_links, "__defaults__", (subtree,))
    prints = crowded(np.random.default_rng(7), 3_000, 3)
    frame = spark.createDataFrame(
        [(i, p, "x", "y", "z") for i, p in enumerate(prints.view(np.int64).tolist())],
        "doc_id long, p long, _print string, _least string, _group string",
    )
    near = np.triu(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4, 1)
    labels = simhash._union(np.arange(len(prints)), *np.nonzero(near))
    found = simhash.near_groups(frame, "doc_id", "p", out="found").collect()
    assert {row.doc_id: row.found for row in found} == dict(enumerate(labels.tolist()))
    assert all((row["_print"], row["_least"], row["_group"]) == ("x", "y", "z") for row in found)
    replaced = simhash.near_groups(frame, "doc_id", "p").collect()
    assert {row.doc_id: row["_group"] for row in replaced} == dict(enumerate(labels.tolist()))


def test_fingerprints_of_odd_texts(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n", "c"), (4, "One two", None), (None, "x " * 9000, "d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _fp string")
    found = {r.doc_id: r for r in simhash.with_fingerprint(frame, "text", "p", 4).collect()}
    assert [found[k].p for k in (1, 2, 3)] == [0, 0, 0]
    for key, text in ((4, "One two"), (None, "x " * 9000)):
        assert found[key].p % (1 << 64) == simhash.fingerprint(text, 4)
    assert found[None]["_fp"] == "d"
