"""Whether texts are claimed by a learned language, at every length and for many languages."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tidemark.llm import language
from tidemark.llm.language import claimed, piece_of, predicted, presence, trained

STRANGE = [
    "Tämä lause on suomea, jota malli ei ole koskaan oppinut, joten se hylätään kokonaan.",
    "Toto je česká věta, kterou se model nikdy neučil, a proto musí být odmítnuta.",
    "def area(r): return 3.14159 * r ** 2\nfor k in range(10): print(area(k), k % 3)",
    "xkcd qwrt zzplk mnbv trrw",
    "Эта фраза написана по-русски и должна быть отклонена.",
]


def words_of(rng, letters, count):
    """An invented language: its words, the frequent ones first."""
    syllables = [a + b for a in letters[: len(letters) // 2] for b in letters[len(letters) // 2 :]]
    common = rng.sample(syllables, min(len(syllables), 12))
    return ["".join(rng.choices(common, k=rng.randint(1, 3))) for _ in range(count)]


def text_of(rng, words, length):
    weights = [1 / (k + 1) for k in range(len(words))]
    out, size = [], 0
    while size < length:
        more = rng.choices(words, weights, k=200)
        out += more
        size += sum(map(len, more)) + 200
    return " ".join(out)[:length]


@pytest.fixture(scope="module")
def learned():
    rng = random.Random(1)
    letters = {"aa": "bdeoaiu", "bb": "krstaeo", "cc": "lmnpeiou", "dd": "fghjaeiy"}
    languages = {name: words_of(rng, own, 300) for name, own in letters.items()}
    samples = []
    for name, words in languages.items():
        for _ in range(150):
            text = text_of(rng, words, rng.choice([120, 400, 1500, 6000]))
            samples.append((name, presence(text), piece_of(text)))
    return rng, languages, trained(samples)


@pytest.mark.parametrize("length", [200, 2_000, 20_000, 130_000, 2_000_000])
def test_every_length_of_a_learned_language_is_claimed(learned, length):
    rng, languages, model = learned
    count = 50 if length < 20_000 else 8 if length < 1_000_000 else 2
    kept = []
    for name, words in languages.items():
        texts = [text_of(rng, words, length) for _ in range(count)]
        found = predicted(texts, model)
        assert {lang for lang, _, _ in found} == {name}
        kept += [own for _, _, own in found]
    assert np.mean(kept) >= 0.98


def test_strange_texts_are_not_claimed(learned):
    rng, _, model = learned
    letters = "abcdefghijklmnopqrstuvwxyz    "
    strange = STRANGE + ["".join(rng.choices(letters, k=n)) for n in (60, 400, 5000, 300_000)]
    assert not any(own for _, _, own in predicted(strange, model))
    assert predicted([None, "", "12 !?"], model) == [("und", 0.0, False)] * 3


def test_a_strange_half_of_a_long_text_decides(learned):
    rng, languages, model = learned
    own = text_of(rng, languages["aa"], 30_000)
    strange = "".join(rng.choices("qwxzvkj  ", k=30_000))
    found = predicted([own + " " + strange[:9_000], own[:9_000] + " " + strange], model)
    assert [claim for _, _, claim in found] == [True, False]


def test_a_text_without_a_whole_run_of_characters_is_not_judged(learned):
    model = learned[2]
    assert claimed("a", model.usual[:, 0], model.bounds[:, 0])


def test_no_language_is_left_out(monkeypatch):
    """More languages than landmarks, if need be."""
    rng = random.Random(5)
    consonants, vowels = "bcdfghjklmnpqrstvwxz", "aeiouy"
    languages = {}
    for k in range(300):
        letters = "".join(rng.sample(consonants, 5) + rng.sample(vowels, 4))
        languages[f"l{k:03}"] = words_of(rng, letters, 60)
    samples = []
    for name, words in languages.items():
        for _ in range(4):
            text = text_of(rng, words, 600)
            samples.append((name, presence(text), piece_of(text)))
    for most in (1200, 250):
        monkeypatch.setattr(language, "ALL_LANDMARKS", most)
        model = trained(samples)
        assert len(model.languages) == 300 and model.landmarks.shape[1] <= most
        found = predicted([text_of(rng, words, 800) for words in languages.values()], model)
        right = np.mean([lang == name for (lang, _, _), name in zip(found, languages)])
        assert right > (0.97 if most > 300 else 0.9)
    one = trained([("x", presence("ab cd"), piece_of("ab cd"))])
    assert predicted(["ab cd"], one)[0][0] == "x"
    assert predicted(["ab cd"], trained([])) == [("und", 0.0, False)]
