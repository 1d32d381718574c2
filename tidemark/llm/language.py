"""Language identification by a string kernel, Nystroem landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

from tidemark.llm.common import first_by_hash, free_name, texts

UNDETERMINED = "und"
# The blended spectrum: presence of every run of 1 to GRAMS characters, hashed to DIMENSIONS.
GRAMS = 3
BITS = 13
DIMENSIONS = 1 << BITS
# Bounds of the training sample. A language gives up to TEXTS texts and LANDMARKS landmarks; where
# there are so many languages that all would be more than ALL_TEXTS or ALL_LANDMARKS, each gives
# fewer, but at least LEAST_TEXTS texts. No language is left out.
TEXTS = 400
LANDMARKS = 48
ALL_TEXTS = 24_000
ALL_LANDMARKS = 4096
LEAST_TEXTS = 8
RIDGE = 1e-2
# A text is judged in pieces of the longest of these lengths (in n-grams of GRAMS characters), a
# shorter one as a whole against the bound of the longest length that it has. A piece is claimed if
# its likeness to the language is no more than MARGIN below what all but the QUANTILE least like
# pieces of the sample have; a text is if at least SHARE of its pieces are.
LENGTHS = (16, 32, 64, 128, 256)
QUANTILE = 0.01
MARGIN = 0.4
SHARE = 0.5
# Presence rows multiplied at once, and characters looked at in one piece.
ROWS = 128
PIECE = 1 << 18

PREDICTION = StructType(
    [
        StructField("lang", StringType()),
        StructField("score", DoubleType()),
        StructField("claimed", BooleanType()),
    ]
)


@dataclass
class LanguageModel:
    languages: list[str]
    landmarks: np.ndarray  # DIMENSIONS x landmarks, presence over the root of its size
    weights: np.ndarray  # landmarks x languages
    usual: np.ndarray  # DIMENSIONS x languages, log of the share of its texts that have the n-gram
    bounds: np.ndarray  # lengths x languages, the least likeness that is claimed


def _parts(text: str) -> Iterator[tuple[bool, list[np.ndarray]]]:
    """Of each of the overlapping parts of a text, so memory stays bounded: whether it has a letter,
    and the hashed n-grams of 1 to GRAMS characters in their order.

    Upper and lower case are one, and everything but letters counts as one space.
    """
    for start in range(0, len(text), PIECE):
        part = text[max(0, start - GRAMS) : start + PIECE].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letters = _letter(codes, part)
        codes = np.where(letters, codes, 32)
        codes = codes[np.append(True, (codes[1:] != 32) | (codes[:-1] != 32))].astype(np.uint64)
        rolled = np.zeros(len(codes), dtype=np.uint64)
        grams = []
        for n in range(1, GRAMS + 1):
            if len(codes) < n:
                break
            rolled = (rolled[: len(codes) - n + 1] * np.uint64(0x100000001B3)) ^ codes[n - 1 :]
            mixed = (rolled + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            grams.append((mixed >> np.uint64(64 - BITS)).astype(np.int64))
        yield bool(letters.any()), grams


def presence(text: str | None) -> np.ndarray | None:
    """Which hashed n-grams occur in a text; None if it has no letter."""
    if text is None:
        return None
    seen = np.zeros(DIMENSIONS, dtype=bool)
    any_letter = False
    for letters, grams in _parts(text):
        any_letter |= letters
        for ids in grams:
            seen[ids] = True
    return seen if any_letter else None


def piece_of(text: str) -> np.ndarray:
    """The longest n-grams of one piece of a text, from its middle."""
    length = 4 * LENGTHS[-1]
    begin = max(0, (len(text) - length) // 2)
    for _, grams in _parts(text[begin : begin + length]):
        return grams[-1][: LENGTHS[-1]] if len(grams) == GRAMS else grams[-1][:0]
    return np.zeros(0, dtype=np.int64)


def claimed(text: str, usual: np.ndarray, bounds: np.ndarray) -> bool:
    """Whether enough pieces of a text are as like a language as ``bounds`` ask; a text without a
    whole n-gram is not judged and counts as claimed."""
    longest = LENGTHS[-1]
    good = pieces = 0
    short = None
    for _, grams in _parts(text):
        values = usual[grams[-1]] if len(grams) == GRAMS else usual[:0]
        whole = len(values) // longest
        if whole:
            likeness = values[: whole * longest].reshape(whole, longest).mean(axis=1)
            good += int((likeness >= bounds[-1]).sum())
            pieces += whole
        elif not pieces and len(values):
            short = values
    if pieces:
        return good >= SHARE * pieces
    if short is None:
        return True
    place = max(0, int(np.searchsorted(LENGTHS, len(short), side="right")) - 1)
    return bool(short.mean() >= bounds[place])


_known = np.zeros(0x110000, dtype=np.int8)


def _letter(codes: np.ndarray, part: str) -> np.ndarray:
    """Which of the characters are letters; every character is looked up once."""
    kinds = _known[codes]
    if not kinds.all():
        for code in np.unique(codes[kinds == 0]):
            _known[code] = 2 if chr(code).isalpha() else 1
        kinds = _known[codes]
    return kinds == 2


def trained(
    samples: list[tuple[str, np.ndarray, np.ndarray]], landmarks: int = LANDMARKS
) -> LanguageModel:
    """One-versus-rest kernel ridge regression on Nystroem landmarks.

    ``samples`` are (language, presence, piece); the first ``landmarks`` of each language become
    landmarks, of fewer languages where all would be more than ALL_LANDMARKS. The kernel of two
    texts is the number of n-grams in both over the root of the product of their numbers. Rows of
    the kernel are added up in blocks, so what is held goes with the landmarks, not the sample.
    """
    own: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for name, seen, piece in samples:
        own.setdefault(name, []).append((seen, piece))
    languages = sorted(own)
    if not languages:
        none = np.zeros((DIMENSIONS, 0), np.float32)
        bounds = np.zeros((len(LENGTHS), 0), np.float32)
        return LanguageModel([], none, np.zeros((0, 0), np.float32), none, bounds)
    each = max(1, min(landmarks, ALL_LANDMARKS // len(languages)))
    chosen = [seen for name in languages for seen, _ in own[name][:each]]
    if len(chosen) > ALL_LANDMARKS:
        chosen = chosen[:: -(-len(chosen) // ALL_LANDMARKS)]

    def normal(rows: list[np.ndarray]) -> np.ndarray:
        stacked = np.stack(rows).astype(np.float32)
        return stacked / np.sqrt(np.maximum(stacked.sum(axis=1, keepdims=True), 1))

    columns = normal(chosen).T.copy()
    inner = (columns.T @ columns).astype(np.float64)
    left = RIDGE * inner + 1e-6 * np.eye(len(inner))
    right = np.zeros((len(inner), len(languages)))
    for k, name in enumerate(languages):
        # Every language weighs the same, however many texts it has in the sample.
        share = 1.0 / len(own[name])
        for i in range(0, len(own[name]), ROWS):
            kernel = (normal([seen for seen, _ in own[name][i : i + ROWS]]) @ columns).astype(float)
            left += kernel.T @ kernel * share
            total = kernel.sum(axis=0) * share
            right -= total[:, None]
            right[:, k] += 2 * total
    weights = np.linalg.solve(left, right)
    usual = np.zeros((DIMENSIONS, len(languages)), dtype=np.float32)
    bounds = np.zeros((len(LENGTHS), len(languages)), dtype=np.float32)
    for k, name in enumerate(languages):
        counts = np.sum([seen for seen, _ in own[name]], axis=0, dtype=np.float64)
        usual[:, k] = _logs(counts, len(own[name]))
        bounds[:, k] = _bounds(own[name], counts)
    return LanguageModel(languages, columns, weights.astype(np.float32), usual, bounds)


def _logs(counts: np.ndarray, texts: int) -> np.ndarray:
    """Logarithm of the share of texts that have an n-gram; one that none has counts as half of
    one."""
    return np.log(np.maximum(counts, 0.5) / max(texts, 1))


def _bounds(samples: list[tuple[np.ndarray, np.ndarray]], counts: np.ndarray) -> np.ndarray:
    """The least likeness of a piece of each length that a language claims, from the pieces of its
    own sample. A text's own n-grams do not count for its piece. Without a piece of a length the
    bound of the length before holds; one text alone gives none."""
    out, last = [], -np.inf
    for length in LENGTHS:
        found = [
            _logs(counts[piece[:length]] - 1, len(samples) - 1).mean()
            for _, piece in samples
            if len(piece) >= length
        ]
        if len(samples) > 1 and found:
            last = float(np.quantile(found, QUANTILE)) - MARGIN
        out.append(last)
    return np.array(out)


def predicted(batch: list[str | None], model: LanguageModel) -> list[tuple[str, float, bool]]:
    """(language, score, claimed) of texts: the language of the largest regression value, which
    maps from [-1, 1] to the score, and whether the text is as like that language as its bounds
    ask; `und`, 0 and False without a letter or a model."""
    out: list[tuple[str, float, bool]] = [(UNDETERMINED, 0.0, False)] * len(batch)
    if not model.languages:
        return out
    for start in range(0, len(batch), ROWS):
        seen = [presence(text) for text in batch[start : start + ROWS]]
        at = [i for i, row in enumerate(seen) if row is not None]
        if not at:
            continue
        rows = np.stack([seen[i] for i in at]).astype(np.float32)
        sizes = np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))
        values = ((rows @ model.landmarks) / sizes) @ model.weights
        best = values.argmax(axis=1)
        scores = np.clip((values.max(axis=1) + 1) / 2, 0, 1)
        for i, k, score in zip(at, best, scores):
            own = claimed(batch[start + i], model.usual[:, k], model.bounds[:, k])
            out[start + i] = (model.languages[k], float(score), own)
    return out


@F.pandas_udf(BinaryType())
def _sampled(batch: pd.Series) -> pd.Series:
    """Presence of a text and the n-grams of one piece of it, packed; NULL without a letter."""
    out = []
    for text in texts(batch):
        seen = presence(text)
        piece = None if seen is None else piece_of(text).astype(np.uint16).tobytes()
        out.append(None if seen is None else np.packbits(seen).tobytes() + piece)
    return pd.Series(out, dtype=object)


def _unpacked(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(packed, np.uint8)
    seen = np.unpackbits(raw[: DIMENSIONS // 8]).astype(bool)
    return seen, raw[DIMENSIONS // 8 :].view(np.uint16).astype(np.int64)


def fit_language(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = TEXTS,
    landmarks: int = LANDMARKS,
) -> LanguageModel:
    """Learn from the rows of ``docs`` that have a language and a letter in their text.

    The sample is bounded: of every language the ``sample`` keys that come first by hash, whole
    texts; fewer of each where that would be more than ALL_TEXTS in all. That list, ALL_TEXTS or
    LEAST_TEXTS of each language, is broadcast, so texts are not shuffled; only n-gram presence and one piece of each text, 1.5 KB, reach the driver. Rows
    alike in key and language count once.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(key).isNotNull())
    rows = rows.select(
        F.col(lang).alias("_lang"), F.col(key).alias("_key"), F.col(text).alias("_text")
    )
    languages = rows.agg(F.count_distinct("_lang")).first()[0]
    each = min(sample, max(LEAST_TEXTS, ALL_TEXTS // max(1, languages)))
    chosen = first_by_hash(rows, "_lang", "_key", each)
    found = rows.join(F.broadcast(chosen), ["_lang", "_key"], "left_semi")
    found = found.select("_lang", "_key", _sampled("_text").alias("_seen"))
    found = found.groupBy("_lang", "_key").agg(F.min("_seen").alias("_seen"))
    samples = [
        (row["_lang"], *_unpacked(row["_seen"]))
        for row in sorted(found.where(F.col("_seen").isNotNull()).collect())
    ]
    return trained(samples, landmarks)


def with_language(
    docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "language"
) -> DataFrame:
    """``docs`` with ``out``: struct of lang, score (0 to 1) and claimed (the text is as like that
    language as nearly all of its sample), from the whole text alone.

    A NULL text, or one without a letter, is ``und`` with score 0, and not claimed. Whether a text
    is claimed does not hang on its length: a long one is judged piece by piece. Other columns
    stay; one named ``out`` is replaced. Equal texts get equal answers. No shuffle.
    """
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(PREDICTION)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            yield pd.DataFrame(predicted(list(texts(batch)), own), columns=PREDICTION.names)

    made = free_name(docs, "_language")
    marked = docs.withColumn(made, predict(F.col(f"`{text}`")))
    return marked.drop(*([out] if out in docs.columns else [])).withColumnRenamed(made, out)
