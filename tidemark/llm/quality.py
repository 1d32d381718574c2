"""Quality classifier: attention-based multiple-instance learning over passages of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    FloatType,
    StructField,
    StructType,
)

from tidemark.llm.common import first_by_hash, free_name, texts

# A passage is PASSAGE words, whatever the length of the text. A text's passages are made and
# scored PIECE at a time (no more than 2**8).
PASSAGE = 48
PIECE = 256
# Bound of the training sample: passages of a text, evenly spaced over all of it.
PASSAGES = 32
# Passages that are scored at once.
LOT = 4096
HASHED = 96
STYLE = 12
WIDTH = HASHED + STYLE
# Bound of the training sample: labelled texts of each label.
TEXTS = 1_500
HIDDEN, ATTENTION = 24, 12
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.01, 1e-4

SCORED = StructType(
    [StructField("score", DoubleType()), StructField("attention", ArrayType(FloatType()))]
)


# Bits of the kinds of characters.
LETTER, UPPER, DIGIT, SPACE, ENDS = 1, 2, 4, 8, 16
_kinds = np.full(0x110000, 255, dtype=np.uint8)
_small = np.zeros(0x110000, dtype=np.uint32)


def _kind(codes: np.ndarray) -> np.ndarray:
    """Kinds of characters; every character is looked up once in a task."""
    kinds = _kinds[codes]
    if (kinds == 255).any():
        for code in np.unique(codes[kinds == 255]).tolist():
            char = chr(code)
            _small[code] = ord(char.lower()[0])
            _kinds[code] = (
                LETTER * char.isalpha()
                + UPPER * char.isupper()
                + DIGIT * char.isdigit()
                + SPACE * char.isspace()
                + ENDS * (char in ".!?")
            )
        kinds = _kinds[codes]
    return kinds


# Powers of the base of word hashes; beyond so many characters they start anew.
REACH = 1 << 12
_powers = np.multiply.accumulate(np.append(1, np.full(REACH - 1, 0x100000001B3, np.uint64)).astype(np.uint64))


def passages(text: str | None) -> Iterator[np.ndarray]:
    """One row for every passage of a text, in pieces of at most ``PIECE``; a NULL or empty text
    is one row of zeros.

    A row holds the roots of hashed word frequencies and the style of the passage: means over
    its words, the share of different words, the share of words that repeat the one before,
    and the length.
    """
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = _kind(codes)
    solid = (kinds & SPACE) == 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], solid.view(np.int8), [0]])))
    first, last = edges[::2], edges[1::2] - 1
    if not len(first):
        yield np.zeros((1, WIDTH), dtype=np.float32)
        return
    lengths = last - first + 1
    starts = np.cumsum(lengths) - lengths
    inside = np.arange(lengths.sum()) - np.repeat(starts, lengths)
    kinds, codes = kinds[solid], _small[codes[solid]]

    def count(bit: int) -> np.ndarray:
        return np.add.reduceat((kinds & bit) != 0, starts, dtype=np.int32)

    # A hash of each word: its characters, lowered, as digits of a number in a large base.
    words = np.add.reduceat((codes + np.uint64(1)) * _powers[inside % REACH], starts)
    words *= np.uint64(0x9E3779B97F4A7C15)
    letters, upper, digits = count(LETTER), count(UPPER), count(DIGIT)
    marks = lengths - letters - digits
    style = np.stack(
        [
            np.minimum(lengths, 40) / 10,
            upper / lengths,
            digits / lengths,
            marks / lengths,
            marks >= 2,
            letters == 0,
            (letters > 1) & (upper == letters),
            (kinds[starts + lengths - 1] & ENDS) != 0,
            (kinds[starts] & UPPER) != 0,
            np.append(False, words[1:] == words[:-1]),
        ],
        axis=1,
    )
    for begin in range(0, len(words), PIECE * PASSAGE):
        end = begin + PIECE * PASSAGE
        yield _rows(words[begin:end], style[begin:end])


def _rows(words: np.ndarray, style: np.ndarray) -> np.ndarray:
    where = np.arange(len(words)) // PASSAGE
    begins = np.arange(0, len(words), PASSAGE)
    rows = len(begins)
    sizes = np.bincount(where)[:, None]
    out = np.zeros((rows, WIDTH), dtype=np.float32)
    bucket = (words >> np.uint64(40)).astype(np.int64) % HASHED
    hashed = np.bincount(where * HASHED + bucket, minlength=rows * HASHED)
    out[:, :HASHED] = np.sqrt(hashed.reshape(rows, HASHED) / sizes)
    out[:, HASHED : HASHED + STYLE - 2] = np.add.reduceat(style, begins, axis=0) / sizes
    kind = np.sort((words >> np.uint64(8)) | (where.astype(np.uint64) << np.uint64(56)))
    fresh = kind[np.append(True, kind[1:] != kind[:-1])] >> np.uint64(56)
    out[:, -2] = np.bincount(fresh.astype(np.int64)) / sizes[:, 0]
    out[:, -1] = sizes[:, 0] / PASSAGE
    return out


def sampled(text: str | None) -> np.ndarray:
    """At most ``PASSAGES`` passages of a text, evenly spaced from the first to the last."""
    rows = np.concatenate(list(passages(text)))
    if len(rows) <= PASSAGES:
        return rows
    return rows[np.arange(PASSAGES) * (len(rows) - 1) // (PASSAGES - 1)]


@dataclass
class QualityModel:
    """Gated attention: passages x become h = tanh(x E + e); their weights are the softmax of
    w . (tanh(h V) * sigmoid(h U)), and the weighted sum of h gives the score."""

    parts: dict[str, np.ndarray]

    def hidden(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """h, tanh and sigmoid gates, and the unscaled weight of every passage."""
        p = self.parts
        h = np.tanh((rows - p["mean"]) / p["scale"] @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        return h, t, g, (t * g) @ p["w"]

    def score(self, z: np.ndarray) -> np.ndarray:
        return _sigmoid(z @ self.parts["c"] + self.parts["b"])

    def forward(self, rows: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> dict:
        h, t, g, a = self.hidden(rows)
        top = np.maximum.reduceat(a, begins)
        x = np.exp(a - np.repeat(top, sizes))
        a = x / np.repeat(np.add.reduceat(x, begins), sizes)
        z = np.add.reduceat(a[:, None] * h, begins, axis=0)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "y": self.score(z)}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def trained(bags: list[np.ndarray], labels: list[int], share: float, seed: int = 5) -> QualityModel:
    """Learn attention and score from the labels of whole texts, by Adam on log loss.

    ``share`` is the part of label 1 among all labelled texts, to which the sample, balanced by
    its making, is weighed back.
    """
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags) if bags else np.zeros((1, WIDTH), np.float32)
    parts = {
        "mean": every.mean(axis=0),
        "scale": every.std(axis=0) + 0.05,
        "E": rng.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)),
        "e": np.zeros(HIDDEN),
        "V": rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)),
        "U": rng.normal(0, HIDDEN**-0.5, (HIDDEN, ATTENTION)),
        "w": rng.normal(0, ATTENTION**-0.5, ATTENTION),
        "c": np.zeros(HIDDEN),
        "b": np.zeros(1),
    }
    model = QualityModel(parts)
    y = np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        # One label only, or none: its share is all there is to learn.
        parts["b"] = np.array([np.log((share + 1e-3) / (1 - share + 1e-3))])
        return model
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    learned = [name for name in parts if name not in ("mean", "scale")]
    first = {name: np.zeros_like(parts[name]) for name in learned}
    second = {name: np.zeros_like(parts[name]) for name in learned}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(bags))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            sizes = np.array([len(bags[i]) for i in chosen])
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            rows = np.concatenate([bags[i] for i in chosen])
            f = model.forward(rows, begins, sizes)
            scaled = (rows - parts["mean"]) / parts["scale"]
            dy = (f["y"] - y[chosen]) * weight[chosen] / len(chosen)
            dz = np.repeat(dy[:, None] * parts["c"], sizes, axis=0)
            grow = (dz * f["h"]).sum(axis=1)
            mean = np.add.reduceat(f["a"] * grow, begins)
            da = f["a"] * (grow - np.repeat(mean, sizes))
            dt = da[:, None] * parts["w"] * f["g"] * (1 - f["t"] ** 2)
            dg = da[:, None] * parts["w"] * f["t"] * f["g"] * (1 - f["g"])
            dh = f["a"][:, None] * dz + dt @ parts["V"].T + dg @ parts["U"].T
            dx = dh * (1 - f["h"] ** 2)
            grads = {
                "E": scaled.T @ dx + DECAY * parts["E"],
                "e": dx.sum(axis=0),
                "V": f["h"].T @ dt,
                "U": f["h"].T @ dg,
                "w": ((f["t"] * f["g"]) * da[:, None]).sum(axis=0),
                "c": f["z"].T @ dy + DECAY * parts["c"],
                "b": np.array([dy.sum()]),
            }
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) + 1e-4
            for name, grad in grads.items():
                first[name] = 0.9 * first[name] + 0.1 * grad
                second[name] = 0.999 * second[name] + 0.001 * grad**2
                moved = first[name] / (1 - 0.9**step)
                spread = np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8
                parts[name] = parts[name] - rate * moved / spread
    return model


def _lots(batch: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Pieces of texts with the numbers of their texts, about ``LOT`` passages at a time."""
    owners: list[int] = []
    pieces: list[np.ndarray] = []
    held = 0
    for number, text in enumerate(batch):
        for piece in passages(text):
            owners.append(number)
            pieces.append(piece)
            held += len(piece)
            if held >= LOT:
                yield owners, pieces
                owners, pieces, held = [], [], 0
    if owners:
        yield owners, pieces


def scored(batch: list[str | None], model: QualityModel) -> list[tuple]:
    """(score, attention of each passage) for every text.

    A text's pieces go through the softmax one after another: its largest weight so far, and
    the sums of weights and of weighted passages below that, are all that is carried on.
    """
    top = np.full(len(batch), -np.inf)
    total = np.zeros(len(batch))
    z = np.zeros((len(batch), HIDDEN))
    unscaled: list[list[np.ndarray]] = [[] for _ in batch]
    for owners, pieces in _lots(batch):
        sizes = np.array([len(piece) for piece in pieces])
        begins = np.cumsum(sizes) - sizes
        h, _, _, a = model.hidden(np.concatenate(pieces))
        most = np.maximum.reduceat(a, begins)
        x = np.exp(a - np.repeat(most, sizes))
        weights = np.add.reduceat(x, begins)
        weighted = np.add.reduceat(x[:, None] * h, begins, axis=0)
        for k, number in enumerate(owners):
            high = max(top[number], most[k])
            before, now = np.exp(top[number] - high), np.exp(most[k] - high)
            total[number] = total[number] * before + weights[k] * now
            z[number] = z[number] * before + weighted[k] * now
            top[number] = high
            unscaled[number].append(a[begins[k] : begins[k] + sizes[k]])
    scores = model.score(z / total[:, None])
    return [
        (float(y), (np.exp(np.concatenate(a) - high) / whole).astype(np.float32))
        for y, a, high, whole in zip(scores, unscaled, top, total)
    ]


@F.pandas_udf(BinaryType())
def _encode(batch: pd.Series) -> pd.Series:
    return pd.Series([sampled(text).tobytes() for text in texts(batch)], dtype=object)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    key: str = "doc_id",
    text: str = "text",
    sample: int = TEXTS,
) -> QualityModel:
    """Learn from the texts of ``docs`` whose ``key`` has a ``label`` of 0 or 1 in ``labels``.

    The sample is bounded: of each label the ``sample`` keys that come first by hash, of each
    text at most ``PASSAGES`` passages of ``WIDTH`` numbers, evenly spaced over all of it. That list of keys, of known
    size, is broadcast, so texts are read once and not shuffled. Labels without a text are
    left out, a NULL text counts as an empty one, repeated labels and texts of a key count
    once. Without labels every score is one half.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("_key")).agg(F.min(label).cast("int").alias("_label"))
    share = known.agg(F.coalesce(F.avg("_label"), F.lit(0.5))).first()[0]
    chosen = first_by_hash(known, "_label", "_key", sample)
    found = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    found = found.join(F.broadcast(chosen), "_key")
    found = found.select("_key", "_label", _encode("_text").alias("_rows"))
    found = found.groupBy("_key", "_label").agg(F.min("_rows").alias("_rows"))
    listed = sorted(found.collect())
    bags = [np.frombuffer(row["_rows"], dtype=np.float32).reshape(-1, WIDTH) for row in listed]
    return trained(bags, [row["_label"] for row in listed], share)


def with_quality(
    docs: DataFrame, model: QualityModel, text: str = "text", out: str = "quality"
) -> DataFrame:
    """``docs`` with ``out``: struct of score (0 to 1, higher: label 1 likelier) and attention
    (one weight for every passage, summing to 1), from the whole text alone.

    A NULL or empty text is one empty passage and gets a score as well. Other columns stay;
    one named ``out`` is replaced. Equal texts get equal scores. No shuffle.
    """
    shared: Broadcast = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(SCORED)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            yield pd.DataFrame(scored(list(texts(batch)), own), columns=SCORED.names)

    made = free_name(docs, "_quality")
    marked = docs.withColumn(made, score(F.col(f"`{text}`")))
    return marked.drop(*([out] if out in docs.columns else [])).withColumnRenamed(made, out)
