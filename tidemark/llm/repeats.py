"""Substring dedup over bytes: column-wise Burrows-Wheeler order of aligned stretches.

A stretch is a run of neighbouring windows (strings of WINDOW bytes) of one text that share
their anchor: the first of the GRAM-byte strings in the window with the smallest hash. Equal
windows have equal anchors at equal places, so stretches with one anchor, laid out with the
anchor in one column, hold equal windows in equal columns. Inserting one symbol for each
stretch and round, from the last column to the first, keeps their suffixes in Burrows-Wheeler
order together with the common prefix of neighbours; two windows are equal where that prefix
reaches WINDOW bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from tidemark.llm.common import free_name, kept, texts, utf8

WINDOW = 200
GRAM = 32
# Stretches are inserted together in lots of about this many; an anchor with more kinds of
# stretches is split.
LOT = 8_192
# Columns that the windows of a part of a split stretch start in, from split to split.
PARTS = (64, 16, 4, 1)
# Windows of a text handled at once; places within a lot of grams fit 16 bits.
SEGMENT = (1 << 16) - WINDOW
STEP = 0x9E3779B97F4A7C15 | 1
OUTSIDE = 256

_ints = pa.list_(pa.int32())
RUNS = ArrayType(ArrayType(IntegerType()))


@cache
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of STEP and of its inverse modulo 2**64."""
    inverse = pow(STEP, -1, 1 << 64)
    up, down = np.empty(length, np.uint64), np.empty(length, np.uint64)
    up[0] = down[0] = 1
    up[1:], down[1:] = np.uint64(STEP), np.uint64(inverse)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every run of ``gram`` bytes that depends on these bytes alone."""
    up, down = _powers(1 << 17)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    rolled = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    rolled ^= rolled >> np.uint64(31)
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    rolled ^= rolled >> np.uint64(29)
    rolled *= np.uint64(0x94D049BB133111EB)
    return rolled ^ (rolled >> np.uint64(32))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def stretches(data: bytes, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Stretches of a text as columns: anchor hash, digest, first window, windows, place of the
    anchor after the first window. Each window is in exactly one."""
    total = len(data) - window + 1
    if total <= 0:
        return np.zeros((5, 0), dtype=np.int64)
    bytes_all = np.frombuffer(data, dtype=np.uint8)
    place = np.uint64((1 << 16) - 1)
    out = []
    for begin in range(0, total, SEGMENT):
        count = min(SEGMENT, total - begin)
        hashes = _hashes(bytes_all[begin : begin + count + window - 1], gram)
        keys = (hashes & ~place) | np.arange(len(hashes), dtype=np.uint64)
        at = (_sliding_least(keys, window - gram + 1) & place).astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        sizes = np.diff(np.append(first, count))
        anchor = at[first]
        found = np.empty((5, len(first)), dtype=np.int64)
        found[0] = hashes[anchor].view(np.int64)
        found[2], found[3], found[4] = first + begin, sizes, anchor - first
        digest = xxhash.xxh3_64_intdigest
        found[1] = np.array(
            [
                digest(data[a : a + n + window - 1], seed)
                for a, n, seed in zip(found[2].tolist(), sizes.tolist(), found[4].tolist())
            ],
            dtype=np.uint64,
        ).view(np.int64)
        out.append(found)
    return np.concatenate(out, axis=1)


def _grouped(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``found`` in the order of anchor and digest, and where each kind of stretch begins."""
    found = found[:, np.lexsort((found[2], found[1], found[0]))]
    new = (found[0, 1:] != found[0, :-1]) | (found[1, 1:] != found[1, :-1])
    return found, np.flatnonzero(np.append(found.shape[1] > 0, new))


def _anchors(window: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every kind of stretch of a text once: _anchor, _digest, _n."""
        for batch in batches:
            parts: list[tuple] = []
            for text in batch.column(0):
                found, begins = _grouped(stretches(utf8(text.as_py()), window))
                sizes = np.diff(np.append(begins, found.shape[1]))
                parts.append((found[0, begins], found[1, begins], sizes))
            columns = [np.concatenate(column) for column in zip(*parts)] if parts else []
            if columns:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()) for column in columns],
                    names=["_anchor", "_digest", "_n"],
                )

    return anchors


def _occurrences(window: int):
    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every kind of stretch of a text with the places where it starts."""
        for batch in batches:
            rows, kinds, places, lengths = [], [], [], []
            for row, text in enumerate(batch.column(2)):
                found, begins = _grouped(stretches(utf8(text.as_py()), window))
                rows.append(np.full(len(begins), row))
                kinds.append(found[:, begins])
                places.append(found[2])
                lengths.append(np.diff(np.append(begins, found.shape[1])))
            if not rows:
                continue
            take = pa.array(np.concatenate(rows))
            kind = np.concatenate(kinds, axis=1)
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(np.concatenate(places), pa.int32())
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(take),
                    batch.column(1).take(take),
                    pa.array(kind[0], pa.int64()),
                    pa.array(kind[1], pa.int64()),
                    pa.array(kind[3], pa.int32()),
                    pa.array(kind[4], pa.int32()),
                    lists,
                ],
                names=["_id", "_hash", "_anchor", "_digest", "_windows", "_place", "_starts"],
            )

    return occurrences


def _cut(window: int, schema: StructType):
    @F.pandas_udf(schema)
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        """The bytes of the wanted stretches of a text."""
        for batch, wanted in batches:
            rows = []
            for text, kinds in zip(texts(batch), wanted):
                data = utf8(text)
                rows.append(
                    [
                        {
                            **{name: kind[name] for name in schema_names},
                            "_bytes": data[kind["_at"] : kind["_at"] + kind["_windows"] + window - 1],
                        }
                        for kind in kinds
                    ]
                )
            yield pd.Series(rows, dtype=object)

    schema_names = [f.name for f in schema.elementType.fields if f.name != "_bytes"]
    return cut


def equal_windows(
    stretch_bytes: list[bytes], places: np.ndarray, window: int = WINDOW, gram: int = GRAM
) -> np.ndarray:
    """For each stretch and column whether the window starting there is in another stretch.

    ``places``: of the anchor within each stretch. Columns are those of all window starts; the
    anchor is in the last one. Every round inserts one symbol for each stretch, the one before
    its last suffix: a stable sort by the new symbols of the order so far gives the new order,
    and the common prefix of two new neighbours is one more than the least along the way
    between them in the old order.
    """
    count = len(stretch_bytes)
    reach = window - gram
    width = 2 * reach + gram
    begin = reach - places
    end = begin + np.array([len(data) for data in stretch_bytes])
    cells = np.zeros((width, count), dtype=np.uint8)
    for i, data in enumerate(stretch_bytes):
        cells[begin[i] : end[i], i] = np.frombuffer(data, dtype=np.uint8)
    equal = np.zeros((count, reach + 1), dtype=bool)
    order = np.arange(count)
    common = np.zeros(count + 1, dtype=np.int32)
    for column in range(width - 1, -1, -1):
        symbols = cells[column].astype(np.int16)
        symbols[(column < begin) | (column >= end)] = OUTSIDE
        symbols = symbols[order]
        moved = np.argsort(symbols, kind="stable")
        order = order[moved]
        symbols = symbols[moved]
        alike = np.flatnonzero((symbols[1:] == symbols[:-1]) & (symbols[1:] != OUTSIDE))
        fresh = np.zeros(count + 1, dtype=np.int32)
        if len(alike):
            between = np.stack([moved[alike] + 1, moved[alike + 1] + 1], axis=1).ravel()
            fresh[alike + 1] = 1 + np.minimum.reduceat(common, between)[::2]
        common = fresh
        if column <= reach:
            long = np.flatnonzero(common >= window)
            equal[order[long], column] = True
            equal[order[long - 1], column] = True
    return equal


def _insert(window: int):
    def insert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Lots of whole anchors, in the order of anchors, to the repeated runs of windows."""
        held: list[pd.DataFrame] = []
        rows = 0

        def joined() -> pd.DataFrame:
            # Rows alike in id and text bring the same kind again.
            lot = pd.concat(held, ignore_index=True)
            return lot.drop_duplicates(["_anchor", "_digest"], ignore_index=True)

        def done(lot: pd.DataFrame) -> pd.DataFrame:
            places = lot["_place"].to_numpy(dtype=np.int64)
            equal = equal_windows(list(lot["_bytes"]), places, window)
            runs = []
            for i, (place, windows) in enumerate(zip(places, lot["_windows"])):
                own = equal[i, window - GRAM - place :][:windows]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]])))
                runs.append(edges.reshape(-1, 2).tolist())
            out = pd.DataFrame({"_anchor": lot["_anchor"], "_digest": lot["_digest"]})
            out["_runs"] = pd.Series(runs, index=out.index, dtype=object)
            return out[[bool(r) for r in runs]]

        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= LOT:
                lot = joined()
                # The last anchor may go on in the next batch.
                whole = (lot["_anchor"] != lot["_anchor"].iloc[-1]).to_numpy().nonzero()[0]
                cut_at = whole[-1] + 1 if len(whole) else 0
                if cut_at:
                    yield done(lot.iloc[:cut_at])
                held, rows = [lot.iloc[cut_at:].reset_index(drop=True)], len(lot) - cut_at
        if rows:
            yield done(joined())

    return insert


def _inserted(kinds: DataFrame, window: int) -> DataFrame:
    """``kinds`` compared within their anchors, a whole anchor in one lot."""
    return (
        kinds.repartition("_anchor")
        .sortWithinPartitions("_anchor", "_digest")
        .mapInPandas(_insert(window), "_anchor long, _digest long, _runs array<array<int>>")
    )


def _split(window: int, size: int):
    reach = window - GRAM

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Parts of stretches: windows that start in one block of ``size`` columns. All windows
        of a block hold the bytes from its last column to the end of its first window; these
        make the key of the part."""
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            parts = []
            for anchor, kind, windows, place, data in batch.itertuples(index=False):
                begin = reach - place
                end = begin + windows
                for block in range(begin // size, (end - 1) // size + 1):
                    low, high = block * size, (block + 1) * size
                    first, last = max(begin, low) - begin, min(end, high) - begin
                    core = data[high - 1 - begin : low + window - begin]
                    own = data[first : last + window - 1]
                    key = digest(b"%d %d " % (anchor, block) + core)
                    sub = digest(own, place - first)
                    parts.append((anchor, kind, first, key, sub, last - first, place - first, own))
            out = pd.DataFrame(parts, columns=PART.names)
            for name in ("_key", "_sub"):
                out[name] = out[name].astype(np.uint64).to_numpy().view(np.int64)
            yield out

    return split


PART = StructType(
    [
        StructField("_anchor", LongType()),
        StructField("_digest", LongType()),
        StructField("_first", IntegerType()),
        StructField("_key", LongType()),
        StructField("_sub", LongType()),
        StructField("_windows", IntegerType()),
        StructField("_place", IntegerType()),
        StructField("_bytes", BinaryType()),
    ]
)


def _crowded(kinds: DataFrame, most: int) -> DataFrame:
    """Anchors with more than ``most`` kinds of stretches: there is at most one for so many."""
    counts = kinds.groupBy("_anchor").agg(F.count(F.lit(1)).alias("_kinds"))
    return counts.where(F.col("_kinds") > most).select("_anchor")


def _compared(
    kinds: DataFrame, crowded: DataFrame, window: int, most: int, sizes: tuple[int, ...] = PARTS
) -> DataFrame:
    """For ``kinds`` (_anchor, _digest, _windows, _place, _bytes) the runs of windows that are in
    another kind too: _anchor, _digest, _runs.

    A crowded anchor does not go to one task. Its stretches are split into parts that get a
    longer anchor each, the bytes that all windows of a part share; equal windows are in parts
    of the same block with the same bytes there. Equal parts become one, and parts with one
    anchor are compared like stretches, split again where they are still too many. The
    last split leaves single windows, whose anchor is the whole window.
    """
    if not sizes or crowded.isEmpty():
        return _inserted(kinds, window)
    kinds = kept(kinds, "kinds")
    calm = _inserted(kinds.join(crowded, "_anchor", "left_anti"), window)
    hot = kinds.join(crowded, "_anchor", "left_semi")
    hot = hot.select("_anchor", "_digest", "_windows", "_place", "_bytes")
    parts = kept(hot.mapInPandas(_split(window, sizes[0]), PART), "parts")
    subs = parts.groupBy("_key", "_sub").agg(
        F.count(F.lit(1)).alias("_n"),
        F.first("_windows").alias("_windows"),
        F.first("_place").alias("_place"),
        F.first("_bytes").alias("_bytes"),
    )
    several = parts.groupBy("_key").agg(F.min("_sub").alias("_low"), F.max("_sub").alias("_high"))
    several = several.where("_low < _high").select("_key")
    inner = subs.join(several, "_key", "left_semi").select(
        F.col("_key").alias("_anchor"),
        F.col("_sub").alias("_digest"),
        "_windows",
        "_place",
        "_bytes",
    )
    inner = kept(inner, "kinds")
    runs = _compared(inner, _crowded(inner, most), window, most, sizes[1:]).select(
        F.col("_anchor").alias("_key"), F.col("_digest").alias("_sub"), "_runs"
    )
    copied = parts.groupBy("_key", "_sub").agg((F.count(F.lit(1)) > 1).alias("_copied"))
    whole = F.array(F.array(F.lit(0), F.col("_windows")))
    found = (
        parts.drop("_bytes", "_place")
        .join(copied, ["_key", "_sub"])
        .join(runs, ["_key", "_sub"], "left")
        .withColumn("_runs", F.when(F.col("_copied"), whole).otherwise(F.col("_runs")))
        .where(F.col("_runs").isNotNull())
    )
    moved = F.transform(
        "_runs", lambda run: F.transform(run, lambda place: place + F.col("_first"))
    )
    found = found.select("_anchor", "_digest", moved.alias("_runs")).groupBy("_anchor", "_digest")
    return calm.unionByName(found.agg(F.flatten(F.collect_list("_runs")).alias("_runs")))


def _merged(pairs: np.ndarray) -> np.ndarray:
    """Union of [start, end) runs as rows, in order, runs that touch made one."""
    if not len(pairs):
        return pairs.reshape(0, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.flatnonzero(np.append(True, pairs[1:, 0] > reach[:-1]))
    last = np.append(new[1:], len(pairs)) - 1
    return np.stack([pairs[new, 0], reach[last]], axis=1)


CUT = StructType([StructField("removed", RUNS), StructField("kept", BinaryType())])


def _remove(window: int):
    @F.pandas_udf(CUT)
    def remove(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for batch, repeated in batches:
            rows = []
            for text, kinds in zip(texts(batch), repeated):
                data = utf8(text)
                pairs = [np.zeros((0, 2), dtype=np.int64)]
                for kind in kinds if kinds is not None else ():
                    starts = np.asarray(kind["_starts"], dtype=np.int64)
                    for low, high in kind["_runs"]:
                        pairs.append(np.stack([starts + low, starts + high + window - 1], axis=1))
                spans = _merged(np.concatenate(pairs))
                bounds = np.concatenate([[0], spans.ravel(), [len(data)]]).reshape(-1, 2).tolist()
                rows.append((spans.tolist(), b"".join(data[a:b] for a, b in bounds)))
            yield pd.DataFrame(rows, columns=CUT.names)

    return remove


def repeated_runs(keyed: DataFrame, window: int, most: int = LOT) -> DataFrame:
    """For the rows of ``keyed`` (_id, _hash, _text) what of them repeats: _id, _hash, _kinds
    (array of struct<_starts, _runs>: runs of windows that repeat, in each of the stretches).
    Anchors with more than ``most`` kinds of stretches are split."""
    counted = keyed.select("_text").mapInArrow(
        _anchors(window), "_anchor long, _digest long, _n long"
    )
    anchors = counted.groupBy("_anchor").agg(
        F.sum("_n").alias("_n"), F.min("_digest").alias("_low"), F.max("_digest").alias("_high")
    )
    anchors = anchors.where("_n > 1").select("_anchor", (F.col("_low") < F.col("_high")).alias("_many"))
    kind = f"_id {keyed.schema['_id'].dataType.simpleString()}, _hash long, _anchor long, "
    kind += "_digest long, _windows int, _place int, _starts array<int>"
    found = keyed.select("_id", "_hash", "_text").mapInArrow(_occurrences(window), kind)
    found = kept(found.join(anchors, "_anchor"), "stretches")

    # One stretch of each kind, where an anchor has several kinds, with its bytes.
    several = found.where("_many").groupBy("_anchor", "_digest").agg(
        F.sum(F.size("_starts")).alias("_n"),
        F.min(F.struct("_id", "_hash", F.element_at("_starts", 1).alias("_at"))).alias("_one"),
        F.first("_windows").alias("_windows"),
        F.first("_place").alias("_place"),
    )
    several = kept(several, "kinds")
    wanted = several.select("_one.*", "_anchor", "_digest", "_windows", "_place").groupBy(
        "_id", "_hash"
    )
    wanted = wanted.agg(
        F.collect_list(F.struct("_anchor", "_digest", "_windows", "_place", "_at")).alias("_wanted")
    )
    same = F.col("_id").eqNullSafe(F.col("_own_id")) & (F.col("_hash") == F.col("_own_hash"))
    owners = wanted.select(F.col("_id").alias("_own_id"), F.col("_hash").alias("_own_hash"), "_wanted")
    schema = ArrayType(
        StructType(
            [
                StructField("_anchor", LongType()),
                StructField("_digest", LongType()),
                StructField("_windows", IntegerType()),
                StructField("_place", IntegerType()),
                StructField("_bytes", BinaryType()),
            ]
        )
    )
    cut = keyed.join(owners, same).select(
        F.explode(_cut(window, schema)(F.col("_text"), F.col("_wanted"))).alias("_kind")
    )
    runs = _compared(cut.select("_kind.*"), _crowded(several, most), window, most)

    whole = F.array(F.array(F.lit(0), F.col("_windows")))
    single = found.where("not _many").select("_id", "_hash", "_starts", whole.alias("_runs"))
    copied = several.select("_anchor", "_digest", (F.col("_n") > 1).alias("_copied"))
    shared = (
        found.where("_many")
        .join(copied, ["_anchor", "_digest"])
        .join(runs, ["_anchor", "_digest"], "left")
        .select(
            "_id",
            "_hash",
            "_starts",
            F.when(F.col("_copied"), whole).otherwise(F.col("_runs")).alias("_runs"),
        )
        .where(F.col("_runs").isNotNull())
    )
    return single.unionByName(shared).groupBy("_id", "_hash").agg(
        F.collect_list(F.struct("_starts", "_runs")).alias("_kinds")
    )


def without_repeated_bytes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    out: str = "deduplicated",
    window: int = WINDOW,
    most: int = LOT,
) -> DataFrame:
    """``docs`` with ``out``: struct of removed ([start, end) in bytes, in order, apart) and kept
    (the bytes left, which may cut a character).

    Removed is every byte of the UTF-8 text inside a string of ``window`` bytes that starts
    anywhere else too, in the same text or another; strings are judged on the input. NULL and
    short texts have none; a row that comes twice is its own copy. Rows alike in ``key`` and
    text are cut alike. Other columns stay; one named ``out`` is replaced. ``most`` bounds the
    kinds of stretches that one task compares at once, not the result.
    """
    keyed = docs.select(
        F.col(f"`{key}`").alias("_id"),
        F.xxhash64(F.col(f"`{text}`")).alias("_hash"),
        F.col(f"`{text}`").alias("_text"),
    )
    runs = repeated_runs(keyed, window, most)
    id_name, hash_name, kinds = (free_name(docs, n) for n in ("_id", "_hash", "_kinds"))
    runs = runs.select(
        F.col("_id").alias(id_name), F.col("_hash").alias(hash_name), F.col("_kinds").alias(kinds)
    )
    rows = docs.alias("docs").join(
        runs,
        F.col(f"docs.`{key}`").eqNullSafe(F.col(id_name))
        & (F.xxhash64(F.col(f"docs.`{text}`")) == F.col(hash_name)),
        "left",
    )
    names = [name for name in docs.columns if name.lower() != out.lower()]
    return rows.select(
        *[F.col(f"docs.`{name}`") for name in names],
        _remove(window)(F.col(f"docs.`{text}`"), F.col(kinds)).alias(out),
    )
