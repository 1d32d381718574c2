"""Hard-negative mining over an inverted multi-index, with certified results."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, numbered

# Vectors that the codebooks are learned from, and steps of learning.
SAMPLE = 8192
STEPS = 8
# Rows of a cell on average, until the codebooks have MOST_WORDS words.
CELL = 1024
MOST_WORDS = 1024
# Rows of a block, and anchors that meet it at once (about, both); components of either (about),
# and cells of a block at most.
BLOCK = 32768
CHUNK = 16384
COMPONENTS = 1 << 22
CELLS = 64
# Scores, and visits of anchors to cells, that a task holds at once.
SCORES = 1 << 19
VISITS = 1 << 19
# Rows whose cells an anchor visits in the first round; every round goes WIDER times as far.
FIRST = 8192
WIDER = 8
# Components are cut to whole numbers below this, so that inner products fit 64 bits.
LARGEST = 1 << 27
# Scores below and above all others; whole numbers that floats hold exactly.
LEAST, MOST = -(1 << 63), (1 << 63) - 1
FLOATS = {np.float32: 1 << 24, np.float64: 1 << 53}

# Vectors are packed as whole numbers, row by row; a block's rows stand by cell, label and id.
PACKED = "_ids binary, _labels binary, _matrix binary, _size int"
CODED = "_id long, _label long, _vector binary, _cell int, _far_1 double, _far_2 double"
BLOCKED = f"_block int, _cells binary, {PACKED}"
CHUNKED = f"_chunk int, {PACKED}, _limits binary, _low binary, _high binary"
# Of a chunk and a block: who, by place in the chunk, visits which cell. Block -1: a walk goes on.
ASKED = "_chunk int, _block int, _cells binary, _at binary"
FOUND = "_anchor long, _limit long, _score long, _id long"


@dataclass
class Index:
    half: int  # components of the first half
    words: tuple[np.ndarray, np.ndarray]  # the codebook of each half
    radii: tuple[np.ndarray, np.ndarray]  # the farthest row of each word
    sizes: np.ndarray  # rows of every cell, word by word
    first: np.ndarray | None = None  # the first block of every cell
    parts: np.ndarray | None = None  # and how many it has

    def bounds(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each half what a row of each word can score with ``anchor`` at most, and at least."""
        out = []
        sides = (anchor[: self.half], anchor[self.half :])
        for part, words, radii in zip(sides, self.words, self.radii):
            centre, reach = words @ part, np.sqrt((part * part).sum()) * radii
            slack = 1e-9 * (np.abs(words) @ np.abs(part) + reach) + 1e-6
            out.append((centre + reach + slack, centre - reach - slack))
        return out[0][0], out[1][0], out[0][1], out[1][1]

    def cells(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Pairs of words by falling sum of their bounds: the multi-sequence walk.

        A pair comes onto the heap once the pair before it in its row or column is visited.
        """
        one, two = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        first, second = first[one].tolist(), second[two].tolist()
        one, two = one.tolist(), two.tolist()
        heap = [(-(first[0] + second[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            yield -bound, one[i], two[j]
            if j == 0 and i + 1 < len(one):
                heapq.heappush(heap, (-(first[i + 1] + second[0]), i + 1, 0))
            if j + 1 < len(two):
                heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))


def learned_words(rows: np.ndarray, count: int, seed: int) -> np.ndarray:
    """``count`` centres of ``rows``, by rounds of nearest centres and means."""
    rng = np.random.default_rng(seed)
    words = rows[rng.choice(len(rows), min(count, len(rows)), replace=False)].copy()
    for _ in range(STEPS):
        near = _nearest(rows, words)
        for k in range(len(words)):
            own = rows[near == k]
            if len(own):
                words[k] = own.mean(axis=0)
    return words


def _nearest(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (rows @ words.T - (words * words).sum(axis=1) / 2).argmax(axis=1)


def _coder(half: int, words: Broadcast):
    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            rows = np.stack(batch["_vector"].to_numpy()).astype(np.float64)
            cell = np.zeros(len(rows), dtype=np.int64)
            for k, (part, own) in enumerate(zip((rows[:, :half], rows[:, half:]), words.value)):
                near = _nearest(part, own)
                batch[f"_far_{k + 1}"] = np.sqrt(((part - own[near]) ** 2).sum(axis=1))
                cell = cell * len(own) + near
            batch["_cell"] = cell
            batch["_vector"] = [row.tobytes() for row in rows.astype(np.int32)]
            yield batch

    return code


def _rows(most: int, width: int) -> int:
    """How many rows of ``width`` components, ``most`` at most, go together."""
    return max(1, min(most, COMPONENTS // width))


def _cut(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The first block of every cell, and how many it has."""
    first, parts = np.zeros(len(sizes), dtype=np.int64), np.maximum(1, -(-sizes // most))
    block = rows = cells = 0
    for cell in np.flatnonzero(sizes).tolist():
        size, own = int(sizes[cell]), int(parts[cell])
        if cells and (rows + size > most or cells == CELLS):
            block, rows, cells = block + 1, 0, 0
        first[cell] = block
        rows, cells = rows + size, cells + 1
        if own > 1:
            block, rows, cells = block + own, 0, 0
    return first, parts


def _packed(ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray) -> dict:
    """PACKED of whole numbers, in the narrowest type that holds all of them."""
    largest = np.abs(matrix).max(initial=0)
    kind = next(k for k in (np.int8, np.int16, np.int32) if largest <= np.iinfo(k).max)
    return {
        "_ids": ids.astype(np.int64).tobytes(),
        "_labels": labels.astype(np.int64).tobytes(),
        "_matrix": matrix.astype(kind).tobytes(),
        "_size": np.dtype(kind).itemsize,
    }


def _unpacked(row: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["_ids"], np.int64)
    matrix = np.frombuffer(row["_matrix"], f"i{int(row['_size'])}").reshape(len(ids), -1)
    return ids, np.frombuffer(row["_labels"], np.int64), matrix


def _gathered(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["_cell", "_label", "_id"])
    matrix = np.frombuffer(b"".join(group["_vector"]), np.int32).reshape(len(group), -1)
    row = {
        "_block": group["_block"].iloc[0],
        "_cells": group["_cell"].to_numpy(np.int32).tobytes(),
        **_packed(group["_id"].to_numpy(), group["_label"].to_numpy(), matrix),
    }
    return pd.DataFrame([row])


def _window(limit: int, held: int, same: bool, low: int, high: int) -> tuple[int, int]:
    """The least and the largest score that can still be among the best of a limit."""
    if same:
        return held, MOST
    least, most = -(-low * limit // 100), high * limit // 100
    return max(held, min(least, MOST)), max(LEAST, min(most, MOST))


def _chunker(same: bool, low: int, high: int):
    """Anchors of a chunk as one row, with the window of each of their limits."""

    def chunk(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_at")
        shape = len(group), max(map(len, group["_limits"]))
        limits, lows = np.zeros(shape, dtype=np.int64), np.full(shape, MOST)
        highs = np.full(shape, LEAST)
        for k, (own, held) in enumerate(zip(group["_limits"], group["_held"])):
            limits[k, : len(own)] = own
            for n, (limit, least) in enumerate(zip(own, held)):
                lows[k, n], highs[k, n] = _window(int(limit), int(least), same, low, high)
        matrix = np.stack(group["_vector"].to_numpy()).astype(np.int32)
        row = {
            "_chunk": group["_chunk"].iloc[0],
            **_packed(group["_anchor"].to_numpy(), group["_label"].to_numpy(), matrix),
            "_limits": limits.tobytes(),
            "_low": lows.tobytes(),
            "_high": highs.tobytes(),
        }
        return pd.DataFrame([row])

    return chunk


def _exact(anchors: np.ndarray, matrix: np.ndarray) -> type:
    """A type that holds all sums of products: a sum is below the product of two lengths."""
    lengths = (np.sqrt((m.astype(np.float64) ** 2).sum(axis=1)) for m in (anchors, matrix))
    one, two = (length.max(initial=0) for length in lengths)
    return next((k for k, most in FLOATS.items() if one * two < most - 1), np.int64)


def products(anchors: np.ndarray, matrix: np.ndarray, kind: type | None = None) -> np.ndarray:
    """Inner products of whole numbers, exactly: by floats while these hold all sums."""
    kind = kind or _exact(anchors, matrix)
    return anchors.astype(kind, copy=False) @ matrix.T.astype(kind, copy=False)


def _first(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` best different ids of every group: by falling score, ties to the
    smaller id."""
    order = np.lexsort((-scores, ids, groups))
    heads = np.ones(len(order), dtype=bool)
    heads[1:] = (np.diff(groups[order]) != 0) | (np.diff(ids[order]) != 0)
    order = order[heads]
    order = order[np.lexsort((ids[order], -scores[order], groups[order]))]
    own = groups[order]
    return order[np.arange(len(own)) - np.searchsorted(own, own) < count]


def _pieces(
    asked: pd.DataFrame, cells: np.ndarray, labels: np.ndarray, own: np.ndarray, same: bool
) -> Iterator[tuple[np.ndarray, slice]]:
    """Anchors, by their places, and the rows of a block that they meet: those of a cell, for
    ``same`` of a cell and a label. No more than SCORES pairs at once."""
    wanted = np.frombuffer(b"".join(asked["_cells"]), np.int32)
    at = np.frombuffer(b"".join(asked["_at"]), np.int32)
    order = np.argsort(wanted, kind="stable")
    wanted, at = wanted[order], at[order]
    heads = np.flatnonzero(np.diff(wanted, prepend=-1))
    for cell, places in zip(wanted[heads], np.split(at, heads[1:])):
        begin, end = (int(np.searchsorted(cells, cell, side)) for side in ("left", "right"))
        groups = [(places, begin, end)]
        if same:
            places = places[np.argsort(own[places], kind="stable")]
            values, firsts = np.unique(own[places], return_index=True)
            part, parts = labels[begin:end], np.split(places, firsts[1:])
            begins, ends = (begin + np.searchsorted(part, values, s) for s in ("left", "right"))
            met = np.flatnonzero(begins < ends).tolist()
            groups = [(parts[k], int(begins[k]), int(ends[k])) for k in met]
        for group, first, last in groups:
            step = max(1, SCORES // max(1, last - first))
            for k in range(0, len(group), step):
                yield group[k : k + step], slice(first, last)


def _searcher(same: bool, count: int):
    """Rows of one block that may be among the best of the anchors of a chunk that visit it.

    ``same``: the best rows of the anchor's label. Otherwise, for each of the anchor's limits, the
    best rows of other labels whose score is in the limit's window. What is worse than what the
    anchor holds already is left out.
    """

    def search(asked: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
        names = [field.split()[0] for field in FOUND.split(", ")]
        is_block = packed["_cells"].notna()
        if not len(asked) or not is_block.any():  # a part of a cut cell may have no rows
            return pd.DataFrame([], columns=names)
        block, chunk = packed[is_block].iloc[0], packed[~is_block].iloc[0]
        ids, labels, rows = _unpacked(block)
        anchors, own, vectors = _unpacked(chunk)
        limits, low, high = (
            np.frombuffer(chunk[name], np.int64).reshape(len(anchors), -1)
            for name in ("_limits", "_low", "_high")
        )
        kind = _exact(vectors, rows)
        vectors, rows = vectors.astype(kind), rows.astype(kind)
        floor = low.min(axis=1)
        if kind in FLOATS:
            floor = floor.clip(-FLOATS[kind], FLOATS[kind]).astype(kind)
        found, held = [np.empty((0, 3), dtype=np.int64)], 0  # group, score and row
        cells, each = np.frombuffer(block["_cells"], np.int32), limits.shape[1]

        def best() -> np.ndarray:
            both = np.concatenate(found)
            return both[_first(both[:, 0], both[:, 1], ids[both[:, 2]], count)]

        for places, part in _pieces(asked, cells, labels, own, same):
            scores = products(vectors[places], rows[part], kind)
            at, row = np.nonzero(scores >= floor[places, None])
            score, at, row = scores[at, row].astype(np.int64), places[at], row + part.start
            usable = (ids[row] != anchors[at]) & ((labels[row] == own[at]) == same)
            score, at, row = score[usable], at[usable], row[usable]
            for k in range(each):
                good = np.flatnonzero((score >= low[at, k]) & (score <= high[at, k]))
                group = at[good].astype(np.int64) * each + k
                own_best = _first(group, score[good], ids[row[good]], count)
                good = good[own_best]
                if len(good):
                    found.append(np.stack([group[own_best], score[good], row[good]], axis=1))
                    held += len(good)
            if held > SCORES:
                found[:], held = [best()], 0
        group, score, row = best().T
        columns = anchors[group // each], limits[group // each, group % each], score, ids[row]
        return pd.DataFrame(dict(zip(names, columns)))

    return search


def _planner(index: Broadcast, begin: int, end: int, same: bool, low: int, high: int):
    """Cells that anchors visit between ``begin`` and ``end`` rows of their walk, by block.

    The walk of a limit stops at a certified result: when as many rows are held as are asked for
    that are better than the bound of the next cell, or when that bound is below the limit's
    window. Cells that lie above all windows are passed by. A walk that only ``end`` stops is told
    by a row of block -1, as it may have no cell in this round and some in a later one.
    """

    def visited(
        vector: np.ndarray, limits: np.ndarray, held: np.ndarray
    ) -> tuple[list[int], bool]:
        own = index.value
        first, second, low_1, low_2 = own.bounds(np.asarray(vector, dtype=np.float64))
        windows = sorted(
            _window(int(limit), int(least), same, low, high) for limit, least in zip(limits, held)
        )
        windows = [(least, most) for least, most in windows if least <= most]
        width, sizes, seen, out = len(second), own.sizes, 0, []
        low_1, low_2 = low_1.tolist(), low_2.tolist()
        top = max((most for _, most in windows), default=0)
        for bound, i, j in own.cells(first, second):
            cell = i * width + j
            size = int(sizes[cell])
            if not size:
                continue
            if windows and bound < windows[-1][0]:
                windows = [window for window in windows if bound >= window[0]]
                top = max((most for _, most in windows), default=0)
            if not windows:
                break
            if seen >= end:
                return out, True
            if seen >= begin and low_1[i] + low_2[j] <= top:
                out.append(cell)
            seen += size
        return out, False

    names = [field.split()[0] for field in ASKED.split(", ")]

    def rows(visits: dict[int, list[tuple[int, list[int]]]]) -> pd.DataFrame:
        out = []
        for chunk, own in visits.items():
            cell = np.concatenate([np.array(cells, dtype=np.int32) for _, cells in own])
            at = np.array([at for at, _ in own], dtype=np.int32)
            at = np.repeat(at, [len(cells) for _, cells in own])
            # A visit to a cell that is cut goes to all its blocks.
            many = index.value.parts[cell]
            visit = np.repeat(np.arange(len(cell)), many)
            block = index.value.first[cell][visit] + np.arange(len(visit))
            block -= np.repeat(np.cumsum(many) - many, many)
            order = np.argsort(block, kind="stable")
            for places in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                mine = visit[places]
                out.append((chunk, block[places[0]], cell[mine].tobytes(), at[mine].tobytes()))
        return pd.DataFrame(out, columns=names)

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        visits, held, any_cut = {}, 0, False
        for batch in batches:
            columns = (batch[c] for c in ("_chunk", "_at", "_vector", "_limits", "_held"))
            for chunk, at, *anchor in zip(*columns):
                cells, cut = visited(*anchor)
                any_cut |= cut
                if cells:
                    visits.setdefault(chunk, []).append((at, cells))
                    held += int(index.value.parts[cells].sum())
                if held >= VISITS:
                    yield rows(visits)
                    visits, held = {}, 0
        yield rows(visits)
        if any_cut:
            yield pd.DataFrame([(-1, -1, b"", b"")], columns=names)

    return plan


def _searched(
    anchors: DataFrame,
    blocks: DataFrame,
    index: Broadcast,
    same: bool,
    count: int,
    low: int = 0,
    high: int = 0,
) -> DataFrame:
    """The certified best rows of ``anchors`` (stored; _anchor, _label, _vector, _limits): _anchor,
    _limit, _score, _id. Rounds go on until no anchor asks for a block and all walks ended."""
    spark, sizes = anchors.sparkSession, index.value.sizes
    number, width = anchors.count(), sum(words.shape[1] for words in index.value.words)
    chunks = max(1, -(-number // _rows(CHUNK, width)))
    at = F.row_number().over(Window.partitionBy("_chunk").orderBy("_anchor")) - 1
    anchors = anchors.withColumn("_chunk", F.pmod(F.xxhash64("_anchor"), F.lit(chunks)).cast("int"))
    anchors = kept(anchors.withColumn("_at", at.cast("int")), "chunks")
    tasks = max(1, -(-number * max(int((sizes > 0).sum()), width) // VISITS))
    best = spark.createDataFrame([], FOUND)
    begin, end, total = 0, FIRST, int(sizes.sum())
    while begin < total:
        if 2 * end >= total:  # a last round of few rows meets all blocks once more
            end = total
        full = best.groupBy("_anchor", "_limit").agg(
            F.count(F.lit(1)).alias("_count"), F.min("_score").alias("_score")
        )
        full = full.where(F.col("_count") >= count).groupBy("_anchor").agg(
            F.map_from_entries(F.collect_list(F.struct("_limit", "_score"))).alias("_full")
        )
        held = F.transform(
            "_limits", lambda x: F.coalesce(F.try_element_at("_full", x), F.lit(LEAST))
        )
        state = anchors.join(full, "_anchor", "left").withColumn("_held", held).drop("_full")
        plan = _planner(index, begin, end, same, low, high)
        asked = state.repartition(tasks, "_anchor").mapInPandas(plan, ASKED)
        asked = kept(asked, "asked")
        if asked.isEmpty():
            break
        asked = asked.where("_block >= 0")
        pairs = asked.select(*[F.col(k).alias(f"{k}_") for k in ("_chunk", "_block")]).distinct()
        packed = state.groupBy("_chunk").applyInPandas(_chunker(same, low, high), CHUNKED)
        wanted = blocks.join(pairs, F.col("_block") == F.col("_block_")).unionByName(
            pairs.join(packed, F.col("_chunk") == F.col("_chunk_")), allowMissingColumns=True
        )
        found = asked.groupBy("_chunk", "_block").cogroup(wanted.groupBy("_chunk_", "_block_"))
        found = found.applyInPandas(_searcher(same, count), FOUND)
        # A key that comes twice is one row; the better of its vectors counts.
        both = best.unionByName(found).repartition("_anchor", "_limit")
        both = both.groupBy("_anchor", "_limit", "_id").agg(F.max("_score").alias("_score"))
        order = Window.partitionBy("_anchor", "_limit").orderBy(F.desc("_score"), "_id")
        both = both.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= count)
        best = kept(both.select("_anchor", "_limit", "_score", "_id"), "best")
        begin, end = end, end * WIDER
    return best


def _whole(vector: Column, scale: int) -> Column:
    """Components times ``scale``, rounded down, cut to LARGEST in size."""
    return F.transform(
        vector,
        lambda x: F.greatest(
            F.least(F.floor(x.cast("double") * scale).cast("double"), F.lit(float(LARGEST))),
            F.lit(float(-LARGEST)),
        ),
    )


def built(rows: DataFrame, sample: int) -> tuple[DataFrame, Index | None]:
    """The index of ``rows`` (stored; _id, _label, _vector): its blocks, stored, and its numbers.

    Codebooks of each half are learned from the ``sample`` vectors that come first by hash, a
    bounded number; all rows are coded, and radii and sizes are taken over all rows. A cell of many
    rows is cut into blocks of its own, small cells that are neighbours share one.
    """
    spark = rows.sparkSession
    # Every task gives as many rows as are chosen, so it gives their places first, then vectors.
    place = F.struct(F.xxhash64("_vector").alias("hash"), F.col("_id").alias("id"))
    places = rows.select(place.alias("_place")).orderBy("_place").limit(sample)
    last = places.agg(F.max("_place")).first()[0]
    if last is None:
        return rows, None
    last = F.struct(F.lit(last["hash"]).alias("hash"), F.lit(last["id"]).alias("id"))
    chosen = rows.where(place <= last).orderBy(place).limit(sample).collect()
    learn = np.array([row["_vector"] for row in chosen], dtype=np.float64)
    half = learn.shape[1] // 2
    count = int(np.clip(np.sqrt(rows.count() / CELL), 2, MOST_WORDS))
    words = tuple(
        learned_words(part, count, seed)
        for seed, part in enumerate((learn[:, :half], learn[:, half:]))
    )
    shared = spark.sparkContext.broadcast(words)
    empty = [F.lit(0).alias("_cell"), *(F.lit(0.0).alias(f"_far_{k}") for k in (1, 2))]
    coded = rows.select("_id", "_label", "_vector", *empty).mapInPandas(_coder(half, shared), CODED)
    coded, number = numbered(coded)
    numbers = coded.groupBy("_cell").agg(
        F.count(F.lit(1)).alias("_size"), F.max("_far_1").alias("_1"), F.max("_far_2").alias("_2")
    )
    width = len(words[1])
    sizes = np.zeros(len(words[0]) * width, dtype=np.int64)
    radii = (np.zeros(len(words[0])), np.zeros(width))
    for row in numbers.collect():
        sizes[row["_cell"]] = row["_size"]
        for own, k, far in zip(radii, divmod(row["_cell"], width), (row["_1"], row["_2"])):
            own[k] = max(own[k], far)
    first, parts = _cut(sizes, _rows(BLOCK, learn.shape[1]))
    places = [(k, int(first[k]), int(parts[k])) for k in np.flatnonzero(sizes).tolist()]
    places = spark.createDataFrame(places, "_cell int, _first int, _parts int")
    block = F.col("_first") + F.pmod(F.xxhash64(number), F.col("_parts")).cast("int")
    placed = coded.join(F.broadcast(places), "_cell").select(
        block.alias("_block"), "_cell", "_id", "_label", "_vector"
    )
    blocks = kept(placed.groupBy("_block").applyInPandas(_gathered, BLOCKED), "blocks")
    return blocks, Index(half, words, radii, sizes, first, parts)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    sample: int = SAMPLE,
) -> DataFrame:
    """For each anchor its ``positives`` best rows of the same label, and for each of these the
    ``negatives`` best rows of other labels whose score is ``low`` to ``high`` hundredths of the
    positive's: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A row's score is its inner product with the anchor; components are multiplied by ``scale`` and
    rounded down first, and cut at 2**27 in size. Higher scores come first, ties by smaller key.
    All results are certified by the index's bounds, none is approximate. Cells whose bounds say
    nothing, as of random vectors, are all visited; then the work is anchors times rows, in blocks.

    Rows with a NULL key, label or vector, with a NULL or non-finite component, or of another width
    than most rows (ties to the larger) take no part. Of rows alike in key each is a candidate, one
    answer, with the better vector; as an anchor the one with the smallest label and vector counts;
    none of them is its own answer. Fewer rows give fewer answers, an empty table none. Other
    columns are ignored.
    """
    spark = rows.sparkSession
    component = F.exists(
        F.col(f"`{vector}`"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    used = rows.select(
        F.col(f"`{key}`").cast("long").alias("_id"),
        F.col(f"`{label}`").cast("long").alias("_label"),
        F.when(~component, _whole(F.col(f"`{vector}`"), scale)).alias("_vector"),
        is_anchor.alias("_asked"),
    ).where("_id IS NOT NULL AND _label IS NOT NULL AND _vector IS NOT NULL")
    used = kept(used, "vectors")
    widths = used.groupBy(F.size("_vector").alias("_width")).count()
    width = widths.where("_width > 0").orderBy(F.desc("count"), F.desc("_width")).first()
    used = used.where(F.size("_vector") == (width["_width"] if width else 0))
    blocks, index = built(used.drop("_asked"), sample)
    result = (
        "anchor_id long, positive_id long, rank int, negative_id long,"
        " positive_score long, negative_score long"
    )
    if index is None:
        return spark.createDataFrame([], result)
    shared = spark.sparkContext.broadcast(index)
    anchors = used.where("_asked").groupBy(F.col("_id").alias("_anchor")).agg(
        F.min(F.struct("_label", "_vector")).alias("_one")
    )
    anchors = kept(anchors.select("_anchor", "_one.*", F.array(F.lit(0).cast("long")).alias("_limits")), "anchors")
    near = _searched(anchors, blocks, shared, True, positives)
    limits = near.groupBy("_anchor").agg(F.collect_set("_score").alias("_limits"))
    bounded = kept(anchors.drop("_limits").join(limits, "_anchor"), "limits")
    far = _searched(bounded, blocks, shared, False, negatives, low, high)
    order = Window.partitionBy("_anchor", "_limit").orderBy(F.desc("_score"), "_id")
    far = far.select(
        "_anchor",
        "_limit",
        F.row_number().over(order).alias("rank"),
        F.col("_id").alias("negative_id"),
        F.col("_score").alias("negative_score"),
    )
    near = near.select("_anchor", F.col("_score").alias("_limit"), F.col("_id").alias("positive_id"))
    return near.join(far, ["_anchor", "_limit"]).select(
        F.col("_anchor").alias("anchor_id"),
        "positive_id",
        "rank",
        "negative_id",
        F.col("_limit").alias("positive_score"),
        "negative_score",
    )
