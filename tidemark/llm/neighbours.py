"""Approximate nearest neighbours: multi-index hashing of learned rotated binary codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidemark.llm.common import kept, popcount

# A code is the signs of the vector after learned rotations, BITS in all.
BITS = 64
# Bounds: vectors that rotations are learned from, those of them whose distances are counted,
# codes in an index, queries that are asked of an index at once.
SAMPLE = 4_000
PAIRED = 512
BLOCK = 32_768
QUERIES = 1_024
ITERATIONS = 8
# The first radius is expected to hold this many times the vectors that are wanted.
SPARE = 4
# A search ends this many standard deviations beyond the distance of codes whose vectors are as
# far apart as the last one found, and goes on by at least STEP bits.
MARGIN = 2.0
STEP = 8

HIT = StructType(
    [
        StructField("query_id", LongType()),
        StructField("vec_id", LongType()),
        StructField("score", DoubleType()),
    ]
)


@dataclass
class Codes:
    mean: np.ndarray
    rotation: np.ndarray  # width x BITS

    def of(self, units: np.ndarray) -> np.ndarray:
        """Codes of unit vectors, as 64-bit words."""
        bits = (units - self.mean) @ self.rotation > 0
        return np.packbits(bits, axis=1).view(np.uint64).reshape(-1)


def learned(units: np.ndarray, width: int, seed: int = 11) -> Codes:
    """Rotations that bring the sample near the corners of a cube: from a random start, turns
    between rounding to signs and the best rotation towards those signs."""
    rng = np.random.default_rng(seed)
    mean = units.mean(axis=0) if len(units) else np.zeros(width)
    centred = units - mean
    turns = []
    for _ in range(-(-BITS // width)):
        turn = np.linalg.qr(rng.normal(size=(width, width)))[0]
        for _ in range(ITERATIONS if len(units) else 0):
            left, _, right = np.linalg.svd(centred.T @ np.sign(centred @ turn))
            turn = left @ right
        turns.append(turn)
    return Codes(mean, np.concatenate(turns, axis=1)[:, :BITS])


@cache
def flips(size: int) -> tuple[np.ndarray, np.ndarray]:
    """All masks of ``size`` bits, those with fewer bits first, and how many have at most 0, 1,
    2 ... bits."""
    masks = np.arange(1 << size, dtype=np.int64)
    counts = popcount(masks)
    return masks[np.argsort(counts, kind="stable")], np.cumsum(np.bincount(counts))


def substrings(codes: int) -> list[tuple[int, int]]:
    """Where (first bit, size) a code is split so that an index of ``codes`` codes has about as
    many substrings as codes; sizes differ by one at most, none has more than 16 bits."""
    size = min(16, max(4, (max(codes, 1) - 1).bit_length()))
    parts = -(-BITS // size)
    edges = [BITS * t // parts for t in range(parts + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


class Index:
    """The codes of one block of vectors, indexed by each of their substrings."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.parts = substrings(len(codes))
        self.orders, self.starts = [], []
        for low, size in self.parts:
            keys = self._substring(codes, low, size)
            self.orders.append(np.argsort(keys, kind="stable").astype(np.int32))
            self.starts.append(np.concatenate([[0], np.cumsum(np.bincount(keys, minlength=1 << size))]))

    @staticmethod
    def _substring(codes: np.ndarray, low: int, size: int) -> np.ndarray:
        return ((codes >> np.uint64(low)) & np.uint64((1 << size) - 1)).astype(np.int64)

    def probed(self, code: np.uint64, radius: int) -> np.ndarray:
        """The codes (their places) met by probing every index around ``code``.

        A code within ``radius`` bits differs by at most radius // parts bits in one of the
        first radius % parts + 1 substrings, or by one fewer in one of the others: if not, the
        differences of all substrings would add up to more. So none within is missed.
        """
        each, over = divmod(radius, len(self.parts))
        seen = np.zeros(len(self.codes), dtype=bool)
        for t, (low, size) in enumerate(self.parts):
            most = each if t <= over else each - 1
            if most < 0:
                continue
            masks, counts = flips(size)
            keys = self._substring(code, low, size) ^ masks[: counts[min(most, size)]]
            begin, end = self.starts[t][keys], self.starts[t][keys + 1]
            held = np.flatnonzero(end > begin)
            begin, sizes = begin[held], (end - begin)[held]
            places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - begin, sizes)
            seen[self.orders[t][places]] = True
        return np.flatnonzero(seen)

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """The codes (their places) that differ from ``code`` by at most ``radius`` bits."""
        near = self.probed(code, radius)
        return near[popcount(self.codes[near] ^ code) <= radius]


def first_radius(codes: np.ndarray, total: int, wanted: int) -> int:
    """The least radius that holds ``wanted`` of ``total`` codes around a usual one, as far as
    the distances within a sample of them tell; all bits if none does."""
    if len(codes) < 2:
        return BITS
    counts = np.zeros(BITS + 1)
    for code in codes[:PAIRED]:
        counts += np.bincount(popcount(codes ^ code), minlength=BITS + 1)
    counts[0] -= min(PAIRED, len(codes))
    share = np.cumsum(counts) / counts.sum() if counts.sum() else np.ones(BITS + 1)
    return int(np.argmax(share * total >= wanted)) if share[-1] * total >= wanted else BITS


def reach(score: Column) -> Column:
    """The bits by which codes differ whose vectors have a cosine of at least ``score``, with a
    margin for what codes blur."""
    turned = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score))) / np.pi
    spread = F.sqrt(F.greatest(F.lit(1.0), BITS * turned * (1 - turned)))
    return F.least(F.lit(BITS), F.ceil(BITS * turned + MARGIN * spread).cast("int"))


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def _usable(vector: Column) -> Column:
    """Vectors that take part: finite throughout, of some length, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _coder(codes: Broadcast):
    @F.pandas_udf(LongType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            vectors = np.array(batch.tolist(), dtype=np.float64).reshape(len(batch), -1)
            units = vectors / _norms(vectors)[:, None] if len(batch) else vectors
            found = codes.value.of(units) if len(batch) else np.zeros(0, np.uint64)
            yield pd.Series(found.view(np.int64))

    return of


def _searcher(count: int):
    def search(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if block.empty or asked.empty:
            return pd.DataFrame({name: [] for name in HIT.names}).astype("int64")
        ids = block["_id"].to_numpy(dtype=np.int64)
        vectors = np.stack(block["_vector"].to_numpy()).astype(np.float64)
        norms = _norms(vectors)
        index = Index(block["_code"].to_numpy(dtype=np.int64).view(np.uint64))
        out = []
        columns = (asked[name].to_numpy() for name in ("_id", "_vector", "_code", "_radius"))
        for query_id, query, code, radius in zip(*columns):
            query = np.asarray(query, dtype=np.float64)
            near = index.within(np.int64(code).view(np.uint64), int(radius))
            near = near[ids[near] != query_id]
            # Row by row, so equal vectors have equal scores wherever they stand.
            scores = (vectors[near] * query).sum(axis=1)
            scores /= norms[near] * _norms(query[None, :])[0]
            # A key that comes twice is one candidate; the better of its vectors counts.
            order = np.lexsort((ids[near], -scores))
            _, once = np.unique(ids[near][order], return_index=True)
            top = order[np.sort(once)[:count]]
            out.append((np.full(len(top), query_id), ids[near][top], scores[top]))
        parts = [np.concatenate(column) for column in zip(*out)]
        return pd.DataFrame(dict(zip(HIT.names, parts)))

    return search


def _round(index: DataFrame, asked: DataFrame, blocks: int, count: int) -> DataFrame:
    """The ``count`` best of what lies within the radius of every query, best first: query_id,
    _found (array of score and vec_id)."""
    chunks = max(1, -(-asked.count() // QUERIES))
    chunk = F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(chunks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    left = index.select("_block", every.alias("_chunk"), "_id", "_vector", "_code")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    right = asked.select(every.alias("_block"), chunk.alias("_chunk"), "_id", "_vector", "_code", "_radius")
    keys = ("_block", "_chunk")
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_searcher(count), HIT)
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= count)
    entry = F.struct((-F.col("score")).alias("less"), "vec_id")
    return best.groupBy("query_id").agg(F.sort_array(F.collect_list(entry)).alias("_found"))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    count: int = 5,
    sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """For every row with ``is_query`` its ``count`` nearest others by cosine: query_id, rank,
    vec_id, score.

    Vectors that are NULL, zero, of another width than most usable rows of the table (ties to
    the larger) or hold NULL or non-finite components take no part; nor do rows without a key. Of
    queries alike in key the smallest vector asks; of other rows alike in key the nearest counts.
    Ties go to the smaller key. Fewer others than ``count`` give fewer rows; an empty table gives
    none. Other columns are ignored.

    Rotations are learned from the ``sample`` vectors that come first by hash. Every vector is
    coded once; blocks of about ``block`` codes are indexed in the tasks that search them. In a
    round every query gets all codes within its radius, by probing, and ranks them by their
    floats. A query is done if codes as near as its last one found lie within its radius, with
    MARGIN deviations to spare; else the next round goes that far. The radius belongs to the
    query, not to the block, so results do not depend on how rows are laid out. Queries stay in
    tables and meet blocks in groups of bounded size; what a task returns is ``count`` rows for
    each query of its group.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(key).cast("long").alias("_id"),
        F.col(vector).cast("array<double>").alias("_vector"),
        is_query.alias("_asked"),
    )
    rows = rows.where(F.col("_id").isNotNull() & _usable(F.col("_vector")))
    widths = rows.groupBy(F.size("_vector").alias("_width")).count()
    most = widths.orderBy(F.desc("count"), F.desc("_width")).first()
    width, total = (most["_width"], most["count"]) if most else (1, 0)
    rows = rows.where(F.size("_vector") == width)
    chosen = rows.orderBy(F.xxhash64("_id"), "_id", "_vector").limit(sample).collect()
    learn = np.array([row["_vector"] for row in chosen], dtype=np.float64).reshape(-1, width)
    units = learn / _norms(learn)[:, None]
    codes = learned(units, width)
    coder = _coder(spark.sparkContext.broadcast(codes))
    coded = rows.withColumn("_code", coder("_vector"))
    blocks = max(1, -(-total // block))
    # By row, so that a key with many rows is spread.
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    index = kept(coded.withColumn("_block", place), "codes")
    # A query's own row may be among what it finds.
    radius = first_radius(codes.of(units), total, SPARE * (count + 1))
    asked = index.where("_asked").groupBy("_id").agg(F.min(F.struct("_vector", "_code")).alias("_own"))
    asked = kept(asked.select("_id", "_own.*", F.lit(radius).alias("_radius")), "queries")
    results = []
    while not asked.isEmpty():
        found = _round(index, asked, blocks, count)
        left = asked.join(found, F.col("_id") == F.col("query_id"), "left").drop("query_id")
        last = -F.element_at("_found", count)["less"]
        farther = F.least(F.col("_radius") + STEP, F.lit(BITS))
        needed = F.when(F.size("_found") == count, reach(last)).otherwise(farther)
        left = kept(left.withColumn("_needed", F.coalesce(needed, farther)), "round")
        done = (F.col("_needed") <= F.col("_radius")) | (F.col("_radius") >= BITS)
        results.append(left.where(done).select("_id", "_found"))
        asked = left.where(~done).select("_id", "_vector", "_code", F.col("_needed").alias("_radius"))
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    whole = results[0]
    for result in results[1:]:
        whole = whole.unionByName(result)
    whole = whole.select(F.col("_id").alias("query_id"), F.posexplode("_found").alias("_place", "_hit"))
    return whole.select(
        "query_id",
        (F.col("_place") + 1).alias("rank"),
        F.col("_hit.vec_id").alias("vec_id"),
        (-F.col("_hit.less")).alias("score"),
    )
