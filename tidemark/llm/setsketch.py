"""MinHash near-dedup with SetSketch registers: banded, estimated jointly, then verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tidemark.llm.common import first_by_hash, free_name, kept, numbered, texts, utf8
from tidemark.llm.simhash import components
from tidemark.llm.tokens import SLICE, mixed, runs, slices, words_of

SPACE = b" \t\n\x0b\x0c\r"
SHINGLE = 2
# Registers of a sketch: minima of exponential values of rate RATE, kept as powers of BASE in a
# byte. BANDS bands of BAND registers are compared: two sets with a similarity of 0.8 miss each
# other in all of them with a probability under 1e-6.
BASE = 1.2
RATE = 20.0
BAND = 6
BANDS = 40
REGISTERS = BAND * BANDS
# A pair goes on unless the best similarity that links is less likely than the best one at all by
# this many nats, which a linked pair reaches with a probability under 1e-9.
NATS = 20.0
GRID = 101
# Leaders of a bucket, which are compared with all its members. Among what is left, a cell of
# WIDER times as many members is compared pair by pair.
LEADERS = 4
WIDER = 16

SKETCH = StructType(
    [
        StructField("n", LongType()),
        StructField("high", LongType()),
        StructField("low", LongType()),
        StructField("registers", BinaryType()),
    ]
)

_salts = mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(values: list[bytes], count: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct hashes of ``count`` words in a row of every text.

    Fewer words are one shingle, the whole sequence; none give an empty set.
    """
    out = []
    for _, part in slices(values):
        words = words_of(part, SPACE)
        ends = np.searchsorted(words.texts, np.arange(len(part) + 1))
        for begin, end in zip(ends[:-1], ends[1:]):
            size = min(count, end - begin)
            own = runs(words.hashes[begin:end], size, size) if size else words.hashes[:0]
            out.append(np.unique(own))
    return out


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set: for each register the largest of its elements' values, where a value
    is 1 minus the logarithm of an exponential number, rounded down and cut to a byte.

    Sketches of two sets merge to that of their union by the larger of each register.
    """
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(hashes), 512):
        x = (hashes[start : start + 512, None] ^ _salts) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        np.minimum(least, x.min(axis=0), out=least)
    # The least of uniform numbers gives the least of the exponential ones.
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, 255).astype(np.uint8)


def plausible(
    a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int
) -> np.ndarray:
    """Whether two sketched sets of known sizes may have a similarity of ``percent`` or more.

    Their registers are larger, smaller or equal with probabilities that follow from sizes and
    similarity; the likelihood of the counts is taken over a grid of similarities.
    """
    more = (a > b).sum(axis=1)[:, None]
    less = (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u, v = (n_a / (n_a + n_b))[:, None], (n_b / (n_a + n_b))[:, None]
    most = np.minimum(u / v, v / u)
    asked = percent / 100
    enough = (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b))[:, None]

    def likelihood(similarity: np.ndarray) -> np.ndarray:
        up, down = (
            -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
            for x in (u - v * similarity, v - u * similarity)
        )
        logs = (np.log(np.clip(p, 1e-12, 1)) for p in (up, down, 1 - up - down))
        return sum(count * log for count, log in zip((more, less, same), logs))

    steps = np.linspace(0, 1, GRID)[None, :]
    best = likelihood(steps * most).max(axis=1)
    linked = likelihood(np.minimum(asked + steps * np.maximum(most - asked, 0), most)).max(axis=1)
    return enough[:, 0] & (linked >= best - NATS)


@F.pandas_udf(SKETCH)
def _sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    from xxhash import xxh3_128_intdigest

    for batch in batches:
        rows = []
        for own in shingles([utf8(text) for text in texts(batch)]):
            digest = xxh3_128_intdigest(own.tobytes())
            halves = np.array([digest >> 64, digest & (1 << 64) - 1], np.uint64).view(np.int64)
            held = registers(own).tobytes() if len(own) else None
            rows.append((len(own), int(halves[0]), int(halves[1]), held))
        yield pd.DataFrame(rows, columns=SKETCH.names)


@F.pandas_udf(ArrayType(LongType()))
def _set(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        sets = shingles([utf8(text) for text in texts(batch)])
        yield pd.Series([own.view(np.int64) for own in sets], dtype=object)


def _plausible(percent: int):
    @F.pandas_udf("boolean")
    def of(a: pd.Series, b: pd.Series, n_a: pd.Series, n_b: pd.Series) -> pd.Series:
        out = []
        for start in range(0, len(a), 1024):
            part = slice(start, start + 1024)
            sides = [np.frombuffer(b"".join(x.iloc[part]), np.uint8) for x in (a, b)]
            sizes = [x.iloc[part].to_numpy(np.float64) for x in (n_a, n_b)]
            sides = [side.reshape(-1, REGISTERS) for side in sides]
            out.append(plausible(*sides, *sizes, percent))
        return pd.Series(np.concatenate(out) if out else np.zeros(0, bool))

    return of


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (_a, _b) whose full sets are alike enough."""
    for side in ("_a", "_b"):
        own = sets.select(F.col("_id").alias(side), F.col("_set").alias(f"{side}_set"))
        pairs = pairs.join(own, side)
    shared = F.size(F.array_intersect("_a_set", "_b_set")).cast("long")
    union = F.size("_a_set") + F.size("_b_set") - shared
    return pairs.where(100 * shared >= percent * union).select("_a", "_b").distinct()


def _estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (_a, _b) that may be alike enough by their registers; stored."""
    for side in ("_a", "_b"):
        own = reps.select(
            F.col("_id").alias(side),
            F.col("_registers").alias(f"{side}_registers"),
            F.col("_n").alias(f"{side}_n"),
        )
        pairs = pairs.join(own, side)
    alike = _plausible(percent)("_a_registers", "_b_registers", "_a_n", "_b_n")
    return kept(pairs.where(alike).select("_a", "_b"), "pairs")


def near_roots(reps: DataFrame, docs: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """_node, _root for the sets of ``reps`` (stored; _id, _n, _registers, _key, _hash) that are
    connected to a smaller one, over links of sets that share a band and are ``percent`` alike.

    Members of a bucket are not compared all with all. First some leaders of a bucket are compared
    with all its members, which connects most near copies. A bucket whose members are all connected
    then, or that has only one member besides its leaders, is done. The members of the others are
    taken together over the buckets they share, and `_candidates` names the pairs that are left.
    Whatever pair is named goes through the registers and is counted on full sets. A hot bucket is
    the large side of a join whose other side has its leaders, so adaptive execution splits it.
    """
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.xxhash64(k, F.substring(F.col("_registers"), k * BAND + 1, F.lit(BAND))),
    )
    members = reps.select("_id", "_n", F.explode(bands).alias("_bucket"))
    shared = members.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_members"))
    members = kept(members.join(shared.where("_members > 1"), "_bucket"), "members")
    first = members.select("_bucket", F.struct("_id", "_n").alias("_one"))
    first = first_by_hash(first, "_bucket", "_one", LEADERS).select("_bucket", "_one.*")
    other = members.select("_bucket", F.col("_id").alias("_other"), F.col("_n").alias("_other_n"))
    able = 100 * F.least("_n", "_other_n") >= percent * F.greatest("_n", "_other_n")
    pairs = first.join(other, "_bucket").where(F.col("_id") != F.col("_other")).where(able)
    pairs = _estimated(pairs.select(*_ordered("_id", "_other")).distinct(), reps, percent)
    both = pairs.select(F.col("_a").alias("_id")).union(pairs.select("_b")).distinct()
    found = _verified(pairs, _sets(both, reps, docs, key, text), percent)
    roots = kept(components(kept(found, "found")), "roots")

    members = members.where(F.col("_members") > LEADERS + 1).drop("_members")
    members = _named(members.withColumn("_root", F.col("_id")), "_root", roots)
    apart = members.groupBy("_bucket").agg(
        F.min("_root").alias("_first"), F.max("_root").alias("_last")
    )
    members = kept(members.join(apart.where("_first < _last"), "_bucket"), "members")
    if members.isEmpty():
        return roots
    sets = _sets(members.select("_id").distinct(), reps, docs, key, text)
    pairs = _estimated(_candidates(members, sets, percent), reps, percent)
    found = kept(_verified(pairs, sets, percent), "found")
    if found.isEmpty():
        return roots
    newer = components(_named(_named(found, "_a", roots), "_b", roots))
    older = _named(roots, "_root", newer.toDF("_from", "_to"))
    return kept(older.select("_node", "_root").unionByName(newer), "roots")


def _ordered(one: str, other: str) -> list[Column]:
    return [F.least(one, other).alias("_a"), F.greatest(one, other).alias("_b")]


def _named(rows: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    """``rows`` with every ``column`` that has a root replaced by it."""
    own = roots.toDF("_from", "_to")
    found = rows.join(own, F.col(column) == F.col("_from"), "left")
    return found.withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")


def _candidates(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Different pairs (_a, _b) that connect all that links between ``members`` (_id, _n, _root,
    and _bucket, which has _first, its smallest root) connect; few others.

    Members connected over buckets are a cell. A set is kept as what tells it from the usual set
    of its cell (the shingles that more than half of the cell have): the difference of two sets is
    that of what is kept of them. A pair is linked if its difference is at most
    (100 - percent) / (100 + percent) of the sum of its sizes; in (100 + percent)ths, _over is what
    a set's distance from the usual one is above its part of that, so a pair is linked exactly if
    its two _over sum up to no more than 2 * (100 + percent) for each shingle kept of both.

    - Sets whose _over and the least one are not above 0 together are all linked to the set with
      the least: one pair each. Only pairs with a set that is not connected to that one then,
      an _outer one, are still of use.
    - Such a pair has a shingle kept of both. Sets that keep too few in common with others leave;
      then shingles that only one set keeps, or no outer one, are only counted. The others are
      ordered by how few keep them, and as many of the last are left out as a set must have in
      common with a partner, less one: a pair still meets in one of the rest.

    Who keeps the same shingle is a new cell. One of at most WIDER times as many members as a bucket
    has leaders gives its pairs; a larger one goes on in the same way, with a usual set of its own.
    A kept shingle is one of half of a cell at most, so every time cells are halved at least.
    """
    edges = members.select(F.col("_root").alias("_a"), F.col("_first").alias("_b")).distinct()
    rows = members.select("_id", "_n", "_root", F.col("_root").alias("_cell")).distinct()
    rows = _named(rows, "_cell", components(edges)).join(sets, "_id")
    rows = rows.withColumn("_own", F.lit(0).cast("long")).withColumnRenamed("_set", "_kept")
    whole, step = 2 * (100 + percent), LEADERS * WIDER
    out = None
    while True:
        rows = kept(rows, "cells")
        if rows.isEmpty():
            return out.distinct()
        rows = kept(_differing(rows), "differing")
        count = F.size("_kept").cast("long")
        rows = rows.withColumn(
            "_over", (100 + percent) * (F.col("_own") + count) - (100 - percent) * F.col("_n")
        )
        best = rows.groupBy("_cell").agg(F.min(F.struct("_over", "_id", "_root")).alias("_best"))
        rows = rows.join(best, "_cell").join(_alone(rows), ["_cell", "_id"], "left")
        near = F.col("_over") + F.col("_best._over") <= 0
        apart = F.col("_root") != F.col("_best._root")
        # A pair is linked only if the _over of each is in the _reach of the other.
        common = count - F.coalesce("_alone", F.lit(0))
        rows = rows.withColumn("_reach", whole * common - F.col("_over")).drop("_alone")
        rows = rows.withColumn("_joins", near & apart).withColumn("_outer", ~near & apart)
        root = F.when(F.col("_outer"), F.col("_root")).otherwise(F.col("_best._root"))
        rows = kept(rows.withColumn("_root", root), "marked")
        linked = rows.where("_joins").select("_id", F.col("_best._id").alias("_other"))
        rows = kept(_shared(kept(_able(rows), "able")), "apart")
        count = F.size("_kept").cast("long")
        rows = _able(rows.withColumn("_reach", whole * count - F.col("_over")))
        least = F.when(F.col("_outer"), F.col("_best._over")).otherwise(F.col("_low"))
        needed = F.greatest(F.ceil((F.col("_over") + least) / whole), F.lit(1)).cast("int")
        head = F.slice("_kept", F.lit(1), F.size("_kept") - needed + 1)
        rows = rows.withColumn("_head", F.when(F.size("_kept") >= needed, head))
        parts = rows.select(
            F.explode("_head").alias("_shingle"), "_cell", "_id", "_root", "_over", "_reach"
        )
        parts = kept(parts, "parts")
        sizes = parts.groupBy("_cell", "_shingle").agg(
            F.count(F.lit(1)).alias("_size"),
            F.min("_root").alias("_least"),
            F.max("_root").alias("_most"),
        )
        sizes = kept(sizes.where("_least < _most").drop("_least", "_most"), "sizes")
        few = parts.join(sizes.where(F.col("_size") <= step), ["_cell", "_shingle"])
        other = few.select(
            "_cell", "_shingle",
            *[F.col(x).alias(f"_other{x}") for x in ("_id", "_root", "_over", "_reach")],
        )
        pairs = few.join(other, ["_cell", "_shingle"]).where(
            (F.col("_id") < F.col("_other_id"))
            & (F.col("_root") != F.col("_other_root"))
            & (F.col("_over") <= F.col("_other_reach"))
            & (F.col("_other_over") <= F.col("_reach"))
        )
        pairs = pairs.select("_id", F.col("_other_id").alias("_other")).unionByName(linked)
        pairs = kept(pairs.select(*_ordered("_id", "_other")).distinct(), "named")
        out = pairs if out is None else out.unionByName(pairs)
        many = parts.join(sizes.where(F.col("_size") > step), ["_cell", "_shingle"])
        many = many.select("_cell", "_id", "_root", F.xxhash64("_cell", "_shingle").alias("_part"))
        held = rows.select("_cell", "_id", "_n", "_own", "_kept")
        rows = many.join(held, ["_cell", "_id"]).drop("_cell").withColumnRenamed("_part", "_cell")


def _differing(rows: DataFrame) -> DataFrame:
    """``rows`` (stored; _cell, _kept, others) with what is not the same in _kept and in the
    usual shingles of its _cell, as _kept."""
    each = rows.select("_cell", F.explode("_kept").alias("_shingle"))
    often = each.groupBy("_cell", "_shingle").agg(F.count(F.lit(1)).alias("_sets"))
    sizes = rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("_size"))
    usual = often.where("_sets > 1").join(sizes, "_cell").where("2 * _sets > _size")
    usual = usual.groupBy("_cell").agg(F.collect_list("_shingle").alias("_usual"))
    rows = rows.join(usual, "_cell", "left")
    differing = F.concat(F.array_except("_kept", "_usual"), F.array_except("_usual", "_kept"))
    return rows.withColumn("_kept", F.coalesce(differing, "_kept")).drop("_usual")


def _alone(rows: DataFrame) -> DataFrame:
    """_cell, _id and how many shingles no other row of the cell keeps: _alone, if there are any."""
    each = rows.select("_cell", "_id", F.explode("_kept").alias("_shingle"))
    often = each.groupBy("_cell", "_shingle").agg(
        F.count(F.lit(1)).alias("_sets"), F.min("_id").alias("_id")
    )
    often = often.where("_sets = 1")
    return often.groupBy("_cell", "_id").agg(F.count(F.lit(1)).alias("_alone"))


def _able(rows: DataFrame) -> DataFrame:
    """``rows`` (_cell, _best, _over, _reach, _outer, others) without those that can not be linked
    to any other one, with the least _over of those of the cell that are _outer: _low."""
    rows = rows.drop("_low")
    rows = rows.join(rows.groupBy("_cell").agg(F.max("_reach").alias("_far")), "_cell")
    able = (F.col("_over") <= F.col("_far")) & (F.col("_best._over") <= F.col("_reach"))
    rows = rows.where(~F.col("_outer") | able).drop("_far")
    outer = rows.where("_outer").groupBy("_cell").agg(
        F.min("_over").alias("_low"), F.max("_reach").alias("_high")
    )
    rows = rows.join(outer, "_cell")
    able = (F.col("_over") <= F.col("_high")) & (F.col("_low") <= F.col("_reach"))
    return rows.where(F.col("_outer") | able).drop("_high")


def _shared(rows: DataFrame) -> DataFrame:
    """``rows`` (stored; _cell, _id, _kept, _own, _outer, others) with in _kept only what several
    rows of the cell keep, one with _outer among them, rarest first; the rest is added to _own."""
    each = rows.select("_cell", "_id", "_outer", F.explode("_kept").alias("_shingle"))
    often = each.groupBy("_cell", "_shingle").agg(
        F.count(F.lit(1)).alias("_sets"), F.max("_outer").alias("_any")
    )
    often = often.where("_any and _sets > 1").drop("_any")
    each = each.drop("_outer").join(often, ["_cell", "_shingle"])
    several = each.groupBy("_cell", "_id").agg(
        F.sort_array(F.collect_list(F.struct("_sets", "_shingle"))).alias("_several")
    )
    rows = rows.join(several, ["_cell", "_id"], "left")
    none = F.array().cast("array<bigint>")
    several = F.coalesce(F.col("_several._shingle"), none)
    own = F.col("_own") + F.size("_kept") - F.size(several)
    return rows.withColumn("_own", own).withColumn("_kept", several).drop("_several")


def _sets(needed: DataFrame, reps: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The full sets (_id, _set) of the different _id ``needed``, from the texts; stored."""
    places = reps.join(needed, "_id").select("_id", "_key", F.col("_hash").alias("_text_hash"))
    rows = docs.select(
        F.col(f"`{key}`").alias("_own"),
        F.col(f"`{text}`").alias("_text"),
        F.xxhash64(F.col(f"`{text}`")).alias("_text_hash"),
    )
    same = F.col("_own").eqNullSafe(F.col("_key"))
    rows = rows.join(places, "_text_hash").where(same).select("_id", "_text")
    return kept(rows.select("_id", _set("_text").alias("_set")), "sets")


def with_near_group(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = 80,
    out: str = "near",
) -> DataFrame:
    """The rows of ``docs`` without ``text``, with ``out``: struct of n (distinct shingles) and
    group (the smallest non-NULL ``key`` reachable over links, the row's own included).

    Two texts are linked if the intersection of their sets is at least ``percent`` hundredths of
    the union, counted on the full sets, as 64-bit hashes of the shingles. Texts without a word
    (NULL, empty) have n 0, are linked with nothing and are their own group. Equal sets, however
    many rows have them, are compared once. Rows alike in all columns stay; a group none of whose
    rows has a key is NULL; an empty table gives no rows. Other columns stay; one named ``out`` is
    replaced. A link is missed if no band agrees, with a probability under 1e-6.
    """
    names = [name for name in docs.columns if name not in (text, out)]
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("_rest"),
        F.col(f"`{key}`").alias("_key"),
        F.xxhash64(F.col(f"`{text}`")).alias("_hash"),
        _sketch(F.col(f"`{text}`")).alias("_sketch"),
    )
    rows = kept(rows.select("_rest", "_key", "_hash", "_sketch.*"), "sketches")
    sets = rows.where("n > 0").groupBy("high", "low").agg(
        F.min("_key").alias("_least"),
        F.min(F.struct("n", "registers", "_key", "_hash")).alias("_one"),
    )
    sets, number = numbered(sets)
    reps = sets.select(
        F.col(number).alias("_id"),
        F.col("_one.n").alias("_n"),
        F.col("_one.registers").alias("_registers"),
        F.col("_one._key").alias("_key"),
        F.col("_one._hash").alias("_hash"),
    )
    roots = near_roots(reps, docs, key, text, percent)
    named = sets.join(roots, F.col(number) == F.col("_node"), "left").select(
        "high", "low", "_least", F.coalesce("_root", number).alias("_root")
    )
    least = named.groupBy("_root").agg(F.min("_least").alias("_group"))
    groups = named.join(least, "_root").select("high", "low", "_group", F.lit(True).alias("_found"))
    marked = rows.join(groups, ["high", "low"], "left")
    group = F.when(F.col("_found"), F.col("_group")).otherwise(F.col("_key"))
    return marked.select("_rest.*", F.struct("n", group.alias("group")).alias(out))
