"""SimHash near-duplicates: binary trie self-join of fingerprints, and their components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructField, StructType

from tidemark.llm.common import free_name, kept, popcount, texts, utf8

SEED = 42
BITS = 64
HALF = 32
# Depth at which fingerprints are counted to cut the trie into subtrees for tasks, and the bits
# by which a crowded prefix is followed further down each time.
TOP = 16
STEP = 4
# The largest subtree.
SUBTREE = 32_768
# Pairs of nodes held at once, and pairs of fingerprints at which a pair of nodes is resolved.
FRONTIER = 1 << 18
RESOLVED = 64

LINKS = StructType([StructField("_a", LongType()), StructField("_b", LongType())])
PLACED = StructType([StructField("_subtree", LongType()), StructField("_print", LongType())])
ROUTED = StructType(
    [
        StructField("_pair", LongType()),
        StructField("_second", BooleanType()),
        StructField("_block", BinaryType()),
    ]
)


def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned fingerprint: the bits set in over half the hashes of all word shingles.

    A-Z are lowered, words are split at ASCII white space; fewer words than a shingle are one
    shingle, none give zero. Hashes are counted in pieces, so long texts stay in bounds.
    """
    words = utf8(text).lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words])
    starts = (ends - [len(word) + 1 for word in words]).tolist()
    ends = (ends - 1).tolist()
    count = max(1, len(words) - shingle + 1)
    width = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    totals = np.zeros(BITS, dtype=np.int64)
    for begin in range(0, count, 4096):
        stop = min(count, begin + 4096)
        hashes = np.array(
            [digest(joined[starts[i] : ends[i + width]], SEED) for i in range(begin, stop)],
            dtype=">u8",
        )
        totals += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(totals * 2 > count).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str, out: str, shingle: int) -> DataFrame:
    """``docs`` with ``out``: the fingerprint of the whole text as a signed long. NULL and
    wordless texts have fingerprint zero."""

    @F.pandas_udf(LongType())
    def prints(batch: pd.Series) -> pd.Series:
        found = [fingerprint(value, shingle) for value in texts(batch)]
        return pd.Series(np.array(found, dtype=np.uint64).view(np.int64))

    return docs.withColumn(out, prints(F.col(f"`{text}`")))


def _subtrees(counts: np.ndarray, largest: int, root: tuple[int, int] = (0, 0)) -> list[tuple]:
    """(node, size) at which the trie below ``root`` is cut: every path meets exactly one.

    A node is (depth, prefix). ``counts`` holds the fingerprints of each of the root's lowest
    nodes, whose size may still be over ``largest``.
    """
    levels = len(counts).bit_length() - 1
    cut: list[tuple] = []
    open_nodes = [(0, 0)]
    sums = np.concatenate([[0], np.cumsum(counts)])
    while open_nodes:
        depth, prefix = open_nodes.pop()
        width = 1 << (levels - depth)
        size = int(sums[(prefix + 1) * width] - sums[prefix * width])
        if size > largest and depth < levels:
            open_nodes += [(depth + 1, prefix * 2), (depth + 1, prefix * 2 + 1)]
        elif size:
            cut.append(((root[0] + depth, root[1] << depth | prefix), size))
    return cut


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("_print", BITS - depth)


def _cut(rows: DataFrame, largest: int) -> tuple[np.ndarray, np.ndarray]:
    """First fingerprint and depth of the subtrees of ``rows`` (_print), in order, none of over
    ``largest`` fingerprints.

    Prefixes of ``TOP`` bits are counted first. Where one of them is crowded, the next ``STEP``
    bits are counted, of these prefixes alone, and so on down the trie; so the driver sees a
    few counts for every ``largest`` fingerprints.
    """
    counts = np.zeros(1 << TOP, dtype=np.int64)
    for row in rows.groupBy(_prefix(TOP).alias("_prefix")).count().collect():
        counts[row["_prefix"]] = row["count"]
    depth, found, cut = TOP, _subtrees(counts, largest), []
    while found:
        crowded = [node[1] for node, size in found if size > largest and node[0] < BITS]
        cut += [node for node, size in found if size <= largest or node[0] == BITS]
        if not crowded:
            break
        signed = [[p - (1 << 64) if p >> 63 else p] for p in crowded]
        these = rows.sparkSession.createDataFrame(signed, "_crowded long")
        step = min(STEP, BITS - depth)
        inside = rows.join(these, _prefix(depth) == F.col("_crowded"), "left_semi")
        below = {prefix: np.zeros(1 << step, dtype=np.int64) for prefix in crowded}
        for row in inside.groupBy(_prefix(depth + step).alias("_prefix")).count().collect():
            prefix = row["_prefix"] % (1 << 64)
            below[prefix >> step][prefix % (1 << step)] = row["count"]
        found = [part for p in crowded for part in _subtrees(below[p], largest, (depth, p))]
        depth += step
    cut.sort(key=lambda node: node[1] << (BITS - node[0]))
    starts = np.array([prefix << (BITS - depth) for depth, prefix in cut], dtype=np.uint64)
    return starts, np.array([depth for depth, _ in cut], dtype=np.int64)


def _near(own: int, starts: np.ndarray, depths: np.ndarray, first: int, budget: int) -> list[int]:
    """The subtrees whose prefixes differ from that of number ``own`` in at most ``first`` bits of
    the upper half and ``budget`` bits in all, itself included: a descent along sorted starts."""
    path, end = int(starts[own]), int(depths[own])
    near, todo = [], [(0, len(starts), 0, 0)]
    while todo:
        low, high, depth, off = todo.pop()
        if depth == end or depths[low] == depth:
            near += range(low, high)
            continue
        bit = 1 << (BITS - 1 - depth)
        turn = (int(starts[low]) & ~(2 * bit - 1)) | bit
        middle = low + int(np.searchsorted(starts[low:high], np.uint64(turn)))
        allowed = first if depth < HALF else budget
        for begin, stop, side in ((low, middle, 0), (middle, high, bit)):
            differing = off + (path & bit != side)
            if begin < stop and differing <= allowed:
                todo.append((begin, stop, depth + 1, differing))
    return near


def _union(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking ``a`` with ``b``: the smallest index of every component."""
    while True:
        low = np.minimum(labels[a], labels[b])
        before = labels.copy()
        for side in (a, b):
            np.minimum.at(labels, labels[side], low)
            np.minimum.at(labels, side, low)
        while True:
            jumped = labels[labels]
            if np.array_equal(jumped, labels):
                break
            labels = jumped
        if np.array_equal(before, labels):
            return labels


def linked(left: np.ndarray, right: np.ndarray | None, first: int, budget: int) -> np.ndarray:
    """Spanning links among fingerprints at most ``budget`` bits apart, ``first`` of these in the
    upper half: rows (a, b) of unsigned fingerprints.

    Both sides are sorted, so a trie node is a range. Pairs of nodes go down one bit at a
    time; differing bits add up and a pair beyond the budget is dropped. ``right`` None joins
    ``left`` with itself. Small budgets go first: what they link needs no second look, so a
    pair of nodes whose fingerprints all have one label is dropped as well, and a dense group
    of near copies is not compared pair by pair.
    """
    own = right is None
    ys = left if own else right
    every = left if own else np.concatenate([left, right])
    shift = 0 if own else len(left)
    labels = np.arange(len(every))
    for most in sorted({min(1, budget), min(2, budget), budget}):
        labels = _descended(left, ys, own, shift, every, labels, min(first, most), most)
    moved = np.flatnonzero(labels != np.arange(len(every)))
    return np.stack([every[moved], every[labels[moved]]], axis=1)


def _descended(left, ys, own, shift, every, labels, first, most) -> np.ndarray:
    start = np.array([[0], [len(left)], [0], [len(ys)], [0]], dtype=np.int64)
    stack = [(0, start)]
    while stack:
        depth, nodes = stack.pop()
        if nodes.shape[1] > FRONTIER:
            stack += [(depth, part) for part in np.array_split(nodes, 2, axis=1)]
            continue
        alike = _uniform(labels, nodes, shift)
        nodes = nodes[:, ~alike]
        x0, x1, y0, y1, off = nodes
        small = ((x1 - x0) * (y1 - y0) <= RESOLVED) | (depth == BITS)
        if small.any():
            labels = _resolved(left, ys, own, shift, labels, nodes[:, small], most)
            nodes = nodes[:, ~small]
            x0, x1, y0, y1, off = nodes
        if not nodes.shape[1]:
            continue
        bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
        above = ~((bit << np.uint64(1)) - np.uint64(1)) if depth else np.uint64(0)
        xm = np.searchsorted(left, (left[x0] & above) | bit)
        ym = np.searchsorted(ys, (ys[y0] & above) | bit)
        allowed = first if depth < HALF else most
        same = own & (x0 == y0)
        children = [
            (np.stack([x0, xm, y0, ym, off]), None),
            (np.stack([xm, x1, ym, y1, off]), None),
            (np.stack([x0, xm, ym, y1, off + 1]), None),
            (np.stack([xm, x1, y0, ym, off + 1]), ~same),
        ]
        lower = []
        for child, keep in children:
            fits = (child[0] < child[1]) & (child[2] < child[3]) & (child[4] <= allowed)
            lower.append(child[:, fits if keep is None else fits & keep])
        stack.append((depth + 1, np.concatenate(lower, axis=1)))
    return labels


def _uniform(labels: np.ndarray, nodes: np.ndarray, shift: int) -> np.ndarray:
    changes = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])])
    x0, x1, y0, y1, _ = nodes
    y0, y1 = y0 + shift, y1 + shift
    one = (changes[x1 - 1] == changes[x0]) & (changes[y1 - 1] == changes[y0])
    single = (x1 - x0 == 1) & (y1 - y0 == 1) & (x0 == y0)
    return one & (labels[x0] == labels[y0]) | single


def _resolved(left, ys, own, shift, labels, nodes, most) -> np.ndarray:
    """Compare all fingerprints of the given pairs of nodes and link those near enough."""
    x0, x1, y0, y1, _ = nodes
    sizes = (x1 - x0) * (y1 - y0)
    ends = np.cumsum(sizes)
    for begin in range(0, len(sizes), FRONTIER // 16):
        stop = min(len(sizes), begin + FRONTIER // 16)
        count = sizes[begin:stop]
        base = ends[begin:stop] - count
        node = np.repeat(np.arange(begin, stop), count)
        inside = np.arange(base[0], base[0] + count.sum()) - np.repeat(base, count)
        wide = (y1 - y0)[node]
        x, y = x0[node] + inside // wide, y0[node] + inside % wide
        near = popcount(left[x] ^ ys[y]) <= most
        if own:
            near &= x < y
        x, y = x[near], y[near] + shift
        apart = labels[x] != labels[y]
        if apart.any():
            labels = _union(labels, x[apart], y[apart])
    return labels


def near_links(prints: DataFrame, budget: int, subtree: int = SUBTREE) -> DataFrame:
    """Links _a, _b between the distinct fingerprints ``_print`` (signed) of ``prints``: as many
    as connect every two fingerprints at most ``budget`` bits apart, never all pairs of a group.

    Two joins: with up to ``budget`` // 2 differing bits in the upper half; and, halves
    swapped, with fewer than the rest there. One of the two holds for every near pair. For
    each, the trie is cut into subtrees of at most ``subtree`` fingerprints, at whatever depth
    that takes. A subtree is gathered once, as one sorted block of 8 bytes a fingerprint; the
    task that does finds the subtrees that are near enough, and a copy of the block goes to
    every such pair, where a task descends further. So tasks hold two subtrees, never a group
    of documents.
    """
    spark = prints.sparkSession
    joins = [(0, budget // 2), (HALF, budget - budget // 2 - 1)]
    out = None
    for turned, first in joins:
        if first < 0:
            continue
        turn = F.col("_print")
        if turned:
            turn = F.shiftleft(turn, HALF).bitwiseOR(F.shiftrightunsigned(turn, HALF))
        rows = prints.select(turn.alias("_print"))
        cut = spark.sparkContext.broadcast(_cut(rows, subtree))
        blocks = rows.mapInPandas(_place(cut), PLACED)
        blocks = blocks.groupBy("_subtree").applyInPandas(_gather(cut, first, budget), ROUTED)
        found = blocks.groupBy("_pair").applyInPandas(_join(first, budget), LINKS)
        if turned:
            found = found.select(
                *[
                    F.shiftleft(c, HALF).bitwiseOR(F.shiftrightunsigned(c, HALF)).alias(c)
                    for c in ("_a", "_b")
                ]
            )
        out = found if out is None else out.unionByName(found)
    return out


def _place(cut: Broadcast):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts, _ = cut.value
        for batch in batches:
            prints = batch["_print"].to_numpy().view(np.uint64)
            number = np.searchsorted(starts, prints, side="right") - 1
            yield pd.DataFrame({"_subtree": number, "_print": batch["_print"]})

    return place


def _gather(cut: Broadcast, first: int, budget: int):
    def gather(group: pd.DataFrame) -> pd.DataFrame:
        own = int(group["_subtree"].iloc[0])
        near = np.array(_near(own, *cut.value, first, budget), dtype=np.int64)
        block = np.unique(group["_print"].to_numpy().view(np.uint64)).tobytes()
        return pd.DataFrame(
            {
                "_pair": np.minimum(near, own) << 32 | np.maximum(near, own),
                "_second": near < own,
                "_block": [block] * len(near),
            }
        )

    return gather


def _join(first: int, budget: int):
    def join(group: pd.DataFrame) -> pd.DataFrame:
        blocks = [np.frombuffer(b, np.uint64) for b in group.sort_values("_second")["_block"]]
        right = blocks[1] if len(blocks) > 1 else None
        links = linked(blocks[0], right, first, budget).astype(np.uint64)
        return pd.DataFrame({"_a": links[:, 0].view(np.int64), "_b": links[:, 1].view(np.int64)})

    return join


def components(links: DataFrame) -> DataFrame:
    """_node, _root for every node of ``links`` (_a, _b): the smallest node it is connected to.

    Alternating stars: every node links its larger neighbours to its smallest one, then
    itself and its smaller ones to the smallest of them. Links only ever get fewer or point
    further down, and at the end each is one node and its root. Each round is stored, so a
    lost executor costs one round. A node with very many neighbours is summed up map-side
    first, and joined under adaptive skew handling.
    """

    def state(rows: DataFrame) -> tuple:
        mark = F.xxhash64("_a", "_b")
        return rows.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.pmod(mark, F.lit(1 << 31))), F.lit(0))
        ).first()

    turned = links.select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b"))
    rows = kept(turned.where("_a <> _b").distinct(), "links")
    before = state(rows)
    while before[0]:
        both = rows.unionByName(rows.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        least = both.groupBy("_a").agg(F.least(F.min("_b"), F.first("_a")).alias("_m"))
        large = both.where("_b > _a").join(least, "_a").select(
            F.col("_b").alias("_a"), F.col("_m").alias("_b")
        )
        large = large.where("_a <> _b").distinct()
        least = large.groupBy("_a").agg(F.min("_b").alias("_m"))
        small = large.join(least, "_a").select(F.col("_b").alias("_a"), F.col("_m").alias("_b"))
        small = small.unionByName(least.select("_a", F.col("_m").alias("_b")))
        last, rows = rows, kept(small.where("_a <> _b").distinct(), "links")
        after = state(rows)
        if after == before and rows.join(last, ["_a", "_b"], "left_anti").isEmpty():
            break
        before = after
    return rows.select(F.col("_a").alias("_node"), F.col("_b").alias("_root"))


def near_groups(
    rows: DataFrame, key: str, print_column: str, budget: int = 4, out: str = "_group"
) -> DataFrame:
    """``rows`` (a stored table) with ``out``: the smallest non-NULL ``key`` among all rows
    reachable over links of at most ``budget`` differing bits, the row's own included.

    Equal fingerprints are one node, however many rows have it; the smallest key of a
    fingerprint and of a component is found map-side first. An empty table gives no rows;
    if no row of a component has a key, its group is NULL. Other columns stay, whatever their
    names; one named ``out`` is replaced.
    """
    own = free_name(rows, "_print")
    marked = rows.withColumn(own, F.col(f"`{print_column}`"))
    prints = marked.groupBy(F.col(own).alias("_print")).agg(F.min(f"`{key}`").alias("_least"))
    prints = kept(prints, "prints")
    roots = components(near_links(prints.select("_print"), budget))
    named = prints.join(roots, F.col("_print") == F.col("_node"), "left").select(
        "_print", "_least", F.coalesce("_root", "_print").alias("_root")
    )
    least = named.groupBy("_root").agg(F.min("_least").alias("_group"))
    groups = named.select("_print", "_root").join(least, "_root")
    groups = groups.select(F.col("_print").alias(own), F.col("_group").alias(out))
    return marked.drop(out).join(groups, own).drop(own)
