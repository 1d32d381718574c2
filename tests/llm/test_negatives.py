"""Hard negatives against all inner products in plain Python."""

from __future__ import annotations

import math
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives
from tidemark.llm.negatives import Index, hard_negatives, learned_words, products

ROWS = "vec_id long, embedding array<float>, label int, rank string, _id int"


def brute_force(rows, every):
    """Rows of `hard_negatives` from all pairs; rows alike in id are given at most once here."""
    used = [
        (i, label, [math.floor(256 * float(np.float32(x))) for x in vector])
        for i, vector, label in rows
        if i is not None and label is not None and vector is not None
        and all(x is not None and math.isfinite(x) for x in vector) and len(vector) == 6
    ]
    out = []
    for anchor, own, vector in used:
        if anchor % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(vector, other)), i, label)
            for i, label, other in used if i != anchor
        )
        for positive, score in [(i, -s) for s, i, label in scored if label == own][:5]:
            good = [
                (i, -s) for s, i, label in scored
                if label != own and 80 * score <= -100 * s <= 100 * score
            ]
            for rank, (i, s) in enumerate(good[:5], start=1):
                out.append((anchor, positive, rank, i, score, s))
    return sorted(out)


def sample(rng, count):
    """Vectors in clumps, with ties, and all that takes no part."""
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = []
    for i in range(count):
        centre = rng.choice(centres)
        vector = [round(x + rng.gauss(0, 0.2), 1) for x in centre]
        rows.append((i, vector, rng.randint(0, 3)))
    rows += [(count + 1, None, 1), (count + 2, [0.1] * 6, None), (None, [0.1] * 6, 1)]
    rows += [(count + 3, [0.1, None, 0.1, 0.0, 0.0, 0.0], 1), (count + 4, [math.nan] + [0.1] * 5, 1)]
    rows += [(count + 5, [math.inf] + [0.1] * 5, 1), (count + 6, [0.5, 0.5], 1), (1000, [], 1)]
    return rows + [(-20, [0.0] * 6, 2), (-10, [1.0] * 6, 2)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    rng = random.Random(6)
    rows = sample(rng, 300)
    if small:
        for name, value in (("FIRST", 20), ("WIDER", 2), ("CELL", 4), ("CHUNK", 3)):
            monkeypatch.setattr(negatives, name, value)
    docs = spark.createDataFrame([(*row, "r", 1) for row in rows], ROWS).repartition(3)
    found = hard_negatives(docs, F.col("vec_id") % 10 == 0)
    expected = brute_force(rows, 10)
    assert len(expected) > 100
    assert sorted(map(tuple, found.collect())) == expected


def test_rows_alike_are_one_answer(spark):
    rng = random.Random(3)
    rows = sample(rng, 60)
    docs = spark.createDataFrame([(*row, "r", 1) for row in rows + rows + rows], ROWS)
    found = hard_negatives(docs, F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == brute_force(rows, 10)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], ROWS)
    assert hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0
    alone = spark.createDataFrame([(10, [1.0, 2.0], 1, "r", 1)], ROWS)
    found = hard_negatives(alone, F.col("vec_id") % 10 == 0)
    assert found.columns[0] == "anchor_id" and found.count() == 0


def test_cells_come_in_order_of_their_bounds_which_hold():
    rng = np.random.default_rng(1)
    rows = np.floor(rng.normal(size=(500, 8)) * 256)
    words = tuple(learned_words(part, 6, 1) for part in (rows[:, :4], rows[:, 4:]))
    near = [negatives._nearest(part, own) for part, own in zip((rows[:, :4], rows[:, 4:]), words)]
    radii = []
    for part, own, at in zip((rows[:, :4], rows[:, 4:]), words, near):
        far = np.sqrt(((part - own[at]) ** 2).sum(axis=1))
        radii.append(np.array([far[at == k].max(initial=0) for k in range(6)]))
    sizes = np.bincount(near[0] * 6 + near[1], minlength=36)
    index = Index(4, words, tuple(radii), sizes)
    for anchor in rows[:20]:
        first, second, low_1, low_2 = index.bounds(anchor)
        walk = list(index.cells(first, second))
        assert len({(i, j) for _, i, j in walk}) == 36
        assert [b for b, _, _ in walk] == sorted((b for b, _, _ in walk), reverse=True)
        scores = rows @ anchor
        assert (scores <= first[near[0]] + second[near[1]]).all()
        assert (scores >= low_1[near[0]] + low_2[near[1]]).all()


def test_clumped_vectors_are_certified_without_all_cells(monkeypatch, spark):
    """Anchors in tight clumps ask only for cells of their own clump and those that may matter."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(8, 16)) * 3
    rows = [
        (i, [float(x) for x in centres[i % 8] + rng.normal(size=16) * 0.02], int(i // 8 % 3))
        for i in range(1600)
    ]
    monkeypatch.setattr(negatives, "CELL", 25)
    asked = []
    monkeypatch.setattr(
        negatives, "kept",
        lambda df, purpose, kept=negatives.kept: asked.append(kept(df, purpose)) or asked[-1]
        if purpose == "asked" else kept(df, purpose),
    )
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = hard_negatives(docs, F.col("vec_id") % 100 == 0)
    assert found.count() == 16 * 25
    visited = sum(df.count() for df in asked)
    assert visited < 0.5 * 16 * 2 * 64


def test_products_are_exact_beyond_floats():
    large = np.array([[float(1 << 27), 3.0]])
    other = np.array([[float(1 << 27), 1.0]] * 2)
    assert products(large, other).tolist() == [[(1 << 54) + 3] * 2]


@pytest.mark.parametrize("scale", [1, 100, 110_000], ids=["32 bits", "64 bits", "whole"])
def test_cut_cells_and_large_components_equal_brute_force(spark, monkeypatch, scale):
    rng = random.Random(8)
    rows = [
        (i, v and [x and x * scale for x in v], label) for i, v, label in sample(rng, 200)
    ]
    sizes = {"FIRST": 20, "WIDER": 2, "CELL": 40, "CHUNK": 8, "BLOCK": 20, "CELLS": 2}
    for name, value in sizes.items():
        monkeypatch.setattr(negatives, name, value)
    docs = spark.createDataFrame([(*row, "r", 1) for row in rows], ROWS).repartition(3)
    found = hard_negatives(docs, F.col("vec_id") % 10 == 0)
    expected = brute_force(rows, 10)
    assert len(expected) > 50
    assert max(row[4] for row in expected) > {1: 0, 100: 1 << 24, 110_000: 1 << 53}[scale]
    assert sorted(map(tuple, found.collect())) == expected


def test_anchors_of_round_keys_go_to_all_chunks_without_a_vector_for_each_cell(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=16).tolist(), i % 3) for i in range(1200)]
    asked = []
    monkeypatch.setattr(
        negatives, "kept",
        lambda df, purpose, kept=negatives.kept: asked.append(kept(df, purpose)) or asked[-1]
        if purpose == "asked" else kept(df, purpose),
    )
    monkeypatch.setattr(negatives, "CHUNK", 12)
    monkeypatch.setattr(negatives, "CELL", 12)
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    hard_negatives(docs, F.col("vec_id") % 10 == 0)
    assert len(asked) >= 2
    for df in asked:
        if not df.isEmpty():
            assert df.select("_chunk").distinct().count() > 5
            assert not any("array" in kind for _, kind in df.dtypes)
    assert any(not df.isEmpty() for df in asked)


def test_a_plan_holds_few_visits_at_once(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(negatives, "VISITS", 5000)
    words = tuple(rng.normal(size=(20, 4)) for _ in range(2))
    sizes = np.full(400, 10)
    first, parts = negatives._cut(sizes, 100)
    wide = np.full(20, 1e6)  # bounds that say nothing
    index = SimpleNamespace(value=Index(4, words, (wide, wide), sizes, first, parts))
    anchors = pd.DataFrame({
        "_chunk": np.arange(500) % 2,
        "_at": np.arange(500) // 2,
        "_vector": list(rng.normal(size=(500, 8))),
        "_limits": [np.array([0])] * 500,
        "_held": [np.array([negatives.LEAST])] * 500,
    })
    plan = negatives._planner(index, 0, 1 << 40, True, 0, 0)
    visits = []
    for frame in plan(iter([anchors])):
        assert frame["_at"].map(len).sum() <= 4 * (5000 + 400)
        for row in frame.itertuples():
            cells, at = np.frombuffer(row[3], np.int32), np.frombuffer(row[4], np.int32)
            assert (first[cells] == row[2]).all()
            visits += [(row[1], a, c) for a, c in zip(at.tolist(), cells.tolist())]
    assert len(visits) == len(set(visits)) == 500 * 400


@pytest.mark.parametrize("same", [True, False])
def test_a_search_holds_few_scores_at_once(monkeypatch, same):
    rng = np.random.default_rng(6)
    monkeypatch.setattr(negatives, "SCORES", 1 << 16)
    rows, count = np.floor(rng.normal(size=(3000, 8)) * 256), 3000
    ids, labels, cells = np.arange(count), np.zeros(count, dtype=int), np.arange(count) // 1500
    labels[1400:] = 0 if same else 1
    limits = [np.array([1 << 40])] * 2000
    block = {"_cells": cells.astype(np.int32).tobytes(), **negatives._packed(ids, labels, rows)}
    anchors = pd.DataFrame({
        "_chunk": 0, "_at": np.arange(2000), "_anchor": np.arange(2000) + count, "_label": 0,
        "_vector": list(rows[:2000]), "_limits": limits, "_held": [np.array([-1 << 40])] * 2000,
    })
    chunk = negatives._chunker(same, -100, 100)(anchors).iloc[0].to_dict()
    asked = pd.DataFrame({
        "_chunk": 0, "_block": 0,
        "_cells": [np.full(2000, c, dtype=np.int32).tobytes() for c in range(2)],
        "_at": [np.arange(2000, dtype=np.int32).tobytes()] * 2,
    })
    packed = pd.DataFrame([block, chunk])
    tracemalloc.start()
    found = negatives._searcher(same, 4)(asked, packed)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20  # all scores at once are 48 MB
    scores = rows[:2000] @ rows.T
    scores[:, labels != 0 if same else labels == 0] = -np.inf
    best = np.sort(scores, axis=1)[:, :-5:-1]
    found = found.sort_values(["_anchor", "_score"], ascending=[True, False])
    assert found["_anchor"].tolist() == np.repeat(np.arange(2000) + count, 4).tolist()
    assert found["_score"].to_numpy().reshape(2000, 4).tolist() == best.astype(int).tolist()
    part_without_rows = pd.DataFrame([chunk | {"_cells": None}])
    assert negatives._searcher(same, 4)(asked, part_without_rows).empty
