"""Vectors of odd widths and several blocks of codes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.neighbours import Index, nearest
from tidemark.llm.queries import op3_neighbours


def test_an_odd_width_drops_only_itself(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(60, 16))
    rows = [(i, vectors[i].tolist()) for i in range(60)]
    odd = [(-5, [1.0, 2.0]), (-10, [3.0]), (100, [1.0] * 15)]
    schema = "vec_id long, embedding array<double>"
    expected = []
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    for q in range(0, 60, 5):
        order = [i for i in np.argsort(-(units @ units[q]), kind="stable") if i != q][:5]
        expected += [(q, rank, int(i)) for rank, i in enumerate(order, start=1)]
    docs = spark.createDataFrame(odd + rows, schema)
    for block in (1024, 7):
        found = nearest(docs, F.col("vec_id") % 5 == 0, block=block)
        assert sorted(tuple(r)[:3] for r in found.collect()) == expected


def test_probing_misses_no_code_within_the_radius():
    rng = np.random.default_rng(2)
    for total in (1, 3, 40, 700):
        codes = rng.integers(0, 1 << 63, total).astype(np.uint64)
        codes[total // 2 :] = codes[0] ^ (np.uint64(1) << rng.integers(0, 64, total - total // 2).astype(np.uint64))
        index = Index(codes)
        assert sum(size for _, size in index.parts) == 64
        for radius in (0, 1, 2, 5, 13, 26, 31, 64):
            for code in codes[:: max(1, total // 6)]:
                expected = np.flatnonzero(np.bitwise_count(codes ^ code) <= radius)
                assert index.within(code, radius).tolist() == expected.tolist()


def test_probing_meets_few_codes_of_other_clumps():
    rng = np.random.default_rng(3)
    codes = np.repeat(rng.integers(0, 1 << 63, 400).astype(np.uint64), 10)
    for _ in range(2):
        codes ^= np.uint64(1) << rng.integers(0, 64, len(codes)).astype(np.uint64)
    index = Index(codes)
    assert all(10 <= len(index.probed(code, 6)) < 200 for code in codes[::97])


def test_clumps_end_in_few_rounds_and_ties_go_to_the_smaller_key(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 32))
    vectors = np.repeat(centres, 25, axis=0) + rng.normal(size=(1000, 32)) * 0.05
    vectors[500:510] = vectors[500]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    # A key that a third of all rows have, and queries alike in key.
    rows += [(2000, vectors[3].tolist())] * 400 + [(2000, (-vectors[3]).tolist())]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    found = nearest(docs, (F.col("vec_id") % 50 == 0) & (F.col("vec_id") < 1000), block=300).collect()
    units = np.concatenate([vectors, vectors[3:4]])
    units = units / np.linalg.norm(units, axis=1, keepdims=True)
    ids = np.append(np.arange(1000), 2000)
    hits = 0
    for q in range(0, 1000, 50):
        own = [r for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q]
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        scores = units @ units[q]
        scores[q] = -9
        best = ids[np.lexsort((ids, -scores.round(12)))[:5]]
        hits += len(set(best) & {r.vec_id for r in own})
        assert all(abs(r.score - units[ids == r.vec_id][0] @ units[q]) < 1e-12 for r in own)
    assert hits >= 0.95 * 100
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 500] == [501, 502, 503, 504, 505]


def test_the_query_returns_every_fiftieth_row_with_its_neighbours(spark, tmp_path):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(400, 12)).astype(np.float32)
    rows = [(i, v.tolist(), i % 10) for i, v in enumerate(vectors)]
    rows += [(450, None, 1), (500, [0.0] * 12, 1), (550, [1.0, None] + [0.0] * 10, 1), (None, [1.0] * 12, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    result = op3_neighbours(spark, str(tmp_path))
    assert result.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    found = {(r.query_id, r.vec_id): r.score for r in result.collect()}
    assert {q for q, _ in found} == set(range(0, 400, 50)) and len(found) == 40
    wide = vectors.astype(np.float64)
    units = wide / np.linalg.norm(wide, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 400, 50):
        scores = units @ units[q]
        scores[q] = -9
        hits += sum((q, int(i)) in found for i in np.argsort(-scores)[:5])
        assert all(abs(s - scores[v]) < 1e-12 for (a, v), s in found.items() if a == q)
    assert hits >= 0.9 * 40
