"""Ordered frames, as-of and range joins against plain Python; last attempts; registry log."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import (
    asof_join,
    cube_totals,
    last_attempts,
    previous_value,
    range_join,
    range_overlaps,
    running_total,
)
from tidemark.plans.report import outcome_report
from tidemark.sinks.log import RegistryLog
from tidemark.sinks.registries import snapshot_entries

SCHEMA = "k string, t int, id int, v int"


def sample(rng, count):
    """One key has two thirds of the rows; NULL keys, times and values, ties."""
    return [
        (rng.choice(["hot", "hot", "a", None]), rng.choice([None, *range(12)]), i,
         rng.choice([None, 1, 2, 3]))
        for i in range(count)
    ]


def by_key(data):
    place = lambda row: (row[1] is not None, row[1] or 0, row[2])
    groups = {}
    for row in sorted(data, key=place):
        groups.setdefault(row[0], []).append(row)
    return groups.values()


@pytest.mark.parametrize("parts", [7, 64])
def test_ordered_frames_of_a_hot_key(spark, parts):
    data = sample(random.Random(parts), 300)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    sums, before = [], []
    for group in by_key(data):
        held, last = None, None
        for row in group:
            if row[3] is not None:
                held = (held or 0) + row[3]
            sums.append((*row, held))
            before.append((*row, last))
            last = row[3]
    found = running_total(df, ["k"], ["t", "id"], "v", "sum", parts)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(sums, key=str)
    found = previous_value(df, ["k"], ["t", "id"], "v", "last", parts)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(before, key=str)


def test_asof_join_equals_a_search(spark):
    rng = random.Random(3)
    left, right = sample(rng, 250), sample(rng, 60)
    expected = []
    for k, t, i, v in left:
        good = [
            (row[1], row[3] is not None, row[3] or 0, row[2], row[3]) for row in right
            if k is not None and row[0] == k and t is not None and row[1] is not None
            and row[1] <= t
        ]
        best = max(good, default=None)
        expected.append((k, t, i, v, *((best[4], best[3]) if best else (None, None))))
    left_df = spark.createDataFrame(left, SCHEMA)
    right_df = spark.createDataFrame(right, "k string, t int, rid int, w int")
    found = asof_join(left_df, right_df, ["k"], "t", "t", ["w", "rid"], 9)
    assert found.columns == ["k", "t", "id", "v", "w", "rid"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    empty = asof_join(left_df.limit(0), right_df, ["k"], "t", "t", ["w"])
    assert empty.count() == 0
    alone = asof_join(left_df, right_df.limit(0), ["k"], "t", "t", ["w"])
    assert alone.where("w is null").count() == len(left)


def test_range_join_finds_every_pair_once(spark):
    rng = random.Random(4)
    points = [(i, rng.choice([None, round(rng.uniform(-50, 50), 2)]), "x") for i in range(120)]
    spans = []
    for j in range(80):
        low = round(rng.uniform(-60, 50), 2)
        length = rng.choice([0, -1, 0.001, 0.5, 1, 2, 8, 100])
        spans.append((j, low, rng.choice([None, low + length, low + length]), "x"))
    expected = sorted(
        (i, j) for i, p, _ in points for j, low, high, _ in spans
        if p is not None and high is not None and low <= p < high
    )
    a = spark.createDataFrame(points, "i int, p double, k string")
    b = spark.createDataFrame(spans, "j int, low double, high double, k string")
    for keys in ([], ["k"]):
        joined = range_join(a, b if keys else b.drop("k"), "p", "low", "high", keys)
        assert "NestedLoop" not in joined._jdf.queryExecution().toString()
        assert rows(joined.select("i", "j")) == sorted(expected, key=lambda r: [(False, str(v)) for v in r])
    other = b.toDF("j2", "low2", "high2", "k")
    found = range_overlaps(b, other, ("low", "low2"), ("high", "high2"), ["k"])
    good = [s for s in spans if s[2] is not None and s[1] < s[2]]
    pairs = sorted((x[0], y[0]) for x in good for y in good if x[1] < y[2] and y[1] < x[2])
    assert sorted(map(tuple, found.select("j", "j2").collect())) == pairs
    assert range_join(a, b.limit(0), "p", "low", "high", ["k"]).count() == 0


def test_last_attempts(spark):
    start = datetime(2025, 1, 1)

    def attempt(run, task, minutes, status):
        end = None if minutes is None else start + timedelta(minutes=minutes)
        return (run, task, start, end, status)

    data = [
        attempt("r1", "a", 1, "Failed"), attempt("r1", "a", 2, "Success"),
        attempt("r1", "b", 5, "Success"), attempt("r1", "b", 6, "Failed"),
        attempt("r2", "a", 1, "Failed"), attempt("r2", "a", 1, "Success"),
        attempt("r2", "b", None, "Failed"), attempt("r2", "b", 0, "Success"),
    ] + [attempt("r3", "hot", k, "Failed") for k in range(50)] + [attempt("r3", "hot", 60, "Success")]
    schema = "run_id string, script_name string, start_time timestamp, end_time timestamp, status string"
    runs = spark.createDataFrame(data, schema)
    found = last_attempts(runs)
    assert found.columns == runs.columns
    assert sorted((r["run_id"], r["script_name"], r["status"]) for r in found.collect()) == [
        ("r1", "a", "Success"), ("r1", "b", "Failed"), ("r2", "a", "Success"),
        ("r2", "b", "Success"), ("r3", "hot", "Success"),
    ]
    assert rows(outcome_report(runs)) == [
        ("r1", True, True, "b"), ("r2", True, False, ""), ("r3", True, False, ""),
    ]
    assert last_attempts(runs.limit(0)).count() == 0


def test_cube_tells_null_keys_from_totals(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, "x", None)], "p string, q string, v int")
    found = sorted(map(tuple, cube_totals(df, ["p", "q"], "v").collect()), key=str)
    assert found == sorted([
        ("a", None, 0, 1, 1), ("a", "x", 0, 1, 2), (None, "x", 0, 1, None),
        ("a", None, 1, 2, 3), (None, None, 1, 1, None),
        (None, None, 2, 1, 1), (None, "x", 2, 2, 2), (None, None, 3, 3, 3),
    ], key=str)


def test_registry_log_opens_few_files_and_loses_none(spark, tmp_path, monkeypatch):
    log = RegistryLog(spark, str(tmp_path / "r"), schemas.SNAPSHOTS)
    assert log.read().count() == 0 and log.compact() == 0

    def entry(k):
        run = spark.createDataFrame([("t", f"t_{k}", datetime(2025, 1, 1))], "table_name string, partition_name string, started_at timestamp")
        return snapshot_entries(run, "/p")

    for k in range(6):
        log.append(entry(k))
    before = log.read()
    assert log.files() == 6 and log.compact() == 6 and log.files() == 1
    assert before.count() == 6
    names = lambda: sorted(r["partition_name"] for r in log.read().collect())
    # A writer that ends while a compaction is under way is in the tail.
    checkpoint = type(log.table).checkpoint

    def slow(self, *args):
        log.append(entry(7))
        return checkpoint(self, *args)

    log.append(entry(6))
    monkeypatch.setattr(type(log.table), "checkpoint", slow)
    assert log.compact() == 1
    monkeypatch.undo()
    assert names() == [f"t_{k}" for k in range(8)] and log.files() == 2
    assert log.compact() == 1 and log.compact() == 0
    assert names() == [f"t_{k}" for k in range(8)] and log.files() == 1
