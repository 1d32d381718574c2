"""Sketches kept by run, and the stream in event time."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import distinct_counts, distinct_sketches
from tidemark.plans.report import distinct_report
from tidemark.sinks import log_sketches, write_serving_sketched
from tidemark.sources import read_serving, read_sketches
from tidemark.streaming import ingest_events
from tidemark.versions import VersionedTable

VALUES = "k string, v string, d int, t timestamp"


def test_sketches_count_what_distinct_counts(spark):
    moment = datetime(2024, 1, 1)
    some = [
        ("a", "x", 1, moment), ("a", "x", 1, None), ("a", "", 2, None), ("a", None, None, None),
        (None, "x", 3, moment), (None, "y", 3, moment), ("b", None, None, None),
    ]
    frame = spark.createDataFrame(some, VALUES).withColumn("d", F.col("d").cast("decimal(9,2)"))
    made = distinct_sketches(frame, ["v", "d", "t"], ["k"])
    found = distinct_counts(made, ["k", "column_name"])
    expected = [
        (k, name, n)
        for k, counts in {"a": (2, 2, 1), None: (2, 1, 1), "b": (0, 0, 0)}.items()
        for name, n in zip("vdt", counts)
    ]
    assert sorted(rows(found), key=str) == sorted(expected, key=str)
    overall = distinct_counts(made, ["column_name"])
    assert sorted(rows(overall)) == [("d", 3), ("t", 1), ("v", 3)]
    empty = distinct_sketches(frame.limit(0), ["v"])
    assert rows(distinct_counts(empty, ["column_name"])) == [("v", 0)]
    assert rows(distinct_counts(distinct_sketches(frame.limit(0), ["v"], ["k"]), ["k"])) == []


def test_sketches_stay_within_their_error_and_size(spark):
    # One key has nine tenths of the rows.
    frame = spark.range(400_000).select(
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("k"), F.col("id").alias("v")
    )
    made = distinct_sketches(frame, ["v"], ["k"])
    assert made.select(F.max(F.length("sketch"))).first()[0] < 200_000
    found = dict(rows(distinct_counts(made, ["k"])))
    assert abs(found["hot"] / 360_000 - 1) < 0.04 and abs(found["cold"] / 40_000 - 1) < 0.04
    assert abs(distinct_counts(made, []).first()[0] / 400_000 - 1) < 0.04


def test_runs_are_merged_without_their_rows(spark, tmp_path):
    serving, registry = str(tmp_path / "serving"), str(tmp_path / "sketches")
    assert rows(distinct_report(read_sketches(spark, registry))) == []

    def load(name, *values):
        frame = spark.createDataFrame([(v,) for v in values], "v string")
        count, sketches = write_serving_sketched(frame, serving, name, ["v"])
        log_sketches(spark, registry, name, "t", sketches)
        return count

    assert load("r1", "a", "b", "b", None) == 4
    assert load("r2", "b", "c") == 2
    assert load("r2", "b", "d", "e") == 3
    assert load("r3") == 0
    report = distinct_report(read_sketches(spark, registry))
    expected = {("r1", 2), ("r2", 3), ("r3", 0), (None, 4)}
    assert {(r.run_id, r.distinct_values) for r in report.collect()} == expected
    assert {r.table_name for r in report.collect()} == {"t"}
    assert read_serving(spark, serving).count() == 7
    only = distinct_report(read_sketches(spark, registry, "r1")).where("run_id IS NULL")
    assert only.first().distinct_values == 2


@pytest.fixture
def stream(spark, tmp_path):
    schema = spark.createDataFrame([], "k bigint, t timestamp, v string").schema
    start = datetime(2024, 1, 1)

    def land(*events):
        values = [(k, None if m is None else start + timedelta(minutes=m), v) for k, m, v in events]
        frame = spark.createDataFrame(values, schema).coalesce(1)
        frame.write.mode("append").parquet(str(tmp_path / "landing"))
        ingest_events(
            spark, str(tmp_path / "landing"), schema, str(tmp_path / "table"),
            str(tmp_path / "checkpoint"), ["k"], "t", "10 minutes",
        ).awaitTermination()
        table = VersionedTable(spark, str(tmp_path / "table"))
        return sorted((r.k, r.v) for r in table.read().where("k IS NOT NULL").collect()), table

    return land


def test_repeats_and_late_events_are_dropped_across_batches(stream):
    found, _ = stream((1, 0, "a"), (1, 0, "a"), (2, 30, "b"), (3, None, "no time"))
    assert found == [(1, "a"), (2, "b")]
    # The watermark is minute 20: at it or before is late, after it is not.
    found, _ = stream((2, 30, "repeat"), (4, 20, "late"), (5, 21, "e"), (1, 0, "repeat"), (6, 40, "f"))
    assert found == [(1, "a"), (2, "b"), (5, "e"), (6, "f")]
    found, table = stream((5, 21, "repeat"), (6, 45, "repeat"), (None, 41, "n"), (None, 42, "n"))
    assert found == [(1, "a"), (2, "b"), (5, "e"), (6, "f")]
    assert table.read().where("k IS NULL").count() == 1


def test_a_key_comes_again_once_it_is_forgotten(stream):
    stream((1, 0, "first"), (2, 100, "on"))
    stream((2, 100, "repeat"))
    found, _ = stream((1, 95, "second"))
    assert found == [(1, "first"), (1, "second"), (2, "on")]


def test_a_batch_counts_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "table"))
    frame = spark.createDataFrame([(1,)], "k bigint")
    for _ in range(2):
        table.append(frame, batch="checkpoint:0")
    assert table.read().count() == 1
    # A hot key: many repeats of one event in one batch.
    hot = spark.range(20_000).select(
        F.lit(7).cast("bigint").alias("k"), F.lit(datetime(2024, 1, 1)).alias("t")
    )
    hot.write.parquet(str(tmp_path / "landing"))
    for _ in range(2):
        ingest_events(
            spark, str(tmp_path / "landing"), hot.schema, str(tmp_path / "events"),
            str(tmp_path / "checkpoint"), ["k"], "t", "1 hour", files_per_batch=2,
        ).awaitTermination()
    assert rows(VersionedTable(spark, str(tmp_path / "events")).read().select("k")) == [(7,)]


def test_an_empty_landing_gives_no_events(spark, tmp_path):
    schema = spark.createDataFrame([], "k bigint, t timestamp").schema
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "landing"))
    ingest_events(
        spark, str(tmp_path / "landing"), schema, str(tmp_path / "events"),
        str(tmp_path / "checkpoint"), ["k"], "t", "1 hour",
    ).awaitTermination()
    table = VersionedTable(spark, str(tmp_path / "events"))
    assert table.version() == 0 or table.read().count() == 0
