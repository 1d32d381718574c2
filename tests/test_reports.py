from __future__ import annotations

from pathlib import Path

import pytest
from conftest import END, START, rows

from tidemark.operators import (
    concatenate,
    delete_rows,
    lookup,
    missing_from,
    row_count,
    run_outcome,
    succeeded_only,
    with_status,
)
from tidemark.plans.reconcile import missing_snapshots, reconcile
from tidemark.plans.report import outcome_report, report_for, table_counts
from tidemark.sinks import log_metric, log_run, log_snapshot, write_serving, write_snapshot
from tidemark.sources import read_runs, read_serving, read_snapshots


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_run_outcome(spark):
    data = [("r1", "Success"), ("r1", "Failed"), ("r2", "Success"), ("r3", "Failed")]
    runs = spark.createDataFrame(data, "run_id string, status string")
    assert rows(run_outcome(runs)) == [
        ("r1", True, True), ("r2", True, False), ("r3", False, True),
    ]


def test_status_filter(spark):
    data = [("a", "Failed"), ("report", "Failed"), ("b", "Success"), ("c", None)]
    tasks = spark.createDataFrame(data, "script_name string, status string")
    assert rows(with_status(tasks, "Failed", without=("report",))) == [("a", "Failed")]
    assert with_status(tasks, "Failed").count() == 2


def test_joins_of_the_report(spark):
    tables = spark.createDataFrame([("a",), ("b",), ("c",)], "t string")
    tasks = spark.createDataFrame([("a",), ("a",), ("c",)], "t string")
    values = spark.createDataFrame([("a", 5)], "t string, n long")
    assert rows(succeeded_only(tables, tasks, "t")) == [("a",), ("c",)]
    assert rows(lookup(tables, values, "t", "n")) == [("a", "5"), ("b", "N/A"), ("c", "N/A")]
    assert rows(missing_from(tables, tasks, "t")) == [("b",)]
    counted = concatenate([row_count(tables, "n"), row_count(tasks, "n")])
    assert rows(counted) == [(3,), (3,)]


def test_report(spark, layout):
    for table, status in (("matches", "Success"), ("bowlers", "Success"), ("batsmen", "Failed")):
        write_serving(frame(spark, 1, 2), layout.table(table), f"{table}_1")
        log_run(spark, layout.run_log, "run_1", f"{table}_script", START, END, status)
    log_run(spark, layout.run_log, "run_1", "deliveries_script", START, END, "Success")
    log_run(spark, layout.run_log, "run_0", "batsmen_script", START, END, "Success")
    log_metric(spark, layout.metrics, "run_1", "bowlers", 2)
    log_metric(spark, layout.metrics, "run_0", "matches", 99)
    assert [tuple(r) for r in report_for(spark, layout, "run_1").collect()] == [
        (0, "Matches Table", "matches", 2, "N/A", "OK"),
        (1, "Deliveries Table", "deliveries", None, "N/A",
         "Error fetching data - FileNotFoundError"),
        (3, "Bowlers Table", "bowlers", 2, "2", "OK"),
    ]


def runs_of(spark, layout, gone=(), names=("matches_1", "matches_2", "batsmen_1")):
    for name in names:
        table = name.split("_")[0]
        write_serving(frame(spark, 1, 2), layout.table(table), name)
        if name not in gone:
            write_snapshot(frame(spark, 1, 2), f"{layout.snapshots}/{name}")
        log_snapshot(spark, layout.snapshot_log, table, name, layout.snapshots, START)
    Path(layout.snapshots).mkdir(exist_ok=True)


def names_in(spark, layout, table):
    names = read_serving(spark, layout.table(table)).select("partition_name").distinct()
    return [row[0] for row in rows(names)]


def test_reconcile_with_nothing_missing(spark, layout):
    runs_of(spark, layout)
    assert rows(reconcile(spark, layout)) == []
    assert names_in(spark, layout, "matches") == ["matches_1", "matches_2"]


def test_reconcile_one_missing_keeps_the_registry(spark, layout):
    runs_of(spark, layout, gone=("matches_1",))
    assert rows(reconcile(spark, layout)) == [("matches_1",)]
    assert names_in(spark, layout, "matches") == ["matches_2"]
    assert names_in(spark, layout, "batsmen") == ["batsmen_1"]
    assert rows(missing_snapshots(spark, layout)) == [("matches_1",)]


def test_reconcile_can_prune_the_registry(spark, layout):
    runs_of(spark, layout, gone=("matches_1",))
    reconcile(spark, layout, prune_log=True)
    assert read_snapshots(spark, layout.snapshot_log).count() == 2
    assert rows(missing_snapshots(spark, layout)) == []


def test_reconcile_all_missing(spark, layout):
    runs_of(spark, layout, gone=("matches_1", "matches_2", "batsmen_1"))
    assert reconcile(spark, layout).count() == 3
    assert not list(Path(layout.table("matches")).glob("partition_name=*"))


def test_registered_name_without_rows(spark, layout):
    runs_of(spark, layout)
    log_snapshot(spark, layout.snapshot_log, "bowlers", "bowlers_9", layout.snapshots, START)
    assert rows(reconcile(spark, layout)) == [("bowlers_9",)]
    assert names_in(spark, layout, "matches") == ["matches_1", "matches_2"]


def test_outcomes_of_runs(spark, layout):
    for run_id, script, status in (
        ("r1", "a_script", "Success"), ("r1", "c_script", "Failed"), ("r1", "b_script", "Failed"),
        ("r1", "d_script", "Failed"), ("r2", "a_script", "Success"), ("r3", "d_script", "Failed"),
    ):
        log_run(spark, layout.run_log, run_id, script, START, START, status)
    report = outcome_report(read_runs(spark, layout.run_log), without=("d_script",))
    assert rows(report) == [
        ("r1", True, True, "b_script,c_script"), ("r2", True, False, ""), ("r3", False, True, ""),
    ]


def test_failed_listing_deletes_nothing(spark, layout, tmp_path):
    runs_of(spark, layout)
    (tmp_path / "partitions").rename(tmp_path / "elsewhere")
    with pytest.raises(Exception, match="FileNotFound"):
        reconcile(spark, layout)
    assert names_in(spark, layout, "matches") == ["matches_1", "matches_2"]


def test_delete_rows_keeps_null_keys(spark):
    facts = spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, None), (4, "c")], "v int, partition_name string"
    )
    missing = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "partition_name string")
    assert rows(delete_rows(facts, missing)) == [(2, "b"), (3, None)]
    assert delete_rows(facts, missing).columns == facts.columns
    assert rows(delete_rows(facts, missing.limit(0))) == rows(facts)


def test_a_damaged_table_gets_an_error_line(spark, layout, tmp_path):
    write_serving(frame(spark, 1, 2), layout.table("matches"), "matches_1")
    broken = tmp_path / "broken"
    write_serving(frame(spark, 1), str(broken), "b_1")
    for part in broken.glob("partition_name=*/*"):
        part.unlink()
    for folder in broken.glob("partition_name=*"):
        (folder / "part-0.parquet").write_bytes(b"not parquet")
    counts = table_counts(spark, {"broken": str(broken), "matches": layout.table("matches")})
    found = {row["table"]: (row["total_rows"], row["status"]) for row in counts.collect()}
    assert found["matches"] == (2, "OK")
    assert found["broken"][0] is None and found["broken"][1].startswith("Error fetching data - ")
