from __future__ import annotations

from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from conftest import END, START, rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.plans.jobs import BATSMEN, BOWLERS, DELIVERIES, JOBS, MATCHES, Job
from tidemark.plans.load import run_load
from tidemark.sinks import Relational
from tidemark.sources import read_metrics, read_runs, read_serving, read_snapshots
from tidemark.storage import shared_root

BATSMEN_HEADER = ",".join(BATSMEN.declared.names)
BATSMEN_ROWS = (
    "Decimal Text,1001,31,29,2,37.25,1300,77,4,2,80,13",
    "Null Text,1002,32,30,30,NULL,1301,77.5,3,1,81,14",
    "Trailing Space  ,1003,33,31,3,0.5,1302,78,2,0,82,15",
    "Whole Number,1004,34,32,4,20,1303,78.5,1,0,83,16",
)
BOWLERS_HEADER = ",".join(BOWLERS.declared.names)
BOWLERS_ROWS = (
    "Whole Numbers,501,71,61,90,2001,17,5,33,1,0",
    "Below And Above Half ,502,72,62,90.25,2002,17.75,5.125,33.875,2,1",
    "Ties And Text ,503,73,63,90.5,2003,18.5,6.5,text,3,2",
)


def load(spark, job, path, layout, **options):
    options.setdefault("clock", lambda: END)
    return run_load(spark, job, path, layout, START, **options)


def test_report_order_and_scripts():
    assert [job.table for job in JOBS] == ["matches", "deliveries", "batsmen", "bowlers"]
    assert MATCHES.script == "matches_script"


@pytest.mark.parametrize("infer", [False, True])
def test_batsmen(spark, landing, layout, infer):
    path = landing("batsmen.csv", BATSMEN_HEADER, *BATSMEN_ROWS)
    assert load(spark, BATSMEN, path, layout, infer=infer) == 4
    table = read_serving(spark, layout.table("batsmen"))
    assert table.columns == [*BATSMEN.declared.names, "partition_name"]
    assert dict(table.dtypes)["average"] == "int"
    assert rows(table.select("player_name", "average", "strike_rate", "partition_name")) == [
        ("Decimal Text", None, 77.0, "batsmen_20250418_093000"),
        ("Null Text", None, 77.5, "batsmen_20250418_093000"),
        ("Trailing Space", None, 78.0, "batsmen_20250418_093000"),
        ("Whole Number", 20, 78.5, "batsmen_20250418_093000"),
    ]


@pytest.mark.parametrize("infer", [False, True])
def test_bowlers(spark, landing, layout, infer):
    path = landing("bowlers.csv", BOWLERS_HEADER, *BOWLERS_ROWS)
    load(spark, BOWLERS, path, layout, infer=infer)
    table = read_serving(spark, layout.table("bowlers"))
    kinds = dict(table.dtypes)
    rounded = ["total_overs", "bowling_avg", "economy_rate", "strike_rate"]
    assert {kinds[name] for name in rounded} == {"decimal(10,0)"}
    assert rows(table.select("player_name", *rounded)) == [
        ("Below And Above Half", *map(Decimal, (90, 18, 5, 34))),
        ("Ties And Text", *map(Decimal, (91, 19, 7)), None),
        ("Whole Numbers", *map(Decimal, (90, 17, 5, 33))),
    ]


def test_matches_compares_before_trimming_and_casts_after(spark, landing, layout):
    path = landing(
        "matches.csv",
        "id,date,method,player_id,result_margin,target_runs,target_overs,season",
        "1,18-04-2008,D/L, 7 ,140,223,20,old",
        "2,19-04-2008, D/L ,8,NA,NA,9.5,old",
        "3,2008-04-18,NA,x,,1e2,20,old",
    )
    load(spark, MATCHES, path, layout)
    table = read_serving(spark, layout.table("matches"))
    assert table.columns == [
        "id", "date", "method", "player_id", "result_margin", "target_runs", "target_overs",
        "season", "rained", "partition_name",
    ]
    assert rows(table.drop("partition_name")) == [
        ("1", "18-04-2008", "D/L", 7, 140, 223, 20, "2008", "rain"),
        ("2", "19-04-2008", "D/L", 8, None, None, None, "2008", None),
        ("3", "2008-04-18", "NA", None, None, None, 20, "4-18", None),
    ]


def test_inference_changes_which_decimals_survive(spark, landing, layout):
    header = "date,method,player_id,result_margin,target_runs,target_overs"
    decimals = landing("a.csv", header, "d,NA,1,1,9.7,NA", "d,NA,1,1,3.2,9.7")
    load(spark, MATCHES, decimals, layout, infer=True)
    table = read_serving(spark, layout.table("matches"))
    assert rows(table.select("target_runs", "target_overs")) == [(3, None), (9, None)]


def test_inferred_dates_have_no_season(spark, landing, layout):
    header = "date,method,player_id,result_margin,target_runs,target_overs"
    path = landing("a.csv", header, "2008-04-18,NA,1,1,1,1")
    load(spark, MATCHES, path, layout, infer=True)
    table = read_serving(spark, layout.table("matches"))
    assert dict(table.dtypes)["date"] == "date"
    assert rows(table.select("season")) == [("4-18",)]


def test_deliveries_total_covers_this_load_only(spark, landing, layout):
    header = "match_id,inning,over,batter,total_runs"
    first = landing("d1.csv", header, "1,1,1, A ,1", "1,1,1,B,4", "1,1,2,B,6", "1,1,3,C,")
    load(spark, DELIVERIES, first, layout)
    second = landing("d2.csv", header, "1,1,1,A,2")
    run_load(spark, DELIVERIES, second, layout, datetime(2025, 4, 18, 9, 30, 1), clock=lambda: END)
    table = read_serving(spark, layout.table("deliveries"))
    assert dict(table.dtypes)["runs_per_over"] == "bigint"
    assert rows(table) == [
        (1, 1, 1, "A", 1, 5, "deliveries_20250418_093000"),
        (1, 1, 1, "A", 2, 2, "deliveries_20250418_093001"),
        (1, 1, 1, "B", 4, 5, "deliveries_20250418_093000"),
        (1, 1, 2, "B", 6, 6, "deliveries_20250418_093000"),
        (1, 1, 3, "C", None, None, "deliveries_20250418_093000"),
    ]
    assert not list(Path(shared_root(spark)).glob("tidemark/staging-*"))


def test_hot_groups_of_a_load(spark, landing, layout):
    """Half of the rows in one over."""
    job = DELIVERIES
    lines = [f"1,1,1,A,{i % 7}" for i in range(200)] + [f"2,1,{i},B,{i % 7}" for i in range(200)]
    path = landing("d.csv", "match_id,inning,over,batter,total_runs", *lines)
    assert load(spark, job, path, layout) == 400
    table = read_serving(spark, layout.table("deliveries"))
    totals = table.groupBy("match_id").agg(F.sum("runs_per_over"), F.count("*"))
    runs = sum(i % 7 for i in range(200))
    assert rows(totals) == [(1, 200 * runs, 200), (2, runs, 200)]


def test_every_sink_gets_the_run(spark, landing, layout):
    path = landing("batsmen.csv", BATSMEN_HEADER, *BATSMEN_ROWS)
    load(spark, BATSMEN, path, layout, run_id="run_1")
    name = "batsmen_20250418_093000"
    snapshot = spark.read.csv(f"{layout.snapshots}/{name}")
    assert snapshot.count() == 4
    whole = snapshot.where("_c0 = 'Whole Number'").select("_c5", "_c12")
    assert rows(whole) == [("20", name)]
    entry = read_snapshots(spark, layout.snapshot_log).first()
    assert entry[:3] == ("batsmen", name, f"{layout.snapshots}/{name}")
    assert rows(read_metrics(spark, layout.metrics)) == [("run_1", "batsmen", 4)]
    run = read_runs(spark, layout.run_log).first()
    assert (run["run_id"], run["script_name"], run["status"]) == (
        "run_1", "batsmen_script", "Success",
    )
    assert (Path(layout.archive) / name / "batsmen.csv").exists() and not Path(path).exists()


def test_rerun_replaces_its_rows_everywhere(spark, landing, layout):
    for lines in (BATSMEN_ROWS, BATSMEN_ROWS[:1]):
        path = landing(f"b{len(lines)}.csv", BATSMEN_HEADER, *lines)
        load(spark, BATSMEN, path, layout, run_id="run_1", replace=True)
    assert read_serving(spark, layout.table("batsmen")).count() == 1
    assert spark.read.csv(f"{layout.snapshots}/batsmen_20250418_093000").count() == 1
    assert read_snapshots(spark, layout.snapshot_log).count() == 1
    assert rows(read_metrics(spark, layout.metrics)) == [("run_1", "batsmen", 1)]
    assert read_runs(spark, layout.run_log).count() == 2


def test_empty_file_is_a_run_without_rows(spark, landing, layout):
    path = landing("batsmen.csv", BATSMEN_HEADER)
    assert load(spark, BATSMEN, path, layout) == 0
    assert Path(layout.snapshots, "batsmen_20250418_093000").is_dir()
    assert read_snapshots(spark, layout.snapshot_log).count() == 1


def test_failure_is_logged_and_keeps_the_input(spark, landing, layout):
    path = landing("batsmen.csv", "player_name,total_runs", "A,1")
    with pytest.raises(ValueError):
        load(spark, BATSMEN, path, layout)
    assert [r["status"] for r in read_runs(spark, layout.run_log).collect()] == ["Failed"]
    assert Path(path).exists() and not Path(layout.archive).exists()
    assert read_snapshots(spark, layout.snapshot_log).count() == 0


def test_archived_file_is_never_overwritten(spark, landing, layout):
    load(spark, BATSMEN, landing("b.csv", BATSMEN_HEADER, *BATSMEN_ROWS), layout)
    again = landing("b.csv", BATSMEN_HEADER, BATSMEN_ROWS[0])
    with pytest.raises(FileExistsError):
        load(spark, BATSMEN, again, layout)
    assert read_serving(spark, layout.table("batsmen")).count() == 4
    assert Path(again).exists()
    next_day = datetime(2025, 4, 19, 9, 30)
    run_load(spark, BATSMEN, again, layout, next_day, clock=lambda: END)
    assert read_serving(spark, layout.table("batsmen")).count() == 5


def test_folder_keeps_the_files_that_came_too_late(spark, landing, layout, tmp_path, monkeypatch):
    from tidemark.plans import load as module

    landing("a b.csv", BATSMEN_HEADER, BATSMEN_ROWS[0])
    landing("c.csv", BATSMEN_HEADER, BATSMEN_ROWS[1])
    publish = module.publish

    def slow_publish(*args, **options):
        count = publish(*args, **options)
        landing("late.csv", BATSMEN_HEADER, BATSMEN_ROWS[2])
        return count

    monkeypatch.setattr(module, "publish", slow_publish)
    assert load(spark, BATSMEN, str(tmp_path / "files"), layout) == 2
    assert [p.name for p in (tmp_path / "files").glob("*.csv")] == ["late.csv"]
    archived = Path(layout.archive, "batsmen_20250418_093000").glob("*.csv")
    assert sorted(p.name for p in archived) == ["a b.csv", "c.csv"]


def test_files_of_one_name_are_refused_before_loading(spark, landing, layout, tmp_path):
    for day in ("day=1", "day=2"):
        (tmp_path / "files" / day).mkdir(parents=True)
        text = "\n".join([BATSMEN_HEADER, BATSMEN_ROWS[0]])
        (tmp_path / "files" / day / "b.csv").write_text(text)
    with pytest.raises(FileExistsError):
        load(spark, BATSMEN, str(tmp_path / "files"), layout)
    assert not Path(layout.table("batsmen")).exists()


@pytest.mark.parametrize("job", JOBS, ids=lambda job: job.table)
def test_file_without_rows(spark, landing, layout, job):
    path = landing("x.csv", ",".join(job.declared.names))
    assert load(spark, job, path, layout) == 0


def test_database_gets_the_written_rows_before_the_registry(spark, landing, layout, monkeypatch):
    appended = {}

    def record(rows_written, table, target):
        appended[table] = (rows(rows_written.select("player_name", "partition_name")), target)
        appended["registered"] = read_snapshots(spark, layout.snapshot_log).count()

    monkeypatch.setattr("tidemark.plans.load.append_jdbc", record)
    target = Relational("jdbc:x:y")
    path = landing("b.csv", BATSMEN_HEADER, BATSMEN_ROWS[3])
    load(spark, BATSMEN, path, layout, relational=target)
    assert appended == {
        "batsmen": ([("Whole Number", "batsmen_20250418_093000")], target), "registered": 0,
    }


def test_a_second_file_of_a_finished_run_is_refused(spark, landing, layout):
    load(spark, BATSMEN, landing("a.csv", BATSMEN_HEADER, *BATSMEN_ROWS), layout)
    second = landing("b.csv", BATSMEN_HEADER, *BATSMEN_ROWS[:1])
    with pytest.raises(FileExistsError, match="replace=True"):
        load(spark, BATSMEN, second, layout)
    assert read_serving(spark, layout.table("batsmen")).count() == len(BATSMEN_ROWS)
    assert Path(second).exists()


def test_snapshot_has_the_columns_of_the_table(spark, tmp_path, landing, layout):
    job = Job("t", StructType(), ())
    path = landing("a.csv", "k,v,w", "1,2.5,3")
    run_load(spark, job, path, layout, START, infer=True, clock=lambda: END)
    narrow = landing("b.csv", "k,w", "4,5")
    later = datetime(2025, 4, 19, 9, 30)
    run_load(spark, job, narrow, layout, later, infer=True, clock=lambda: END)
    snapshot = spark.read.csv(f"{layout.snapshots}/t_20250419_093000").first()
    assert tuple(snapshot)[:3] == ("4", None, "5")
    whole = landing("c.csv", "k,v,w", "7,8,9")
    again = datetime(2025, 4, 20, 9, 30)
    assert run_load(spark, job, whole, layout, again, infer=True, clock=lambda: END) == 1


def test_a_failure_after_the_serving_write_leaves_no_rows(spark, landing, layout, monkeypatch):
    def broken(*_):
        raise OSError("no space")

    monkeypatch.setattr("tidemark.plans.load.write_snapshot", broken)
    path = landing("a.csv", BATSMEN_HEADER, *BATSMEN_ROWS)
    with pytest.raises(OSError, match="no space"):
        load(spark, BATSMEN, path, layout)
    monkeypatch.undo()
    table = Path(layout.table("batsmen"))
    assert not list(table.glob("partition_name=*"))
    assert load(spark, BATSMEN, path, layout) == len(BATSMEN_ROWS)


FAILING = ["write_serving", "write_snapshot", "move", "log_metric", "log_snapshot"]


@pytest.mark.parametrize("step", FAILING)
@pytest.mark.parametrize("kind", ["first", "retry", "replacement"])
def test_a_failure_at_any_step_loses_nothing(spark, landing, layout, monkeypatch, step, kind):
    """What an earlier good load has left stays: rows, snapshot, registry entry and metric."""
    name = "batsmen_20250418_093000"
    if kind == "replacement":
        first = landing("b.csv", BATSMEN_HEADER, *BATSMEN_ROWS)
        load(spark, BATSMEN, first, layout, run_id="run_1")
    path = landing("b.csv", BATSMEN_HEADER, BATSMEN_ROWS[0])
    module = "tidemark.plans.load"

    def broken(*_):
        raise OSError("lost")

    def fail():
        with pytest.raises(OSError, match="lost"):
            load(spark, BATSMEN, path, layout, run_id="run_1", replace=kind == "replacement")

    for times in range(2 if kind == "retry" else 1):
        if step == "move":
            from tidemark.plans import load as loading

            move = loading.move_folder
            calls = []

            def second(spark, source, target):
                calls.append(target)
                if len(calls) == 4:
                    raise OSError("lost")
                return move(spark, source, target)

            monkeypatch.setattr(f"{module}.move_folder", second)
        elif step.startswith("log"):
            real, calls = getattr(__import__(module, fromlist=[step]), step), []

            def once(*args, real=real, calls=calls):
                calls.append(1)
                if len(calls) == 1:
                    raise OSError("lost")
                return real(*args)

            monkeypatch.setattr(f"{module}.{step}", once)
        else:
            monkeypatch.setattr(f"{module}.{step}", broken)
        fail()
        monkeypatch.undo()
    kept = len(BATSMEN_ROWS) if kind == "replacement" else 0
    assert len(list(Path(layout.table("batsmen")).glob("partition_name=*"))) == (kept > 0)
    assert not list(Path(layout.table("batsmen")).glob("_load*"))
    assert read_snapshots(spark, layout.snapshot_log).count() == (kept > 0)
    assert Path(layout.snapshots, name).is_dir() == (kept > 0)
    if kept:
        assert read_serving(spark, layout.table("batsmen")).count() == kept
        assert spark.read.csv(f"{layout.snapshots}/{name}").count() == kept
        assert rows(read_metrics(spark, layout.metrics)) == [("run_1", "batsmen", kept)]
    assert Path(path).exists()
    assert load(spark, BATSMEN, path, layout, run_id="run_1", replace=kept > 0) == 1
    assert read_serving(spark, layout.table("batsmen")).count() == 1
    assert rows(read_metrics(spark, layout.metrics)) == [("run_1", "batsmen", 1)]
    archives = sorted(p.name for p in Path(layout.archive).iterdir())
    assert archives == ([name, f"{name}.2"] if kept else [name])


def test_a_killed_replacement_is_put_back(spark, landing, layout):
    load(spark, BATSMEN, landing("b.csv", BATSMEN_HEADER, *BATSMEN_ROWS), layout)
    name = "batsmen_20250418_093000"
    table = Path(layout.table("batsmen"))
    (table / f"_load-{name}").mkdir()
    (table / f"partition_name={name}").rename(table / f"_load-{name}" / "old")
    broken = landing("b.csv", "player_name,total_runs", "A,1")
    with pytest.raises(ValueError):
        load(spark, BATSMEN, broken, layout, replace=True)
    again = landing("c.csv", BATSMEN_HEADER, "only,one,column")
    assert load(spark, BATSMEN, again, layout, replace=True) == 1
