from __future__ import annotations

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from conftest import END, START, rows

from tidemark.sinks import (
    Relational,
    append_jdbc,
    drop_partition,
    log_metric,
    log_run,
    log_snapshot,
    write_serving,
    write_snapshot,
)
from tidemark.sources import read_metrics, read_runs, read_serving, read_snapshots
from tidemark.storage import move_into, new_folder, shared_root


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_append_and_rerun(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_serving(frame(spark, 1, 2), path, "x_1") == 2
    assert write_serving(frame(spark, 3), path, "x_2") == 1
    assert write_serving(frame(spark, 4, 5, 6), path, "x_2") == 3
    assert rows(read_serving(spark, path)) == [
        (1, "x_1"), (2, "x_1"), (4, "x_2"), (5, "x_2"), (6, "x_2"),
    ]


def test_rerun_without_rows_leaves_none(spark, tmp_path):
    path = str(tmp_path / "t")
    write_serving(frame(spark, 1), path, "x_1")
    write_serving(frame(spark, 2), path, "x_2")
    assert write_serving(frame(spark, 3).where("v > 9"), path, "x_2") == 0
    assert rows(read_serving(spark, path)) == [(1, "x_1")]


def test_name_like_a_number_stays_text(spark, tmp_path):
    path = str(tmp_path / "t")
    write_serving(frame(spark, 1), path, "20250101")
    assert rows(read_serving(spark, path)) == [(1, "20250101")]


def test_columns_are_matched_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    write_serving(spark.createDataFrame([(1, "a")], "i int, s string"), path, "x_1")
    write_serving(spark.createDataFrame([("b", 2)], "s string, I int"), path, "x_2")
    write_serving(spark.createDataFrame([("c",)], "s string"), path, "x_3")
    assert rows(read_serving(spark, path)) == [
        (1, "a", "x_1"), (2, "b", "x_2"), (None, "c", "x_3"),
    ]
    with pytest.raises(ValueError, match="extra"):
        write_serving(spark.createDataFrame([(1, 2)], "i int, extra int"), path, "x_4")
    with pytest.raises(ValueError, match="types"):
        write_serving(spark.createDataFrame([(1.0,)], "i double"), path, "x_4")
    assert read_serving(spark, path).count() == 3


def test_narrower_numbers_are_widened(spark, tmp_path):
    path = str(tmp_path / "t")
    write_serving(spark.createDataFrame([(1.5, 2**40)], "d double, l long"), path, "x_1")
    write_serving(spark.createDataFrame([(7, 8)], "d int, l int"), path, "x_2")
    assert rows(read_serving(spark, path)) == [(1.5, 2**40, "x_1"), (7.0, 8, "x_2")]


def test_the_only_run_may_change_its_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    write_serving(spark.createDataFrame([(1,)], "i int"), path, "x_1")
    write_serving(spark.createDataFrame([("a",)], "s string"), path, "x_1")
    assert rows(read_serving(spark, path)) == [("a", "x_1")]


def test_drop_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    write_serving(frame(spark, 1), path, "x_1")
    write_serving(frame(spark, 2), path, "x_2")
    assert drop_partition(spark, path, "x_1")
    assert not drop_partition(spark, path, "x_1")
    assert rows(read_serving(spark, path)) == [(2, "x_2")]
    with pytest.raises(ValueError):
        drop_partition(spark, path, "../other")


def test_snapshot_text_format(spark, tmp_path):
    folder = tmp_path / "s"
    data = [(1, None), (2, ""), (3, 'q"r'), (4, "a,b"), (5, " x ")]
    source = spark.createDataFrame(data, "i int, v string").coalesce(1)
    write_snapshot(source, str(folder))
    write_snapshot(source, str(folder))
    lines = [line for part in folder.glob("part*.csv") for line in part.read_text().splitlines()]
    assert lines == ["1,", '2,""', '3,"q\\"r"', '4,"a,b"', "5,x"]


def test_empty_snapshot_still_has_its_folder(spark, tmp_path):
    write_snapshot(frame(spark, 1).where("v > 9"), str(tmp_path / "s"))
    assert (tmp_path / "s").is_dir()


def test_registries(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        log_snapshot(spark, f"{root}/s", "bowlers", "bowlers_1", "/partitions", START)
        log_metric(spark, f"{root}/m", "run_1", "bowlers", 447)
    log_run(spark, f"{root}/r", "run_1", "bowlers_script", START, END, "Failed")
    log_run(spark, f"{root}/r", "run_1", "bowlers_script", START, END, "Success")
    log_run(spark, f"{root}/r", "run_1", "batsmen_script", START, END, "Success")
    assert rows(read_snapshots(spark, f"{root}/s")) == [
        ("bowlers", "bowlers_1", "/partitions/bowlers_1", date(2025, 4, 18))
    ]
    assert rows(read_metrics(spark, f"{root}/m")) == [("run_1", "bowlers", 447)]
    runs = read_runs(spark, f"{root}/r")
    assert runs.count() == 3
    row = runs.where("status = 'Failed'").first()
    assert row["execution_date"] == date(2025, 4, 18)
    assert row["run_time"] == timedelta(seconds=90) and row["run_seconds"] == 90.0
    assert (row["start_time"], row["end_time"]) == (START, END)


def test_timestamps_follow_the_session_time_zone(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        late = datetime(2025, 4, 18, 23, 50)
        log_run(spark, f"{tmp_path}/r", "run_1", "x_script", late, late, "Success")
        row = read_runs(spark, f"{tmp_path}/r").selectExpr(
            "execution_date", "cast(start_time as string)"
        ).first()
        assert tuple(row) == (date(2025, 4, 18), "2025-04-18 23:50:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_move_is_checked(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a\n1\n")
    archive = str(tmp_path / "archives")
    move_into(spark, [str(tmp_path / "x.csv")], archive)
    assert (tmp_path / "archives" / "x.csv").exists() and not (tmp_path / "x.csv").exists()
    (tmp_path / "x.csv").write_text("a\n2\n")
    with pytest.raises(FileExistsError):
        move_into(spark, [str(tmp_path / "x.csv")], archive)
    assert (tmp_path / "x.csv").exists()
    with pytest.raises(OSError):
        move_into(spark, [str(tmp_path / "absent.csv")], archive)


def test_shared_folder_is_the_configured_one(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert Path(new_folder(spark, "x")).parent.parent == Path(shared_root(spark))


class RecordingWriter:
    def __init__(self):
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def save(self):
        self.calls["saved"] = True


def test_jdbc_append_takes_everything_as_options():
    """No database is started here; only what is handed to Spark's writer is checked."""

    class Frame:
        write = RecordingWriter()

    options = {"user": "u", "password": "p", "driver": "d", "batchsize": "500"}
    append_jdbc(Frame, "bowlers", Relational("jdbc:x:y", options, connections=4))
    assert Frame.write.calls == {
        "format": "jdbc",
        "mode": "append",
        "saved": True,
        "options": {
            "url": "jdbc:x:y", "dbtable": "bowlers", "user": "u", "password": "p",
            "driver": "d", "batchsize": "500", "numPartitions": "4",
        },
    }
