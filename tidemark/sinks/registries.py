"""Registries of snapshots, runs and inserted rows.

Every writer has a file or folder of its own, so loads that end at the same time do not
meet, and a rerun replaces its own rows only. The snapshot registry is one flat folder of
files, because reconcile reads all of it; the others have a folder per run, because the
report reads a single run.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import check_name, run_date, run_duration, snapshot_path
from tidemark.storage import remove_folder, write_as_file


def _moment(moment: datetime):
    """A timestamp literal that reads as ``moment`` in the session's time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def _one_row(spark: SparkSession, **values) -> DataFrame:
    row = spark.range(0, 1, 1, 1)
    return row.select(*[value.alias(name) for name, value in values.items()])


def snapshot_entries(runs: DataFrame, root: str) -> DataFrame:
    """Snapshot registry rows of ``runs(table_name, partition_name, started_at)``."""
    return runs.select(
        "table_name",
        "partition_name",
        snapshot_path(F.col("partition_name"), root).alias("hdfs_path"),
        run_date(F.col("started_at")).alias("date"),
    )


def run_entries(runs: DataFrame) -> DataFrame:
    """Run registry rows of ``runs(run_id, script_name, start_time, end_time, status)``.

    The duration is kept twice: as an interval and, for sinks without that type, in seconds.
    """
    start, end = F.col("start_time").cast("timestamp"), F.col("end_time").cast("timestamp")
    seconds = (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)
    return runs.select(
        "run_id",
        "script_name",
        run_date(start).alias("execution_date"),
        start.alias("start_time"),
        end.alias("end_time"),
        run_duration(start, end).alias("run_time"),
        seconds.alias("run_seconds"),
        "status",
    )


def log_snapshot(
    spark: SparkSession, path: str, table: str, partition_name: str, root: str, moment: datetime
) -> None:
    run = _one_row(
        spark,
        table_name=F.lit(table),
        partition_name=F.lit(partition_name),
        started_at=_moment(moment),
    )
    write_as_file(snapshot_entries(run, root), snapshot_entry_file(path, partition_name))


def snapshot_entry_file(path: str, partition_name: str) -> str:
    return f"{path}/{check_name(partition_name)}.parquet"


def forget_snapshot(spark: SparkSession, path: str, partition_name: str) -> bool:
    """Take a run off the snapshot registry; False if it is not on it."""
    return remove_folder(spark, snapshot_entry_file(path, partition_name))


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    script: str,
    started_at: datetime,
    ended_at: datetime,
    status: str,
) -> None:
    """Append; a second attempt of the same run adds a second row."""
    run = _one_row(
        spark,
        run_id=F.lit(run_id),
        script_name=F.lit(script),
        start_time=_moment(started_at),
        end_time=_moment(ended_at),
        status=F.lit(status),
    )
    entry = run_entries(run).drop("run_id", "script_name")
    folder = f"{path}/run_id={check_name(run_id)}/script_name={check_name(script)}"
    entry.write.mode("append").parquet(folder)


def log_metric(spark: SparkSession, path: str, run_id: str, table: str, rows: int) -> None:
    entry = _one_row(spark, inserted_rows=F.lit(rows).cast("bigint"))
    folder = f"{path}/run_id={check_name(run_id)}/table_name={check_name(table)}"
    entry.write.mode("overwrite").parquet(folder)


def log_sketches(
    spark: SparkSession, path: str, run_id: str, table: str, sketches: Mapping[str, bytes]
) -> None:
    """One row for each column's sketch; a rerun of the run replaces them."""
    entries = spark.createDataFrame(
        [(name, bytearray(sketch)) for name, sketch in sketches.items()],
        "column_name string, sketch binary",
    )
    folder = f"{path}/run_id={check_name(run_id)}/table_name={check_name(table)}"
    entries.coalesce(1).write.mode("overwrite").parquet(folder)
