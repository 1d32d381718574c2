"""Row-count report over the tables of one run."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import capitalise
from tidemark.operators import (
    concatenate,
    distinct_counts,
    last_attempts,
    lookup,
    row_count,
    run_outcome,
    succeeded_only,
    with_status,
)
from tidemark.sources import read_metrics, read_runs, read_serving
from tidemark.plans.jobs import JOBS
from tidemark.plans.layout import Layout
from tidemark.storage import exists


def table_counts(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """``(position, script_name, table, total_rows, status)``, one row per table.

    ``tables`` gives the serving path of each table, in report order. A table that cannot
    be opened or read gets its error as status; the others are counted all the same. Each table
    is counted here, one number each, so that a damaged file cannot end the whole report.
    """
    frames = []
    for position, (table, path) in enumerate(tables.items()):
        try:
            if not exists(spark, path):
                raise FileNotFoundError(path)
            total = row_count(read_serving(spark, path)).first()["total_rows"]
            counted = spark.range(0, 1, 1, 1).select(
                F.lit(total).cast("bigint").alias("total_rows"), F.lit("OK").alias("status")
            )
        except (PySparkException, Py4JJavaError, FileNotFoundError) as error:
            reason = f"Error fetching data - {type(error).__name__}"
            counted = spark.range(0, 1, 1, 1).select(
                F.lit(None).cast("bigint").alias("total_rows"), F.lit(reason).alias("status")
            )
        frames.append(
            counted.select(
                F.lit(position).alias("position"),
                F.lit(f"{table}_script").alias("script_name"),
                F.lit(table).alias("table"),
                "total_rows",
                "status",
            )
        )
    return concatenate(frames)


def row_count_report(counts: DataFrame, runs: DataFrame, metrics: DataFrame) -> DataFrame:
    """``(position, label, table, total_rows, inserted_rows, status)``.

    Only tables whose task succeeded are listed; a table without a stored count shows
    ``N/A``. ``runs`` and ``metrics`` are those of one run.
    """
    listed = succeeded_only(counts, with_status(runs, "Success"), "script_name")
    inserted = metrics.select(F.col("table_name").alias("table"), "inserted_rows")
    return lookup(listed, inserted, "table", "inserted_rows").select(
        "position",
        F.concat(capitalise(F.col("table")), F.lit(" Table")).alias("label"),
        "table",
        "total_rows",
        "inserted_rows",
        "status",
    )


def outcome_report(runs: DataFrame, without: Collection[str] = ()) -> DataFrame:
    """``(run_id, any_success, any_failed, failed_tasks)`` of the run registry.

    ``failed_tasks`` are the names of the tasks that failed, in order and comma-joined, minus
    those ``without``; empty if there is none. What counts of a task is its last attempt, so one
    that failed and was then retried with success has not failed.
    """
    runs = last_attempts(runs)
    failed = with_status(runs, "Failed", without).groupBy("run_id").agg(
        F.array_join(F.sort_array(F.collect_set("script_name")), ",").alias("failed_tasks")
    )
    return lookup(run_outcome(runs), failed, "run_id", "failed_tasks", default="")


def distinct_report(sketches: DataFrame) -> DataFrame:
    """``(run_id, table_name, column_name, distinct_values)`` of the sketch registry: a row for
    every run, and one with a NULL run for all runs together, where a value counts once. Rows
    of the runs are not read."""
    by_run = distinct_counts(sketches, ["run_id", "table_name", "column_name"])
    overall = distinct_counts(sketches, ["table_name", "column_name"])
    return concatenate([by_run, overall.withColumn("run_id", F.lit(None).cast("string"))])


def report_for(spark: SparkSession, layout: Layout, run_id: str) -> DataFrame:
    """The report of one run over the tables of all jobs, in report order."""
    tables = {job.table: layout.table(job.table) for job in JOBS}
    return row_count_report(
        table_counts(spark, tables),
        last_attempts(read_runs(spark, layout.run_log, run_id)),
        read_metrics(spark, layout.metrics, run_id),
    ).orderBy("position")
