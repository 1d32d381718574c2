"""Queries over tables that change: versions, deletes, totals across runs, compacted registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import last_attempts
from tidemark.plans.report import outcome_report
from tidemark.plans.totals import RunningTotals
from tidemark.sinks.log import RegistryLog
from tidemark.sinks.registries import run_entries, snapshot_entries
from tidemark.storage import file_paths, new_folder
from tidemark.versions import VersionedTable
from workload.inputs import given


def total_across_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by user and type of all events, landed as four files in three overlapping drops."""
    root = new_folder(spark, "total_across_runs")
    events = given(spark, sf_dir, "events").select(
        "user_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.pmod("event_id", F.lit(4)).alias("file"),
    )
    for k in range(4):
        events.where(F.col("file").eqNullSafe(k) | (F.col("file").isNull() & F.lit(k == 0))).drop(
            "file"
        ).coalesce(1).write.parquet(f"{root}/files/f{k}")
    landed = sorted(f"{root}/files/{path}" for path in file_paths(spark, f"{root}/files"))
    totals = RunningTotals(spark, f"{root}/totals", ("user_id", "event_type"), "cents", 16)
    schema = events.drop("file").schema
    for drop in (landed[:2], landed[1:3], landed[1:]):
        totals.apply_files(drop, schema)
    return totals.read()


def publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders before and after the finished ones are replaced, each from its version."""
    table = VersionedTable(spark, new_folder(spark, "publish_versions"))
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    table.append(orders.where("o_orderstatus <> 'F'"), "open")
    old = table.append(orders.where("o_orderstatus = 'F'"), "finished")
    new = table.replace(
        orders.where("o_orderstatus = 'F'").withColumn("o_orderstatus", F.lit("X")), "finished"
    )
    return table.read(old).withColumn("version", F.lit(old)).unionByName(
        table.read(new).withColumn("version", F.lit(new))
    )


def delete_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines without those of partly filled orders, whose files are rewritten."""
    table = VersionedTable(spark, new_folder(spark, "delete_rewritten"))
    table.append(given(spark, sf_dir, "lineitem"))
    partly = given(spark, sf_dir, "orders").where("o_orderstatus = 'P'")
    table.delete(partly.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"])
    return table.read()


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as attempts: a run is a user, a task an event type, dear ones have failed."""
    failed = F.when(F.col("value") > 20, "Failed").otherwise("Success")
    return run_entries(
        given(spark, sf_dir, "events").select(
            F.col("user_id").cast("string").alias("run_id"),
            F.col("event_type").alias("script_name"),
            F.col("ts").alias("start_time"),
            F.col("ts").alias("end_time"),
            failed.alias("status"),
        )
    )


def run_outcome_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every run by the last attempts of its tasks."""
    return outcome_report(_attempts(spark, sf_dir))


def last_attempt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last attempt of every task."""
    found = last_attempts(_attempts(spark, sf_dir))
    return found.select("run_id", "script_name", "end_time", "status")


def registry_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot registry of a run for each day of orders, folded twice with entries between."""
    root = new_folder(spark, "registry_compacted")
    days = given(spark, sf_dir, "orders").groupBy(F.to_timestamp("o_orderdate").alias("started_at"))
    name = F.date_format("started_at", "yyyyMMdd_HHmmss")
    runs = days.count().select(
        F.lit("orders").alias("table_name"),
        F.concat(F.lit("orders_"), name).alias("partition_name"),
        "started_at",
    )
    entries = snapshot_entries(runs, "/partitions")
    log = RegistryLog(spark, root, schemas.SNAPSHOTS)
    # Entries come as the files of one writer here, so each half has a file of each task.
    early = F.year("date") < 1998
    entries.where(early).repartition(24).write.mode("append").parquet(f"{root}/log")
    log.compact()
    entries.where(~early).repartition(24).write.mode("append").parquet(f"{root}/log")
    log.compact()
    return log.read()


QUERIES = {
    "total_across_runs": total_across_runs,
    "publish_versions": publish_versions,
    "delete_rewritten": delete_rewritten,
    "run_outcome_last": run_outcome_last,
    "last_attempt_rows": last_attempt_rows,
    "registry_compacted": registry_compacted,
}

_LAST = """
        WITH last AS (
            SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS script_name, ts AS end_time,
                   CASE WHEN value > 20 THEN 'Failed' ELSE 'Success' END AS status
            FROM events
            QUALIFY row_number() OVER (
                PARTITION BY user_id, event_type ORDER BY ts DESC, value <= 20 DESC) = 1)"""

ORACLE = {
    "total_across_runs": """
        SELECT user_id, event_type, count(*) AS rows,
               CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total
        FROM events GROUP BY user_id, event_type""",
    "publish_versions": """
        SELECT o_orderkey, o_orderstatus, o_totalprice, 2 AS version FROM orders
        UNION ALL
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'X' ELSE o_orderstatus END,
               o_totalprice, 3
        FROM orders""",
    "delete_rewritten": """
        SELECT * FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""",
    "run_outcome_last": f"""{_LAST}
        SELECT run_id, bool_or(status = 'Success') AS any_success,
               bool_or(status = 'Failed') AS any_failed,
               coalesce(string_agg(script_name, ',' ORDER BY script_name)
                        FILTER (status = 'Failed'), '') AS failed_tasks
        FROM last GROUP BY run_id""",
    "last_attempt_rows": f"{_LAST} SELECT * FROM last",
    "registry_compacted": """
        SELECT DISTINCT 'orders' AS table_name,
               'orders_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') AS partition_name,
               '/partitions/orders_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') AS hdfs_path,
               CAST(o_orderdate AS DATE) AS date
        FROM orders""",
}
