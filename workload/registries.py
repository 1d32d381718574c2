"""Registries, the row-count report and reconcile."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import parse_int, run_name, run_name_column
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
from tidemark.plans.jobs import BATSMEN, BOWLERS, DELIVERIES, MATCHES
from tidemark.plans.layout import Layout
from tidemark.plans.load import run_load
from tidemark.plans.reconcile import missing_snapshots, reconcile
from tidemark.plans.report import outcome_report, report_for, row_count_report, table_counts
from tidemark.sinks import (
    log_metric,
    log_run,
    log_snapshot,
    write_runs,
    write_serving,
    write_snapshot,
)
from tidemark.sinks.registries import run_entries, snapshot_entries
from tidemark.sources import (
    read_metrics,
    read_partition,
    read_runs,
    read_serving,
    read_snapshots,
)
from tidemark.storage import folder_names, new_folder
from workload.inputs import RUN_END, RUN_START, given, land


def registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot registry row per event type and day, named after its first event."""
    runs = (
        given(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("table_name"), F.to_date("ts").alias("day"))
        .agg(F.min("ts").alias("started_at"))
        .withColumn("partition_name", run_name_column(F.col("table_name"), F.col("started_at")))
    )
    return snapshot_entries(runs, "/partitions")


def run_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user and event type, from its first to its last event."""
    runs = (
        given(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("string").alias("run_id"), F.col("event_type"))
        .agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"))
        .withColumnRenamed("event_type", "script_name")
        .withColumn("status", F.lit("Success"))
    )
    return run_entries(runs).select(
        "run_id", "script_name", "execution_date", "run_seconds", "status"
    )


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return run_outcome(orders, ["day"], "o_orderstatus", success="O", failure="F")


def status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_status(
        given(spark, sf_dir, "orders"),
        "F",
        without=("1-URGENT",),
        status_column="o_orderstatus",
        task_column="o_orderpriority",
    )


def succeeded_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an urgent order that is done."""
    done = given(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    )
    return succeeded_only(
        given(spark, sf_dir, "customer"), done.withColumnRenamed("o_custkey", "c_custkey"),
        "c_custkey",
    )


def metric_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored counts are text with spaces around; a customer without one shows N/A."""
    stored_text = F.concat(F.lit(" "), F.count(F.lit(1)), F.lit(" "))
    counts = (
        given(spark, sf_dir, "orders")
        .where(F.col("o_orderpriority") == "1-URGENT")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(stored_text.alias("text"))
        .select("c_custkey", parse_int(F.col("text")).alias("urgent_orders"))
    )
    customers = given(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return lookup(customers, counts, "c_custkey", "urgent_orders")


def union_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    return concatenate(
        [
            row_count(given(spark, sf_dir, name)).select(F.lit(name).alias("table"), "total_rows")
            for name in tables
        ]
    )


def row_count_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four tables and one that cannot be opened; one task failed, two have no count."""
    root = new_folder(spark, "report")
    done = given(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O")
    tables = {
        name: f"{sf_dir}/{name}.parquet" for name in ("orders", "customer", "supplier", "part")
    }
    tables["absent"] = f"{root}/absent"
    log_metric(
        spark, f"{root}/metrics", "run_1", "orders",
        write_serving(done, f"{root}/orders", "orders_1"),
    )
    log_metric(
        spark, f"{root}/metrics", "run_1", "customer",
        write_serving(given(spark, sf_dir, "customer"), f"{root}/customer", "customer_1"),
    )
    for name in tables:
        status = "Failed" if name == "supplier" else "Success"
        log_run(spark, f"{root}/runs", "run_1", f"{name}_script", RUN_START, RUN_END, status)
    return row_count_report(
        table_counts(spark, tables),
        read_runs(spark, f"{root}/runs"),
        read_metrics(spark, f"{root}/metrics"),
    )


def _two_loads(spark: SparkSession, sf_dir: str) -> Layout:
    """Two whole loads of one run, both of all parts."""
    root = new_folder(spark, "two_loads")
    layout = Layout.below(root)
    part = given(spark, sf_dir, "part")
    for job in (BATSMEN, BOWLERS):
        columns = [
            F.col("p_name" if name == "player_name" else "p_size").alias(name)
            for name in job.declared.names
        ]
        landing = f"{root}/files/{job.table}"
        land(part.select(*columns), landing)
        run_load(
            spark, job, landing, layout, RUN_START, run_id="run_1", clock=lambda: RUN_END
        )
    return layout


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a run of which two tables did not take part."""
    return report_for(spark, _two_loads(spark, sf_dir), "run_1")


def run_outcome_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run of two loads that end well and two whose file lacks declared columns, one of them
    not reported."""
    layout = _two_loads(spark, sf_dir)
    landing = f"{layout.archive}/{run_name(BATSMEN.table, RUN_START)}"
    for job in (MATCHES, DELIVERIES):
        with suppress(ValueError):
            run_load(
                spark, job, landing, layout, RUN_START, run_id="run_1", clock=lambda: RUN_END
            )
    report = outcome_report(read_runs(spark, layout.run_log), without=("deliveries_script",))
    metrics = read_metrics(spark, layout.metrics).groupBy("run_id")
    return report.join(metrics.agg(F.max("inserted_rows").alias("rows_loaded")), "run_id")


def load_registries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two loads leave in the three registries."""
    layout = _two_loads(spark, sf_dir)
    runs = read_runs(spark, layout.run_log, "run_1").withColumn(
        "table_name", F.regexp_replace("script_name", "_script$", "")
    )
    snapshots = read_snapshots(spark, layout.snapshot_log)
    return (
        runs.join(read_metrics(spark, layout.metrics, "run_1"), ["run_id", "table_name"])
        .join(snapshots, "table_name")
        .select(
            "run_id", "script_name", "execution_date", "run_seconds", "status",
            "table_name", "partition_name", "date", "inserted_rows",
        )
    )


def _yearly_runs(spark: SparkSession, sf_dir: str, root: str) -> Layout:
    """One run of orders per year, all registered; snapshots before 1998 are gone."""
    layout = Layout.below(root)
    name = F.concat(F.lit("orders_"), F.year("o_orderdate"))
    orders = given(spark, sf_dir, "orders")
    table = layout.table("orders")
    write_runs(orders.withColumn("partition_name", name), table)
    for folder in sorted(folder_names(spark, table)):
        run = folder.removeprefix("partition_name=")
        if run >= "orders_1998":
            rows = read_partition(spark, table, run, orders.schema)
            write_snapshot(rows, f"{layout.snapshots}/{run}")
        log_snapshot(spark, layout.snapshot_log, "orders", run, layout.snapshots, RUN_START)
    return layout


def missing_snapshots_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_snapshots(spark, _yearly_runs(spark, sf_dir, new_folder(spark, "missing")))


def reconcile_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition folders of the missing runs are dropped."""
    layout = _yearly_runs(spark, sf_dir, new_folder(spark, "reconcile"))
    reconcile(spark, layout, tables=("orders",))
    return read_serving(spark, layout.table("orders"))


def delete_listed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the smallest part sizes go."""
    small = given(spark, sf_dir, "part").where(F.col("p_size") <= 5)
    return delete_rows(
        given(spark, sf_dir, "lineitem"), small.withColumnRenamed("p_partkey", "l_partkey"),
        "l_partkey",
    )


def delete_joined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of most parts go."""
    large = given(spark, sf_dir, "part").where(F.col("p_size") > 5)
    return delete_rows(
        given(spark, sf_dir, "lineitem"), large.withColumnRenamed("p_partkey", "l_partkey"),
        "l_partkey",
    )


def without_urgent_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an urgent order: the anti join of the registry check on other keys."""
    urgent = given(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    customers = given(spark, sf_dir, "customer")
    return missing_from(customers, urgent.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


QUERIES = {
    "registry_rows": registry_rows,
    "run_duration": run_duration,
    "run_status": run_status,
    "status_filter": status_filter,
    "succeeded_tables": succeeded_tables,
    "metric_lookup": metric_lookup,
    "union_counts": union_counts,
    "row_count_report": row_count_report_query,
    "load_report": load_report,
    "load_registries": load_registries,
    "run_outcome_report": run_outcome_report,
    "missing_snapshots": missing_snapshots_query,
    "reconcile_delete": reconcile_delete,
    "delete_listed_rows": delete_listed_rows,
    "delete_joined_rows": delete_joined_rows,
    "without_urgent_order": without_urgent_order,
}

ORACLE = {
    "registry_rows": """
        SELECT event_type AS table_name,
               event_type || '_' || strftime(min(ts), '%Y%m%d_%H%M%S') AS partition_name,
               '/partitions/' || event_type || '_' || strftime(min(ts), '%Y%m%d_%H%M%S')
               AS hdfs_path,
               CAST(min(ts) AS DATE) AS date
        FROM events GROUP BY event_type, CAST(ts AS DATE)""",
    "run_duration": """
        SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS script_name,
               CAST(min(ts) AS DATE) AS execution_date,
               CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / CAST(1000000 AS DOUBLE)
               AS run_seconds,
               'Success' AS status
        FROM events GROUP BY user_id, event_type""",
    "run_status": """
        SELECT CAST(o_orderdate AS DATE) AS day, bool_or(o_orderstatus = 'O') AS any_success,
               bool_or(o_orderstatus = 'F') AS any_failed
        FROM orders GROUP BY 1""",
    "status_filter": """
        SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority NOT IN ('1-URGENT')""",
    "succeeded_tables": """
        SELECT * FROM customer WHERE c_custkey IN (
            SELECT o_custkey FROM orders
            WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')""",
    "metric_lookup": """
        WITH counts AS (
            SELECT o_custkey, count(*) AS n FROM orders
            WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)
        SELECT c_custkey, c_name, coalesce(CAST(n AS VARCHAR), 'N/A') AS urgent_orders
        FROM customer LEFT JOIN counts ON o_custkey = c_custkey""",
    "union_counts": """
        SELECT 'region' AS "table", count(*) AS total_rows FROM region
        UNION ALL SELECT 'nation', count(*) FROM nation
        UNION ALL SELECT 'customer', count(*) FROM customer
        UNION ALL SELECT 'supplier', count(*) FROM supplier
        UNION ALL SELECT 'part', count(*) FROM part
        UNION ALL SELECT 'orders', count(*) FROM orders
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem
        UNION ALL SELECT 'events', count(*) FROM events""",
    "row_count_report": """
        SELECT 0 AS position, 'Orders Table' AS label, 'orders' AS "table",
               count(*) AS total_rows,
               CAST(count(*) FILTER (o_orderstatus = 'O') AS VARCHAR) AS inserted_rows,
               'OK' AS status FROM orders
        UNION ALL
        SELECT 1, 'Customer Table', 'customer', count(*), CAST(count(*) AS VARCHAR), 'OK'
        FROM customer
        UNION ALL
        SELECT 3, 'Part Table', 'part', count(*), 'N/A', 'OK' FROM part
        UNION ALL
        SELECT 4, 'Absent Table', 'absent', NULL, 'N/A',
               'Error fetching data - FileNotFoundError'""",
    "load_report": """
        SELECT 2 AS position, 'Batsmen Table' AS label, 'batsmen' AS "table",
               count(*) AS total_rows, CAST(count(*) AS VARCHAR) AS inserted_rows,
               'OK' AS status FROM part
        UNION ALL
        SELECT 3, 'Bowlers Table', 'bowlers', count(*), CAST(count(*) AS VARCHAR), 'OK'
        FROM part""",
    "run_outcome_report": """
        SELECT 'run_1' AS run_id, true AS any_success, true AS any_failed,
               'matches_script' AS failed_tasks, count(*) AS rows_loaded FROM part""",
    "load_registries": """
        SELECT 'run_1' AS run_id, t || '_script' AS script_name,
               DATE '2025-04-18' AS execution_date, CAST(90 AS DOUBLE) AS run_seconds,
               'Success' AS status, t AS table_name,
               t || '_20250418_093000' AS partition_name, DATE '2025-04-18' AS date,
               (SELECT count(*) FROM part) AS inserted_rows
        FROM (VALUES ('batsmen'), ('bowlers')) AS v(t)""",
    "missing_snapshots": """
        SELECT DISTINCT 'orders_' || year(o_orderdate) AS partition_name FROM orders
        WHERE year(o_orderdate) < 1998""",
    "reconcile_delete": """
        SELECT *, 'orders_' || year(o_orderdate) AS partition_name FROM orders
        WHERE year(o_orderdate) >= 1998""",
    "delete_listed_rows": """
        SELECT * FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 5)""",
    "delete_joined_rows": """
        SELECT * FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)""",
    "without_urgent_order": """
        SELECT c_custkey FROM customer WHERE NOT EXISTS (
            SELECT 1 FROM orders
            WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""",
}
