"""Queries over ordered rows and intervals, grouping sets and multisets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import asof_join, cube_totals, previous_value, range_join, running_total
from workload.inputs import given


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "ts",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )


def asof_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its user's last purchase until then."""
    events = _events(spark, sf_dir)
    bought = events.where("event_type = 'purchase'").select(
        "user_id", "ts", F.col("event_id").alias("purchase_id"), F.col("cents").alias("paid")
    )
    return asof_join(
        events.drop("cents"), bought, ["user_id"], "ts", "ts", ["purchase_id", "paid"]
    )


def events_in_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the minutes after every error, as many minutes as the error's value."""
    events = _events(spark, sf_dir)
    windows = events.where("event_type = 'error'").select(
        F.col("event_id").alias("error_id"),
        F.col("ts").alias("begin"),
        (F.col("ts") + F.make_dt_interval(mins=F.floor(F.col("cents") / 100).cast("int"))).alias(
            "end"
        ),
    )
    pairs = range_join(events, windows, "ts", "begin", "end")
    return pairs.groupBy("error_id").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("cents").alias("cents")
    )


def running_total_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the total of its type until then; a type has a third of all rows."""
    return running_total(
        _events(spark, sf_dir), ["event_type"], ["ts", "event_id"], "cents", "cents_so_far"
    )


def previous_value_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with the cents of the event of its type before it."""
    return previous_value(
        _events(spark, sf_dir), ["event_type"], ["ts", "event_id"], "cents", "cents_before"
    )


def outcomes_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and whole prices by status and priority, and all totals of these; one status is
    unknown, which is not its total."""
    orders = given(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.floor("o_totalprice").cast("bigint").alias("price"),
    )
    return cube_totals(orders, ["status", "priority"], "price")


def _pairs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = given(spark, sf_dir, "lineitem")
    sold = lines.select("l_returnflag", F.col("l_linenumber").alias("n"))
    late = lines.where("l_quantity > 25").select("l_returnflag", F.col("l_linenumber").alias("n"))
    return sold, late


def rows_except_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag and number of all lines, without as many of each as there are large lines."""
    sold, late = _pairs(spark, sf_dir)
    return sold.exceptAll(late)


def rows_intersect_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag and number of large lines as often as all lines have them, at most."""
    sold, late = _pairs(spark, sf_dir)
    return late.intersectAll(sold)


QUERIES = {
    "asof_event": asof_event,
    "events_in_windows": events_in_windows,
    "running_total": running_total_query,
    "previous_value": previous_value_query,
    "outcomes_cube": outcomes_cube,
    "rows_except_all": rows_except_all,
    "rows_intersect_all": rows_intersect_all,
}

_EVENTS = """
        WITH e AS (
            SELECT event_id, user_id, event_type, ts, CAST(round(value * 100) AS BIGINT) AS cents
            FROM events)"""
_PAIRS = """
        WITH sold AS (SELECT l_returnflag, l_linenumber AS n FROM lineitem),
             late AS (SELECT l_returnflag, l_linenumber AS n FROM lineitem WHERE l_quantity > 25)"""

ORACLE = {
    "asof_event": f"""{_EVENTS}
        SELECT e.event_id, e.user_id, e.event_type, e.ts, p.event_id AS purchase_id,
               p.cents AS paid
        FROM e ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'purchase') AS p
          ON e.user_id = p.user_id AND e.ts >= p.ts""",
    "events_in_windows": f"""{_EVENTS}, w AS (
            SELECT event_id AS error_id, ts AS low,
                   ts + to_minutes(CAST(cents // 100 AS BIGINT)) AS high
            FROM e WHERE event_type = 'error')
        SELECT error_id, count(*) AS n_events, CAST(sum(cents) AS BIGINT) AS cents
        FROM e JOIN w ON ts >= low AND ts < high GROUP BY error_id""",
    "running_total": f"""{_EVENTS}
        SELECT *, CAST(sum(cents) OVER (PARTITION BY event_type ORDER BY ts, event_id
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cents_so_far FROM e""",
    "previous_value": f"""{_EVENTS}
        SELECT *, lag(cents) OVER (PARTITION BY event_type ORDER BY ts, event_id)
            AS cents_before FROM e""",
    "outcomes_cube": """
        WITH o AS (
            SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
                   o_orderpriority AS priority, CAST(floor(o_totalprice) AS BIGINT) AS price
            FROM orders)
        SELECT status, priority, CAST(grouping(status) * 2 + grouping(priority) AS INTEGER) AS level,
               count(*) AS rows, CAST(sum(price) AS BIGINT) AS total
        FROM o GROUP BY CUBE (status, priority)""",
    "rows_except_all": f"{_PAIRS} SELECT * FROM sold EXCEPT ALL SELECT * FROM late",
    "rows_intersect_all": f"{_PAIRS} SELECT * FROM late INTERSECT ALL SELECT * FROM sold",
}
