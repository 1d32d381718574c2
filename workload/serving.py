"""Serving queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.serving import performance, performance_by, season_outcomes, top_k
from workload.inputs import given


def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_k(orders, "o_totalprice", ["o_orderkey"], 100)


def outcomes_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return season_outcomes(
        given(spark, sf_dir, "orders"),
        F.year("o_orderdate"),
        F.col("o_orderstatus") == "F",
        "failed",
    )


def team_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order figures per nation, market segment and status over two dimension tables."""
    orders = given(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,2)").alias("price")
    )
    customers = (
        given(spark, sf_dir, "customer")
        .join(given(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "c_mktsegment", "n_name")
    )
    result = performance_by(
        orders,
        "o_custkey",
        customers,
        "c_custkey",
        ["n_name", "c_mktsegment", "o_orderstatus"],
        {
            "orders": ("count", "price"),
            "revenue": ("sum", "price"),
            "smallest": ("min", "price"),
            "largest": ("max", "price"),
        },
    )
    return result.withColumn("revenue", F.col("revenue").cast("decimal(22,2)"))


def grouped_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", F.col("l_quantity").cast("int").alias("qty")
    )
    return performance(
        lines,
        ["l_returnflag", "l_linestatus"],
        {"lines": ("count", "qty"), "total_qty": ("sum", "qty"), "max_qty": ("max", "qty")},
    )


QUERIES = {
    "top_k": top_orders,
    "season_outcomes": outcomes_by_year,
    "team_performance": team_performance,
    "grouped_performance": grouped_performance,
}

ORACLE = {
    "top_k": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
    "season_outcomes": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS season, count(*) AS matches,
               count(*) FILTER (o_orderstatus = 'F') AS failed
        FROM orders GROUP BY 1""",
    "team_performance": """
        SELECT n_name, c_mktsegment, o_orderstatus, count(o_totalprice) AS orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS revenue,
               min(CAST(o_totalprice AS DECIMAL(12,2))) AS smallest,
               max(CAST(o_totalprice AS DECIMAL(12,2))) AS largest
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_name, c_mktsegment, o_orderstatus""",
    "grouped_performance": """
        SELECT l_returnflag, l_linestatus, count(*) AS lines,
               CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS total_qty,
               max(CAST(l_quantity AS INTEGER)) AS max_qty
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
}
