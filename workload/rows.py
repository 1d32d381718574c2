"""Row-wise operators and group totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from tidemark.functions import (
    capitalise,
    run_date,
    run_name_column,
    safe_int,
    safe_numeric,
    season_of,
    snapshot_path,
)
from tidemark.operators import (
    add_label,
    replace,
    stamp_run,
    to_int,
    to_numeric,
    trim_strings,
    window_total,
)
from workload.inputs import RUN_START, given

DOUBLE = DoubleType()


def window_total_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.col("l_quantity").cast("int").alias("qty")
    )
    return window_total(lines, ["l_orderkey", "l_returnflag"], "qty", "total_qty")


def window_total_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.to_date("ts").alias("day"),
        F.col("value").cast("decimal(12,2)").alias("amount"),
    )
    return window_total(events, ["user_id", "event_type", "day"], "amount", "day_amount")


def window_total_few_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each group holds about a third of all rows."""
    lines = given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.col("l_quantity").cast("int").alias("qty")
    )
    return window_total(lines, ["l_returnflag"], "qty", "flag_qty")


def window_total_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        "l_orderkey",
        "l_linenumber",
        F.nullif("l_linestatus", F.lit("O")).alias("status"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("int")).alias("qty"),
    )
    return window_total(lines, ["l_suppkey", "status"], "qty", "total_qty")


def trim_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = replace(
        given(spark, sf_dir, "customer"),
        {
            "c_name": F.concat(F.lit("  "), "c_name", F.lit(" ")),
            "c_mktsegment": F.concat(F.lit("\t"), "c_mktsegment", F.lit(" ")),
        },
    )
    return trim_strings(padded)


def safe_int_from_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    mixed = given(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(size <= 10, F.lit("NULL"))
        .when(size <= 20, F.concat(size, F.lit(".7")))
        .when(size <= 30, F.concat(F.lit(" "), size, F.lit(" ")))
        .when(size <= 40, F.concat(size, F.lit("e2")))
        .otherwise(F.concat(F.lit("-"), size))
        .alias("size"),
    )
    return to_int("size")(mixed)


def safe_int_from_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return given(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        safe_int(price, DOUBLE).alias("price"),
        safe_int(-price, DOUBLE).alias("negative_price"),
        safe_int(price * 100_000, DOUBLE).alias("price_or_null"),
    )


def safe_int_via_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("l_extendedprice").cast("string")
    return given(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", safe_int(text, StringType(), via_double=True).alias("price")
    )


def safe_numeric_from_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return given(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        safe_numeric(price, DOUBLE).alias("price"),
        safe_numeric(F.col("l_quantity") + 0.5, DOUBLE).alias("tie"),
        safe_numeric(-F.col("l_quantity") - 0.5, DOUBLE).alias("negative_tie"),
        safe_numeric(price * 1_000_000, DOUBLE).alias("price_or_null"),
        safe_numeric(price, DOUBLE, precision=12, scale=1).alias("price_tenths"),
    )


def safe_numeric_from_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = given(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").cast("string").alias("c_acctbal")
    )
    return to_numeric("c_acctbal")(texts)


def season_from_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day_first = F.date_format("o_orderdate", "dd-MM-yyyy")
    year_first = F.date_format("o_orderdate", "yyyy-MM-dd")
    return given(spark, sf_dir, "orders").select(
        "o_orderkey",
        season_of(day_first).alias("season"),
        season_of(year_first).alias("season_of_iso"),
        season_of(F.substring(day_first, 1, 6)).alias("season_of_short"),
    )


def label_before_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label compares the untrimmed flag, so padded flags get none."""
    flag = F.col("l_returnflag")
    lines = given(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit(" "), flag))
        .otherwise(flag)
        .alias("flag"),
    )
    return trim_strings(add_label("flag", match="R", label="returned", out="label")(lines))


def stamp_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp_run(given(spark, sf_dir, "orders"), "orders", RUN_START)


def run_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = run_name_column(F.col("event_type"), F.col("ts"))
    return given(spark, sf_dir, "events").select(
        "event_id",
        name.alias("partition_name"),
        snapshot_path(name, "/partitions").alias("hdfs_path"),
        run_date(F.col("ts")).alias("date"),
    )


def capitalise_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "customer").select(
        "c_custkey", capitalise(F.col("c_mktsegment")).alias("segment")
    )


QUERIES = {
    "window_total": window_total_by_order,
    "window_total_decimal": window_total_decimal,
    "window_total_few_groups": window_total_few_groups,
    "window_total_null_keys": window_total_null_keys,
    "trim_strings": trim_padded,
    "safe_int_from_string": safe_int_from_string,
    "safe_int_from_double": safe_int_from_double,
    "safe_int_via_double": safe_int_via_double,
    "safe_numeric": safe_numeric_from_double,
    "safe_numeric_from_string": safe_numeric_from_string,
    "season_from_date": season_from_date,
    "label_when": label_before_trim,
    "stamp_partition": stamp_partition,
    "run_names": run_names,
    "capitalise_label": capitalise_label,
}

ORACLE = {
    "window_total": """
        SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_quantity AS INTEGER) AS qty,
               CAST(sum(CAST(l_quantity AS INTEGER))
                    OVER (PARTITION BY l_orderkey, l_returnflag) AS BIGINT) AS total_qty
        FROM lineitem""",
    "window_total_decimal": """
        SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day,
               CAST(value AS DECIMAL(12,2)) AS amount,
               CAST(sum(CAST(value AS DECIMAL(12,2)))
                    OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE))
                    AS DECIMAL(22,2)) AS day_amount
        FROM events""",
    "window_total_few_groups": """
        SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_quantity AS INTEGER) AS qty,
               CAST(sum(CAST(l_quantity AS INTEGER))
                    OVER (PARTITION BY l_returnflag) AS BIGINT) AS flag_qty
        FROM lineitem""",
    "window_total_null_keys": """
        WITH lines AS (
            SELECT l_suppkey, l_orderkey, l_linenumber, nullif(l_linestatus, 'O') AS status,
                   CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS INTEGER) END AS qty
            FROM lineitem)
        SELECT *, CAST(sum(qty) OVER (PARTITION BY l_suppkey, status) AS BIGINT) AS total_qty
        FROM lines""",
    "trim_strings": """
        SELECT c_custkey, trim('  ' || c_name || ' ', ' ') AS c_name, c_nationkey, c_acctbal,
               trim(chr(9) || c_mktsegment || ' ', ' ') AS c_mktsegment
        FROM customer""",
    "safe_int_from_string": """
        WITH mixed AS (
            SELECT p_partkey,
                   CASE WHEN p_size <= 10 THEN 'NULL' WHEN p_size <= 20 THEN p_size || '.7'
                        WHEN p_size <= 30 THEN ' ' || p_size || ' '
                        WHEN p_size <= 40 THEN p_size || 'e2'
                        ELSE '-' || p_size END AS size
            FROM part)
        SELECT p_partkey,
               CASE WHEN regexp_full_match(trim(size), '[+-]?[0-9]+')
                    THEN TRY_CAST(trim(size) AS INTEGER) END AS size
        FROM mixed""",
    "safe_int_from_double": """
        SELECT l_orderkey, l_linenumber,
               TRY_CAST(trunc(l_extendedprice) AS INTEGER) AS price,
               TRY_CAST(trunc(-l_extendedprice) AS INTEGER) AS negative_price,
               TRY_CAST(trunc(l_extendedprice * 100000) AS INTEGER) AS price_or_null
        FROM lineitem""",
    "safe_int_via_double": """
        SELECT l_orderkey, l_linenumber, TRY_CAST(trunc(l_extendedprice) AS INTEGER) AS price
        FROM lineitem""",
    "safe_numeric": """
        SELECT l_orderkey, l_linenumber,
               TRY_CAST(l_extendedprice AS DECIMAL(10,0)) AS price,
               TRY_CAST(l_quantity + 0.5 AS DECIMAL(10,0)) AS tie,
               TRY_CAST(-l_quantity - 0.5 AS DECIMAL(10,0)) AS negative_tie,
               TRY_CAST(l_extendedprice * 1000000 AS DECIMAL(10,0)) AS price_or_null,
               TRY_CAST(TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DECIMAL(18,6))
                        AS DECIMAL(12,1)) AS price_tenths
        FROM lineitem""",
    "safe_numeric_from_string": """
        SELECT c_custkey, TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(10,0)) AS c_acctbal
        FROM customer""",
    "season_from_date": """
        SELECT o_orderkey, substr(strftime(o_orderdate, '%d-%m-%Y'), 7, 4) AS season,
               substr(strftime(o_orderdate, '%Y-%m-%d'), 7, 4) AS season_of_iso,
               substr(substr(strftime(o_orderdate, '%d-%m-%Y'), 1, 6), 7, 4) AS season_of_short
        FROM orders""",
    "label_when": """
        SELECT l_orderkey, l_linenumber, l_returnflag AS flag,
               CASE WHEN l_returnflag = 'R' AND l_linestatus <> 'O' THEN 'returned' END AS label
        FROM lineitem""",
    "stamp_partition": """
        SELECT *, 'orders_20250418_093000' AS partition_name FROM orders""",
    "run_names": """
        SELECT event_id, event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') AS partition_name,
               '/partitions/' || event_type || '_' || strftime(ts, '%Y%m%d_%H%M%S') AS hdfs_path,
               CAST(ts AS DATE) AS date
        FROM events""",
    "capitalise_label": """
        SELECT c_custkey,
               upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS segment
        FROM customer""",
}
