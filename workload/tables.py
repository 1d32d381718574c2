"""Sources, sinks, whole loads and the stream, each writing to a new shared folder."""

from __future__ import annotations

from dataclasses import replace as changed

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import run_name
from tidemark.operators import trim_strings
from tidemark.plans.jobs import BATSMEN, BOWLERS, DELIVERIES, MATCHES, GroupTotal, Job
from tidemark.plans.layout import Layout
from tidemark.plans.load import run_load
from tidemark.sinks import log_metric, write_serving, write_snapshot
from tidemark.sources import read_metrics, read_serving, scan_csv
from tidemark.storage import new_folder
from tidemark.streaming import ingest
from workload.inputs import RUN_END, RUN_START, given, land


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in another order than declared, text padded: found by header name."""
    customer = given(spark, sf_dir, "customer")
    padded = F.concat(F.lit(" "), "c_name", F.lit("  ")).alias("c_name")
    folder = new_folder(spark, "csv_scan")
    land(
        customer.select("c_mktsegment", "c_acctbal", padded, "c_nationkey", "c_custkey"), folder
    )
    return scan_csv(spark, folder, customer.schema).select(*customer.columns)


def csv_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = given(spark, sf_dir, "part")
    folder = new_folder(spark, "csv_scan_inferred")
    land(part, folder)
    found = scan_csv(spark, folder, infer=True)
    # Key width follows the data when types are guessed.
    return found.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


def append_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs under two names, the second one written twice."""
    orders = given(spark, sf_dir, "orders")
    path = new_folder(spark, "append_rerun")
    is_open = F.col("o_orderstatus") == "O"
    write_serving(orders.where(is_open), path, "orders_open")
    write_serving(orders.where(~is_open), path, "orders_done")
    write_serving(orders.where(~is_open), path, "orders_done")
    return read_serving(spark, path)


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = given(spark, sf_dir, "supplier")
    folder = new_folder(spark, "snapshot")
    write_snapshot(supplier.select("s_suppkey"), folder)
    write_snapshot(supplier, folder)
    return spark.read.schema(supplier.schema).csv(folder)


def insert_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_folder(spark, "insert_metric")
    for table in ("customer", "orders", "lineitem", "part", "supplier", "events"):
        rows = write_serving(given(spark, sf_dir, table), f"{root}/{table}", f"{table}_1")
        log_metric(spark, f"{root}/metrics", "run_1", table, rows)
    return read_metrics(spark, f"{root}/metrics")


def _load(spark: SparkSession, job: Job, landed: DataFrame) -> Layout:
    root = new_folder(spark, f"load_{job.table}")
    layout = Layout.below(root)
    land(landed, f"{root}/files/{job.table}")
    run_load(
        spark, job, f"{root}/files/{job.table}", layout, RUN_START, clock=lambda: RUN_END
    )
    return layout


def _loaded(spark: SparkSession, job: Job, landed: DataFrame) -> DataFrame:
    return read_serving(spark, _load(spark, job, landed).table(job.table))


def load_batsmen(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    average = (
        F.when(size <= 5, F.lit("NULL"))
        .when(size <= 35, F.concat(size, F.lit(".25")))
        .otherwise(size.cast("string"))
    )
    landed = given(spark, sf_dir, "part").select(
        F.concat("p_name", F.lit(" #"), "p_partkey", F.lit("  ")).alias("player_name"),
        (size * 100).alias("total_runs"),
        size.alias("total_matches"),
        size.alias("total_innings"),
        F.lit(1).alias("total_not_outs"),
        average.alias("average"),
        (size * 60).alias("total_balls_faced"),
        F.col("p_retailprice").alias("strike_rate"),
        F.lit(0).alias("hundreds"),
        F.lit(0).alias("fifties"),
        size.alias("fours"),
        size.alias("sixes"),
    )
    return _loaded(spark, BATSMEN, landed)


def _bowlers(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    return given(spark, sf_dir, "customer").select(
        F.concat("c_name", F.lit(" ")).alias("player_name"),
        nation.alias("total_wkts"),
        nation.alias("total_matches"),
        nation.alias("total_inns"),
        (nation + 0.5).alias("total_overs"),
        nation.alias("runs"),
        balance.alias("bowling_avg"),
        (-balance).alias("economy_rate"),
        (balance + 0.25).alias("strike_rate"),
        F.lit(0).alias("total_4w"),
        F.lit(0).alias("total_5w"),
    )


def load_bowlers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, BOWLERS, _bowlers(spark, sf_dir))


def load_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot a load leaves: columns by position, the run's name last."""
    layout = _load(spark, BOWLERS, _bowlers(spark, sf_dir))
    name = run_name("bowlers", RUN_START)
    columns = read_serving(spark, layout.table("bowlers")).schema
    return spark.read.schema(columns).csv(f"{layout.snapshots}/{name}")


def archived_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The input of a load, read back from the archive."""
    supplier = given(spark, sf_dir, "supplier")
    job = Job("supplier", supplier.schema, (trim_strings,))
    layout = _load(spark, job, supplier)
    folder = f"{layout.archive}/{run_name('supplier', RUN_START)}"
    return scan_csv(spark, folder, supplier.schema)


def load_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    method = F.when(status == "F", "D/L").when(status == "O", " D/L ").otherwise("NA")
    landed = given(spark, sf_dir, "orders").select(
        F.concat(F.lit("m"), "o_orderkey", F.lit(" ")).alias("id"),
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("date"),
        method.alias("method"),
        F.concat(F.lit(" "), "o_custkey").alias("player_id"),
        F.col("o_totalprice").alias("result_margin"),
        F.when(status != "P", F.substring("o_orderpriority", 1, 1)).alias("target_runs"),
        F.col("o_orderpriority").alias("target_overs"),
    )
    return _loaded(spark, MATCHES, landed)


def load_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = given(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("match_id"),
        F.col("l_linenumber").alias("inning"),
        F.col("l_quantity").cast("int").alias("over"),
        F.concat(F.lit("  "), "l_returnflag", F.lit(" ")).alias("batter"),
        F.round(F.col("l_discount") * 100).cast("int").alias("total_runs"),
    )
    return _loaded(spark, DELIVERIES, landed)


EVENTS_JOB = Job(
    "events",
    schemas.table(event_id=schemas.LONG, user_id=schemas.LONG, cents=schemas.LONG),
    (trim_strings,),
    GroupTotal(("user_id", "event_type"), "cents", "user_cents"),
)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of files, one run after each; totals stay within a run."""
    root = new_folder(spark, "stream_ingest")
    layout, landing = Layout.below(root), f"{root}/files"
    events = given(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.concat(F.lit(" "), "event_type", F.lit(" ")).alias("event_type"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        (F.col("ts") < "2024-01-16").alias("early"),
    )
    for drop in (F.col("early"), ~F.col("early")):
        land(events.where(drop).drop("early"), landing)
        ingest(
            spark, EVENTS_JOB, landing, layout, f"{root}/checkpoint", per_file=False,
            clock=lambda: RUN_START,
        ).awaitTermination()
    return read_serving(spark, layout.table("events"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )


def _land_types(events: DataFrame, landing: str) -> None:
    """Land all events, each type (NULL too) as one file; there are few types."""
    for (kind,) in events.select("event_type").distinct().collect():
        land(events.where(F.col("event_type").eqNullSafe(F.lit(kind))).coalesce(1), landing)


def stream_per_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in one run, a file for each type; totals stay within a file."""
    root = new_folder(spark, "stream_per_type")
    layout, landing = Layout.below(root), f"{root}/files"
    _land_types(_events(spark, sf_dir), landing)
    job = changed(EVENTS_JOB, total=GroupTotal(("user_id",), "cents", "user_cents"))
    ingest(
        spark, job, landing, layout, f"{root}/checkpoint", clock=lambda: RUN_START
    ).awaitTermination()
    return read_serving(spark, layout.table("events"))


def stream_archived_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archive holds after a run of one more file: all events, from a file of each type."""
    root = new_folder(spark, "stream_archived_types")
    layout, landing = Layout.below(root), f"{root}/files"
    events = _events(spark, sf_dir)
    for last in (False, True):
        if last:
            land(events.limit(1).coalesce(1), landing)
        else:
            _land_types(events, landing)
        ingest(
            spark, EVENTS_JOB, landing, layout, f"{root}/checkpoint", clock=lambda: RUN_START
        ).awaitTermination()
    reader = spark.read.option("header", True).option("recursiveFileLookup", True)
    schema = "event_id bigint, user_id bigint, event_type string, cents bigint"
    return reader.schema(schema).csv(layout.archive)


def stream_ingest_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starting the stream again without new files changes nothing; no total is taken."""
    root = new_folder(spark, "stream_resumed")
    layout, landing = Layout.below(root), f"{root}/files"
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    job = changed(
        EVENTS_JOB,
        table="orders",
        declared=schemas.table(o_orderkey=schemas.LONG, o_custkey=schemas.LONG),
        total=None,
    )
    land(orders, landing)
    for _ in range(2):
        ingest(
            spark, job, landing, layout, f"{root}/checkpoint", clock=lambda: RUN_START
        ).awaitTermination()
    return read_serving(spark, layout.table("orders"))


QUERIES = {
    "csv_scan": csv_scan,
    "csv_scan_inferred": csv_scan_inferred,
    "append_rerun": append_rerun,
    "snapshot_roundtrip": snapshot_roundtrip,
    "insert_metric": insert_metric,
    "load_batsmen": load_batsmen,
    "load_bowlers": load_bowlers,
    "load_snapshot": load_snapshot,
    "archived_input": archived_input,
    "load_matches": load_matches,
    "load_deliveries": load_deliveries,
    "stream_ingest": stream_ingest,
    "stream_ingest_resumed": stream_ingest_resumed,
    "stream_per_type": stream_per_type,
    "stream_archived_types": stream_archived_types,
}

ORACLE = {
    "csv_scan": """
        SELECT c_custkey, ' ' || c_name || '  ' AS c_name, c_nationkey, c_acctbal, c_mktsegment
        FROM customer""",
    "csv_scan_inferred": "SELECT * FROM part",
    "append_rerun": """
        SELECT *, 'orders_open' AS partition_name FROM orders WHERE o_orderstatus = 'O'
        UNION ALL
        SELECT *, 'orders_done' AS partition_name FROM orders WHERE o_orderstatus <> 'O'""",
    "snapshot_roundtrip": "SELECT * FROM supplier",
    "insert_metric": """
        SELECT 'run_1' AS run_id, 'customer' AS table_name, count(*) AS inserted_rows FROM customer
        UNION ALL SELECT 'run_1', 'orders', count(*) FROM orders
        UNION ALL SELECT 'run_1', 'lineitem', count(*) FROM lineitem
        UNION ALL SELECT 'run_1', 'part', count(*) FROM part
        UNION ALL SELECT 'run_1', 'supplier', count(*) FROM supplier
        UNION ALL SELECT 'run_1', 'events', count(*) FROM events""",
    "load_batsmen": """
        SELECT p_name || ' #' || p_partkey AS player_name, p_size * 100 AS total_runs,
               p_size AS total_matches, p_size AS total_innings, 1 AS total_not_outs,
               CASE WHEN p_size > 35 THEN p_size END AS average,
               p_size * 60 AS total_balls_faced, p_retailprice AS strike_rate,
               0 AS hundreds, 0 AS fifties, p_size AS fours, p_size AS sixes,
               'batsmen_20250418_093000' AS partition_name
        FROM part""",
    "load_bowlers": """
        SELECT c_name AS player_name, c_nationkey AS total_wkts, c_nationkey AS total_matches,
               c_nationkey AS total_inns,
               CAST(CAST(c_nationkey + 0.5 AS DOUBLE) AS DECIMAL(10,0)) AS total_overs,
               c_nationkey AS runs, CAST(c_acctbal AS DECIMAL(10,0)) AS bowling_avg,
               CAST(-c_acctbal AS DECIMAL(10,0)) AS economy_rate,
               CAST(c_acctbal + CAST(0.25 AS DOUBLE) AS DECIMAL(10,0)) AS strike_rate,
               0 AS total_4w, 0 AS total_5w, 'bowlers_20250418_093000' AS partition_name
        FROM customer""",
    "load_snapshot": """
        SELECT c_name AS player_name, c_nationkey AS total_wkts, c_nationkey AS total_matches,
               c_nationkey AS total_inns,
               CAST(CAST(c_nationkey + 0.5 AS DOUBLE) AS DECIMAL(10,0)) AS total_overs,
               c_nationkey AS runs, CAST(c_acctbal AS DECIMAL(10,0)) AS bowling_avg,
               CAST(-c_acctbal AS DECIMAL(10,0)) AS economy_rate,
               CAST(c_acctbal + CAST(0.25 AS DOUBLE) AS DECIMAL(10,0)) AS strike_rate,
               0 AS total_4w, 0 AS total_5w, 'bowlers_20250418_093000' AS partition_name
        FROM customer""",
    "archived_input": "SELECT * FROM supplier",
    "load_matches": """
        SELECT 'm' || o_orderkey AS id, strftime(o_orderdate, '%d-%m-%Y') AS date,
               CASE o_orderstatus WHEN 'F' THEN 'D/L' WHEN 'O' THEN 'D/L' ELSE 'NA' END AS method,
               TRY_CAST(o_custkey AS INTEGER) AS player_id, CAST(NULL AS INTEGER) AS result_margin,
               CASE WHEN o_orderstatus <> 'P'
                    THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS target_runs,
               CAST(NULL AS INTEGER) AS target_overs,
               strftime(o_orderdate, '%Y') AS season,
               CASE WHEN o_orderstatus = 'F' THEN 'rain' END AS rained,
               'matches_20250418_093000' AS partition_name
        FROM orders""",
    "load_deliveries": """
        WITH balls AS (
            SELECT CAST(l_suppkey AS INTEGER) AS match_id, l_linenumber AS inning,
                   CAST(l_quantity AS INTEGER) AS over, l_returnflag AS batter,
                   CAST(round(l_discount * 100) AS INTEGER) AS total_runs
            FROM lineitem)
        SELECT *, CAST(sum(total_runs) OVER (PARTITION BY match_id, inning, over) AS BIGINT)
                  AS runs_per_over, 'deliveries_20250418_093000' AS partition_name
        FROM balls""",
    "stream_ingest": """
        WITH rows AS (
            SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents,
                   CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'events_0' ELSE 'events_1' END
                   AS partition_name
            FROM events)
        SELECT event_id, user_id, event_type, cents,
               CAST(sum(cents) OVER (PARTITION BY partition_name, user_id, event_type) AS BIGINT)
               AS user_cents, partition_name
        FROM rows""",
    "stream_per_type": """
        WITH rows AS (
            SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents
            FROM events)
        SELECT *, CAST(sum(cents) OVER (PARTITION BY event_type, user_id) AS BIGINT) AS user_cents,
               'events_0' AS partition_name
        FROM rows""",
    "stream_archived_types": """
        SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents
        FROM events""",
    "stream_ingest_resumed": """
        SELECT o_orderkey, o_custkey, o_orderpriority, 'orders_0' AS partition_name FROM orders""",
}
