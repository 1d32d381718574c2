"""Columns of the input tables and of the registries."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DateType,
    DayTimeIntervalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
DATE, MOMENT, INTERVAL = DateType(), TimestampType(), DayTimeIntervalType()


def table(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Column names and types of the shipped inputs, in header order.
BATSMEN = table(
    player_name=TEXT,
    total_runs=INT,
    total_matches=INT,
    total_innings=INT,
    total_not_outs=INT,
    average=TEXT,
    total_balls_faced=INT,
    strike_rate=DOUBLE,
    hundreds=INT,
    fifties=INT,
    fours=INT,
    sixes=INT,
)
BOWLERS = table(
    player_name=TEXT,
    total_wkts=INT,
    total_matches=INT,
    total_inns=INT,
    total_overs=DOUBLE,
    runs=INT,
    bowling_avg=DOUBLE,
    economy_rate=DOUBLE,
    strike_rate=DOUBLE,
    total_4w=INT,
    total_5w=INT,
)

# The columns the loads use; any other column of the file passes through as text.
MATCHES = table(
    date=TEXT,
    method=TEXT,
    player_id=TEXT,
    result_margin=TEXT,
    target_runs=TEXT,
    target_overs=TEXT,
)
DELIVERIES = table(match_id=INT, inning=INT, over=INT, total_runs=INT)

SNAPSHOTS = table(table_name=TEXT, partition_name=TEXT, hdfs_path=TEXT, date=DATE)
RUNS = table(
    run_id=TEXT,
    script_name=TEXT,
    execution_date=DATE,
    start_time=MOMENT,
    end_time=MOMENT,
    run_time=INTERVAL,
    run_seconds=DOUBLE,
    status=TEXT,
)
METRICS = table(run_id=TEXT, table_name=TEXT, inserted_rows=LONG)
SKETCHES = table(run_id=TEXT, table_name=TEXT, column_name=TEXT, sketch=BinaryType())
