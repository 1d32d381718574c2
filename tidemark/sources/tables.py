"""Serving tables, registries and the snapshot folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tidemark import schemas
from tidemark.functions import check_name
from tidemark.operators.projections import stamp
from tidemark.storage import exists, folder_names, listed

PARTITION = StructField("partition_name", StringType())


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    """A serving table, ``partition_name`` last and always a string.

    Folder values that all look like numbers or dates would be read as such; only then is
    the table opened a second time, with the type fixed.
    """
    table = spark.read.parquet(path)
    guessed = dict(table.dtypes).get("partition_name", "string")
    if guessed == "string":
        return table
    fields = [f for f in table.schema.fields if f.name != "partition_name"]
    return spark.read.schema(StructType([*fields, PARTITION])).parquet(path)


def read_partition(
    spark: SparkSession, path: str, partition_name: str, rows: StructType
) -> DataFrame:
    """The rows of one run; none if the run wrote none."""
    fields = [f for f in rows.fields if f.name != "partition_name"]
    folder = f"{path}/partition_name={partition_name}"
    if exists(spark, folder):
        found = spark.read.schema(StructType(fields)).parquet(folder)
    else:
        found = spark.createDataFrame([], StructType(fields))
    return stamp(found, partition_name)


def read_jdbc(spark: SparkSession, url: str, table: str, options: dict[str, str]) -> DataFrame:
    """A relational serving table; driver, credentials and split bounds come as options."""
    return spark.read.format("jdbc").options(**options, url=url, dbtable=table).load()


def _registry(
    spark: SparkSession, path: str, schema: StructType, run_id: str | None = None
) -> DataFrame:
    """A registry, or one run of it: then only that run's folder is listed."""
    folder = f"{path}/run_id={check_name(run_id)}" if run_id else path
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(folder).select(*schema.names)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return _registry(spark, path, schemas.SNAPSHOTS)


def read_runs(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    return _registry(spark, path, schemas.RUNS, run_id)


def read_metrics(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    return _registry(spark, path, schemas.METRICS, run_id)


def read_sketches(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    return _registry(spark, path, schemas.SKETCHES, run_id)


def existing_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """One row per folder below ``root``; a failed listing raises."""
    return listed(spark, folder_names(spark, root), "partition_name")


def stored_partitions(spark: SparkSession, path: str) -> DataFrame:
    """The names of the runs that have a partition folder in a serving table."""
    names = folder_names(spark, path) if exists(spark, path) else ()
    prefix = "partition_name="
    runs = (name.removeprefix(prefix) for name in names if name.startswith(prefix))
    return listed(spark, runs, "partition_name")
