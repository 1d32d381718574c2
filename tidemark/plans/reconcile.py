"""Remove the rows of runs whose snapshot folder is gone."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import missing_from
from tidemark.plans.jobs import JOBS
from tidemark.plans.layout import Layout
from tidemark.sinks import drop_partition, forget_snapshot
from tidemark.sources import existing_snapshots, read_snapshots, stored_partitions
from tidemark.storage import for_each, new_folder, stored


def missing_snapshots(spark: SparkSession, layout: Layout) -> DataFrame:
    """Registered ``partition_name`` values that have no snapshot folder.

    The registry is opened before the folders are listed: a load registers a snapshot only
    after its folder is there, so one that ends in between is never taken for missing.
    """
    registered = read_snapshots(spark, layout.snapshot_log)
    return missing_from(registered, existing_snapshots(spark, layout.snapshots), "partition_name")


def reconcile(
    spark: SparkSession,
    layout: Layout,
    tables: Sequence[str] = tuple(job.table for job in JOBS),
    prune_log: bool = False,
) -> DataFrame:
    """Drop the missing runs from all tables and return their names.

    A run is a partition folder, so no row is read or rewritten, and only folders that are there
    are deleted. The names are stored once and walked page by page. Registry rows stay, unless
    ``prune_log`` is set; then they go after the data.
    """
    missing = stored(missing_snapshots(spark, layout), new_folder(spark, "missing"))
    for table in tables:
        path = layout.table(table)
        gone = stored_partitions(spark, path).join(missing, "partition_name", "left_semi")
        for_each(partial(drop_partition, spark, path), _names(gone))
    if prune_log:
        for_each(partial(forget_snapshot, spark, layout.snapshot_log), _names(missing))
    return missing


def _names(runs: DataFrame) -> Iterator[str]:
    return (row["partition_name"] for row in runs.select("partition_name").toLocalIterator())
