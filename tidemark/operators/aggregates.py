"""Counts, run outcomes and union of counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.projections import column


def row_count(df: DataFrame, out: str = "total_rows") -> DataFrame:
    """One row with the number of rows; on Parquet it is answered from the footers."""
    return df.agg(F.count(F.lit(1)).alias(out))


def run_outcome(
    runs: DataFrame, keys: Sequence[str] = ("run_id",), status: str = "status",
    success: str = "Success", failure: str = "Failed",
) -> DataFrame:
    """Per run: did any task succeed, did any fail."""
    return runs.groupBy(*keys).agg(
        F.bool_or(F.col(status) == success).alias("any_success"),
        F.bool_or(F.col(status) == failure).alias("any_failed"),
    )


def last_attempts(
    runs: DataFrame,
    keys: Sequence[str] = ("run_id", "script_name"),
    order: Sequence[str] = ("end_time", "start_time"),
    status: str = "status",
    success: str = "Success",
) -> DataFrame:
    """Of every task of a run its last attempt: the one that ended last, of these the one that
    started last; of attempts alike in both a success. An attempt without an end counts as first.

    One row of each task is kept while the attempts are read, so a task that was tried very often
    enters the shuffle as one row for each part of the input.
    """
    place = F.struct(*[column(name) for name in order], (column(status) == success).alias("_won"))
    rest = [name for name in runs.columns if name not in keys]
    last = F.max_by(F.struct(*[column(name) for name in rest]), place).alias("_last")
    found = runs.groupBy(*[column(key) for key in keys]).agg(last)
    return found.select(*keys, "_last.*").select(*[column(name) for name in runs.columns])


def cube_totals(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Rows and total of ``measure`` for every set of ``keys``: the keys, ``level``, ``rows``,
    ``total``. A key that a level leaves out is NULL there and has its bit in ``level``, the first
    key the highest; a NULL key has none.

    Rows are summed by all keys first, combined map-side, so only the groups are expanded.
    """
    names = [column(key) for key in keys]
    groups = df.groupBy(*names).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(column(measure)).alias("_total")
    )
    return groups.cube(*names).agg(
        F.grouping_id().cast("int").alias("level"),
        F.sum("_rows").alias("rows"),
        F.sum("_total").alias("total"),
    )


def concatenate(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns, matched by name."""
    return reduce(DataFrame.unionByName, frames)
