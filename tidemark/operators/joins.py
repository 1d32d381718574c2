"""Joins between registries, reports and fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.projections import column


def missing_from(registered: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Keys of ``registered`` that ``existing`` does not have, each once."""
    return registered.select(key).distinct().join(existing.select(key).distinct(), key, "left_anti")


def succeeded_only(tables: DataFrame, tasks: DataFrame, key: str) -> DataFrame:
    """Rows of ``tables`` whose key is in ``tasks``.

    The keys are made distinct first, so a key with very many task rows is combined
    map-side and reaches the join as one row.
    """
    return tables.join(tasks.select(key).distinct(), key, "left_semi")


def lookup(
    df: DataFrame, values: DataFrame, on: str | list[str], value: str, default: str = "N/A"
) -> DataFrame:
    """Left join ``value`` (as text) onto ``df``; ``default`` where there is none.

    ``values`` must hold each key at most once.
    """
    joined = df.join(values, on, "left")
    return joined.withColumn(value, F.coalesce(F.col(value).cast("string"), F.lit(default)))


def delete_rows(facts: DataFrame, missing: DataFrame, key: str = "partition_name") -> DataFrame:
    """``facts`` without the rows whose key is in ``missing``; a NULL key stays.

    One plan at every size: an anti join on the distinct names, without a hint. Adaptive
    execution broadcasts a short list and splits an oversized key of ``facts``. To drop whole
    runs of a partitioned table use `drop_partition`, which reads nothing.
    """
    names = missing.select(key).where(F.col(key).isNotNull()).distinct()
    kept = facts.join(names, key, "left_anti")
    return kept.select(*[column(name) for name in facts.columns])
