"""Projections: trimming, replacing columns, stamping."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions import (
    label_when,
    run_name,
    safe_int,
    safe_numeric,
    season_of,
    trim_spaces,
)

Step = Callable[[DataFrame], DataFrame]


def column(name: str) -> Column:
    """The column with exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def replace(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    """Replace columns in place, add new ones at the end; all see the old values."""
    return df.withColumns(changes) if changes else df


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column; all other columns, names and order stay."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return replace(df, {name: trim_spaces(column(name)) for name in texts})


def to_int(*names: str, via_double: bool = False) -> Step:
    def step(df: DataFrame) -> DataFrame:
        types = {name: df.select(column(name)).schema[0].dataType for name in names}
        return replace(df, {n: safe_int(column(n), t, via_double) for n, t in types.items()})

    return step


def to_numeric(*names: str, precision: int = 10, scale: int = 0) -> Step:
    def step(df: DataFrame) -> DataFrame:
        types = {name: df.select(column(name)).schema[0].dataType for name in names}
        return replace(
            df, {n: safe_numeric(column(n), t, precision, scale) for n, t in types.items()}
        )

    return step


def add_season(date_column: str, out: str = "season") -> Step:
    return lambda df: replace(df, {out: season_of(column(date_column))})


def add_label(source: str, match: str, label: str, out: str) -> Step:
    return lambda df: replace(df, {out: label_when(column(source), match, label)})


def stamp(df: DataFrame, partition_name: str) -> DataFrame:
    """Put the lineage key on every row, as the last column."""
    return df.drop("partition_name").withColumn("partition_name", F.lit(partition_name))


def stamp_run(df: DataFrame, table: str, started_at: datetime) -> DataFrame:
    return stamp(df, run_name(table, started_at))
