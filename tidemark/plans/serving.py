"""Queries over the serving tables: best, outcomes, grouped performance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Each aggregate and the one that combines its partial results.
COMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def top_k(df: DataFrame, measure: str, tie_break: Sequence[str], k: int) -> DataFrame:
    """The ``k`` rows with the highest ``measure``; ``tie_break`` must make rows unique.

    Every task keeps its own best ``k``; only those are merged.
    """
    return df.orderBy(F.desc(measure), *[F.asc(name) for name in tie_break]).limit(k)


def season_outcomes(
    matches: DataFrame, season: Column, flagged: Column, flag_out: str = "rain_affected"
) -> DataFrame:
    """Rows, and rows with the flag, per season."""
    return matches.groupBy(season.alias("season")).agg(
        F.count(F.lit(1)).alias("matches"), F.count_if(flagged).alias(flag_out)
    )


def _aggregate(function: str, name: str) -> Column:
    if function not in COMBINE:
        raise ValueError(f"not one of {', '.join(COMBINE)}: {function}")
    return getattr(F, function)(name)


def performance(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Measures per group; ``measures`` maps an output name to (aggregate, column)."""
    return df.groupBy(*keys).agg(
        *[_aggregate(function, name).alias(out) for out, (function, name) in measures.items()]
    )


def performance_by(
    df: DataFrame,
    foreign_key: str,
    dimension: DataFrame,
    dimension_key: str,
    keys: Sequence[str],
    measures: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """`performance` over ``keys``: columns of ``df`` and, failing that, of ``dimension``.

    ``dimension`` must hold each key at most once. The rows are aggregated on the foreign
    key before the join: a key that holds a third of all rows is combined map-side and
    enters the join as one row per group, so only such partial results are shuffled.
    """
    own = [key for key in keys if key in df.columns]
    partial = performance(df.where(F.col(foreign_key).isNotNull()), [foreign_key, *own], measures)
    wanted = [F.col(key) for key in keys if key not in own]
    looked_up = dimension.select(F.col(dimension_key).alias("_dimension_key"), *wanted)
    joined = partial.join(looked_up, F.col(foreign_key) == F.col("_dimension_key"))
    return joined.groupBy(*keys).agg(
        *[COMBINE[function](out).alias(out) for out, (function, _) in measures.items()]
    )
