"""Sketches of distinct values, made once for every run and merged without its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.projections import column

# A sketch keeps up to 2**NOMINAL hashes: 128 KB.
NOMINAL = 14


def distinct_sketch(value: Column, nominal: int = NOMINAL) -> Column:
    """Aggregate: a theta sketch of the distinct values, NULL left out.

    Counts up to 2**``nominal`` are exact but for equal 64-bit hashes; beyond, the standard
    error is 2**(-``nominal`` / 2), 0.8 % for 14. Values are hashed first, so every type that
    Spark hashes will do, and an empty text is a value.
    """
    hashed = F.when(value.isNotNull(), F.xxhash64(value))
    return F.theta_sketch_agg(hashed, nominal)


def distinct_estimate(sketch: Column) -> Column:
    return F.theta_sketch_estimate(sketch)


def distinct_sketches(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), nominal: int = NOMINAL
) -> DataFrame:
    """``(*keys, column_name, sketch)`` for every group and column, in one pass.

    A group enters the shuffle as one sketch of bounded size for each part of the input, however
    many rows it has. Without keys an empty table gives empty sketches.
    """
    made = df.groupBy(*[column(key) for key in keys]).agg(
        *[distinct_sketch(column(name), nominal).alias(f"_s{i}") for i, name in enumerate(columns)]
    )
    each = [
        F.struct(F.lit(name).alias("column_name"), F.col(f"_s{i}").alias("sketch"))
        for i, name in enumerate(columns)
    ]
    return made.select(*[column(key) for key in keys], F.inline(F.array(*each)))


def distinct_counts(
    sketches: DataFrame, keys: Sequence[str], sketch: str = "sketch", nominal: int = NOMINAL
) -> DataFrame:
    """``(*keys, distinct_values)``: the sketches of every group merged, then counted.

    A value that several of them have seen counts once. NULL sketches are left out.
    """
    merged = F.theta_union_agg(column(sketch), nominal)
    return sketches.groupBy(*[column(key) for key in keys]).agg(
        distinct_estimate(merged).cast("bigint").alias("distinct_values")
    )
