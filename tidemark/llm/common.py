"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.storage import new_folder, stored

# The top bits of a 64-bit hash that name a bucket of a running total.
BUCKET_BITS = 16
GROUP_BITS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores added until no column of ``df`` has that name."""
    taken = {name.lower() for name in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that its lineage ends here."""
    return stored(df, new_folder(df.sparkSession, f"llm-{purpose}"))


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` stored with a number for every row, and the name of that column.

    The numbers are frozen by the write: whoever reads the table again, after a lost
    executor too, finds the same number on the same row.
    """
    name = free_name(docs, "_row")
    return kept(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def first_by_hash(rows: DataFrame, group: str, key: str, count: int) -> DataFrame:
    """Of every ``group`` the ``count`` different keys whose hash comes first: group, key.

    Two steps, so that a group with most of the rows is ranked in 2**8 parts and the last
    window holds no more than ``count`` keys of each.
    """
    ranked = rows.select(group, key).distinct().withColumn("_hash", F.xxhash64(key))
    ranked = ranked.withColumn("_part", F.pmod("_hash", F.lit(1 << GROUP_BITS)))
    for parts in ([group, "_part"], [group]):
        place = F.row_number().over(Window.partitionBy(*parts).orderBy("_hash", key))
        ranked = ranked.withColumn("_rank", place).where(F.col("_rank") <= count)
    return ranked.select(group, key)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def texts(series: pd.Series) -> Iterator[str | None]:
    """The texts of a batch, every kind of missing value as None."""
    return (text if isinstance(text, str) else None for text in series)


def bucket_of(hashed: Column) -> Column:
    """Bucket of a signed 64-bit hash; buckets are in the order of the hashes."""
    return F.shiftright(hashed, 64 - BUCKET_BITS)


def before_bucket(rows: DataFrame, keys: list[str], bucket: str, value: Column) -> DataFrame:
    """For every ``keys`` and bucket the total of ``value`` in the buckets before it: ``_before``.

    Two steps, so that no window holds more than 2**8 or 2**(16-8) rows of one key: totals
    of groups of neighbouring buckets, then of the buckets within a group. What is summed is
    combined map-side first.
    """
    group = F.shiftright(F.col(bucket), BUCKET_BITS - GROUP_BITS)
    totals = rows.groupBy(*keys, bucket).agg(F.sum(value).alias("_sum"))
    totals = totals.withColumn("_group", group)
    within = Window.partitionBy(*keys, "_group").orderBy(bucket)
    totals = totals.withColumn("_inside", F.sum("_sum").over(within) - F.col("_sum"))
    groups = totals.groupBy(*keys, "_group").agg(F.sum("_sum").alias("_sum"))
    across = Window.partitionBy(*keys).orderBy("_group")
    groups = groups.withColumn("_outside", F.sum("_sum").over(across) - F.col("_sum"))
    return totals.drop("_sum").join(groups.drop("_sum"), [*keys, "_group"]).select(
        *keys, bucket, (F.col("_inside") + F.col("_outside")).alias("_before")
    )


def popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)
