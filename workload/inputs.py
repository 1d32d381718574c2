"""Reading the given tables and landing them as delimited files."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

RUN_START = datetime(2025, 4, 18, 9, 30, 0)
RUN_END = RUN_START + timedelta(seconds=90)


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, folder: str) -> None:
    """Add ``df`` to a landing folder as headed CSV, outer spaces kept."""
    (
        df.write.mode("append")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(folder)
    )
