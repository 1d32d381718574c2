"""Event-time stream: repeats and late rows are told by a watermark and kept state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.projections import column
from tidemark.versions import VersionedTable


def first_arrivals(rows: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """The stream ``rows`` with every ``keys`` once, NULL a value like any other.

    The watermark of a batch is the latest ``time`` of the batches before it, in whole
    milliseconds, minus ``delay``. Rows at or before it are late and go, and so does the memory of
    keys; repeats with the time of the first arrival are therefore dropped however late they
    come. Rows without a time have no place in it and go as well. State is one entry for each
    key of the last ``delay``, spread by the hash of the keys.
    """
    timed = rows.where(column(time).isNotNull()).withWatermark(time, delay)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def ingest_events(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    root: str,
    checkpoint: str,
    keys: Sequence[str],
    time: str,
    delay: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Add the first arrivals among all new Parquet files of ``landing`` to the versioned table
    below ``root``, then stop; start it again, with the same checkpoint, for later files.

    Watermark and keys seen are carried over from start to start. A batch is committed under its
    number and the checkpoint's name, so one that is retried counts once. A batch without rows
    commits an empty version.
    """
    table = VersionedTable(spark, root)
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    rows = first_arrivals(stream.parquet(landing), keys, time, delay)

    def commit(batch: DataFrame, number: int) -> None:
        table.append(batch, batch=f"{checkpoint.rstrip('/')}:{number}")

    return (
        rows.writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
