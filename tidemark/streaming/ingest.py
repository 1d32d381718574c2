"""Incremental load of a landing folder; used files are archived."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.jobs import Job
from tidemark.plans.layout import Layout
from tidemark.plans.load import publish
from tidemark.sinks import Relational, log_run
from tidemark.sinks.tables import partition_folder
from tidemark.sources import header_of
from tidemark.sources.delimited import cast_declared, check_same_header, stream_csv
from tidemark.storage import exists, write_as_file

FILE = "_source_file"


def per_file_total(job: Job) -> Job:
    """``job`` with its total taken within each file, as if every file were its own run."""
    if job.total is None:
        return job
    return replace(job, total=replace(job.total, keys=(FILE, *job.total.keys)))


def _header(
    spark: SparkSession, landing: str, checkpoint: str
) -> tuple[list[str], str | None] | None:
    """Column names, and the first line of the files if Spark cannot check them.

    Read from the files of the first start and kept beside its checkpoint; None before there is
    any file.
    """
    path = f"{checkpoint.rstrip('/')}-header.parquet"
    if exists(spark, path):
        kept = spark.read.parquet(path).first()
        return list(kept["names"]), kept["line"]
    try:
        names, comparable = header_of(spark, landing)
    except AnalysisException:
        if not exists(spark, landing):
            raise
        return None
    line = None if comparable else check_same_header(spark, landing)
    header = spark.range(0, 1, 1, 1).select(
        F.array(*map(F.lit, names)).alias("names"), F.lit(line).cast("string").alias("line")
    )
    write_as_file(header, path)
    return names, line


def _check_prefix(spark: SparkSession, table: str, prefix: str, checkpoint: str) -> None:
    is_new = not exists(spark, f"{checkpoint}/metadata")
    if is_new and exists(spark, partition_folder(table, f"{prefix}_0")):
        raise ValueError(f"an earlier stream wrote {prefix}_0; give another prefix")


def ingest(
    spark: SparkSession,
    job: Job,
    landing: str,
    layout: Layout,
    checkpoint: str,
    per_file: bool = True,
    columns: list[str] | None = None,
    files_per_batch: int | None = None,
    prefix: str | None = None,
    clock: Callable[[], datetime] = datetime.now,
    relational: Relational | None = None,
) -> StreamingQuery | None:
    """Load all files that are new in ``landing``, then stop; start it again for later ones.

    Each micro-batch is one run named ``<prefix>_<batch id>``, by default the table's name. A
    batch that is retried keeps its id and so replaces its own rows. A new checkpoint counts
    from 0 again and needs another ``prefix``, so as not to replace older runs.

    With ``per_file`` a group's total stays within one file; otherwise it covers the batch.
    ``columns`` is the header. If not given, it is read from the files of the first start and kept
    beside the checkpoint; while there is no file, nothing starts and None is returned. A file
    with another header fails the batch, one with repeated names too. ``files_per_batch`` splits a large backlog into several runs;
    totals per file do not depend on it.
    """
    prefix = prefix or job.table
    _check_prefix(spark, layout.table(job.table), prefix, checkpoint)
    header = (columns, None) if columns else _header(spark, landing, checkpoint)
    if header is None:
        return None
    names, line = header
    files = stream_csv(spark, landing, names, layout.archive, files_per_batch, line is None)
    with_file = job.total is not None and per_file
    if with_file or line is not None:
        files = files.select("*", F.col("_metadata.file_path").alias(FILE))
    work = per_file_total(job) if with_file else job

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        name = f"{prefix}_{batch_id}"
        started_at = clock()
        status = "Failed"
        try:
            if line is not None:
                # Names of the files of one batch.
                paths = batch.select(FILE).distinct().collect()
                check_same_header(session, [unquote(path[0]) for path in paths], line)
            rows = cast_declared(batch, job.declared)
            publish(session, work, rows, layout, name, name, started_at, (FILE,), relational)
            status = "Success"
        finally:
            log_run(session, layout.run_log, name, job.script, started_at, clock(), status)

    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
