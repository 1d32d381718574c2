"""One load: landing file -> serving table -> snapshot -> registries -> archive."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from itertools import chain
from itertools import count as count_from

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import run_name
from tidemark.plans.jobs import Job
from tidemark.plans.layout import Layout
from tidemark.sinks import (
    Relational,
    append_jdbc,
    fit_to_table,
    forget_snapshot,
    log_metric,
    log_run,
    log_snapshot,
    write_serving,
    write_snapshot,
)
from tidemark.sinks.registries import snapshot_entry_file
from tidemark.sinks.tables import partition_folder
from tidemark.sources import read_metrics, read_partition, scan_csv
from tidemark.storage import (
    check_absent,
    exists,
    input_files,
    make_folder,
    move_folder,
    move_into,
    new_folder,
    remove_folder,
)

Clock = Callable[[], datetime]


def publish(
    spark: SparkSession,
    job: Job,
    rows: DataFrame,
    layout: Layout,
    partition_name: str,
    run_id: str,
    moment: datetime,
    drop: tuple[str, ...] = (),
    relational: Relational | None = None,
) -> int:
    """Clean ``rows`` and write them to every sink of ``job``; return how many there were.

    Columns in ``drop`` serve the total only and are not written.

    All is written beside first: a failure until then changes nothing. Then the rows and the
    snapshot of an earlier load of the name are moved aside, the new ones into their place, and
    metric and registry are written; a failure there moves the earlier ones back. What a driver
    that was killed in between has left aside is put back by the next load of the name. The work
    of the plan is done once: the snapshot and the database, if there is one, copy the rows just
    written, with the columns of the table.
    """
    staging, table = new_folder(spark, "staging"), layout.table(job.table)
    swaps = [
        Swap(spark, partition_folder(table, partition_name), f"{table}/_load-{partition_name}"),
        Swap(
            spark,
            f"{layout.snapshots}/{partition_name}",
            f"{layout.snapshots}/_load-{partition_name}",
        ),
    ]
    for swap in swaps:
        swap.recover()
    rows_beside, snapshot_beside = (swap.beside for swap in swaps)
    registered = exists(spark, snapshot_entry_file(layout.snapshot_log, partition_name))
    metric = read_metrics(spark, layout.metrics, run_id).where(F.col("table_name") == job.table)
    metric = metric.first()

    def register(count: int) -> None:
        log_metric(spark, layout.metrics, run_id, job.table, count)
        log_snapshot(
            spark, layout.snapshot_log, job.table, partition_name, layout.snapshots, moment
        )

    begun = done = False
    try:
        result = job.result(rows, staging).drop(*drop)
        result = fit_to_table(result, table, partition_name)
        count = write_serving(result, rows_beside, partition_name)
        written = read_partition(spark, rows_beside, partition_name, result.schema)
        if relational:
            append_jdbc(written, job.table, relational)
        write_snapshot(written, f"{snapshot_beside}/new")
        begun = True
        swaps[0].put(partition_folder(rows_beside, partition_name))
        swaps[1].put(f"{snapshot_beside}/new")
        register(count)
        done = True
    finally:
        if begun and not done:
            for swap in swaps:
                swap.undo()
            forget_snapshot(spark, layout.snapshot_log, partition_name)
            if registered:
                register(metric["inserted_rows"] if metric else 0)
        for swap in swaps:
            remove_folder(spark, swap.beside)
        remove_folder(spark, staging)
    return count


@dataclass(frozen=True)
class Swap:
    """A folder that is exchanged for a new one, and can be put back."""

    spark: SparkSession
    folder: str
    beside: str

    def recover(self) -> None:
        """Put back what a load that was killed has left aside."""
        if exists(self.spark, f"{self.beside}/old") and not exists(self.spark, self.folder):
            move_folder(self.spark, f"{self.beside}/old", self.folder)
        remove_folder(self.spark, self.beside)

    def put(self, new: str) -> None:
        """Move the folder aside, if there is one, and ``new`` into its place, if it is there."""
        move_folder(self.spark, self.folder, f"{self.beside}/old")
        make_folder(self.spark, f"{self.beside}/moved")
        move_folder(self.spark, new, self.folder)

    def undo(self) -> None:
        """Put the earlier folder back; without a `put` before, nothing changes."""
        if exists(self.spark, f"{self.beside}/moved"):
            remove_folder(self.spark, self.folder)
        move_folder(self.spark, f"{self.beside}/old", self.folder)


def run_load(
    spark: SparkSession,
    job: Job,
    landing: str,
    layout: Layout,
    started_at: datetime,
    run_id: str | None = None,
    infer: bool = False,
    clock: Clock = datetime.now,
    relational: Relational | None = None,
    replace: bool = False,
) -> int:
    """Load one landing file or folder and archive it; return the rows inserted.

    ``started_at`` names the partition. A retry of a failed run takes its place; a name whose
    input is archived already is refused before anything is written, unless ``replace`` says
    that the new file's rows are to take the place of the old ones. A failure is logged as
    ``Failed``, raised, and leaves the input where it is, and the rows of an earlier load of the
    name too. Exactly the files that were read go to the archive, into a folder named after the run;
    those of a replacement, which may have the same names, into one with a number of its own.
    """
    name = run_name(job.table, started_at)
    run_id = run_id or name
    archive = f"{layout.archive}/{name}"
    status = "Failed"
    try:
        if not replace and exists(spark, archive):
            raise FileExistsError(f"run {name} is loaded already; replace=True takes its place")
        again = (f"{archive}.{n}" for n in count_from(2))
        archive = next(path for path in chain([archive], again) if not exists(spark, path))
        rows = scan_csv(spark, landing, job.declared, infer=infer)
        files = input_files(rows)
        check_absent(spark, files, archive)
        count = publish(spark, job, rows, layout, name, run_id, started_at, relational=relational)
        status = "Success"
    finally:
        log_run(spark, layout.run_log, run_id, job.script, started_at, clock(), status)
    move_into(spark, files, archive)
    return count
