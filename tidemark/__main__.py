"""Command line: ``python -m tidemark load batsmen --root hdfs:///data --landing ...``.

Ends with a non-zero exit code when the work fails, also under ``spark-submit``.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from tidemark.plans.jobs import JOBS
from tidemark.plans.layout import Layout
from tidemark.plans.load import run_load
from tidemark.plans.reconcile import reconcile
from tidemark.plans.report import report_for
from tidemark.session import build_session, sizing
from tidemark.sinks import Relational
from tidemark.storage import total_bytes
from tidemark.streaming import ingest

TABLES = {job.table: job for job in JOBS}


def _relational(args: argparse.Namespace) -> Relational | None:
    if not args.jdbc_url:
        return None
    options = {}
    if args.jdbc_options:
        with open(args.jdbc_options, encoding="utf-8") as file:
            options = json.load(file)
    return Relational(args.jdbc_url, options)


def _load(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = run_load(
        spark,
        TABLES[args.table],
        args.landing,
        Layout.below(args.root),
        args.started_at,
        run_id=args.run_id,
        infer=args.infer,
        replace=args.replace,
        relational=_relational(args),
    )
    print(f"{args.table}: {rows} rows inserted")


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    query = ingest(
        spark,
        TABLES[args.table],
        args.landing,
        Layout.below(args.root),
        args.checkpoint,
        per_file=not args.per_batch,
        columns=args.columns.split(",") if args.columns else None,
        relational=_relational(args),
    )
    if query is None:
        print(f"{args.table}: no file yet")
    else:
        query.awaitTermination()


def _report(spark: SparkSession, args: argparse.Namespace) -> None:
    # At most one row per table.
    for row in report_for(spark, Layout.below(args.root), args.run_id).collect():
        counts = f"Total Rows: {row['total_rows']}, Inserted Rows: {row['inserted_rows']}"
        print(f"{row['label']}: {counts if row['status'] == 'OK' else row['status']}")


def _reconcile(spark: SparkSession, args: argparse.Namespace) -> None:
    missing = reconcile(spark, Layout.below(args.root), prune_log=args.prune_log)
    for row in missing.toLocalIterator():
        print(f"deleted rows of missing snapshot: {row['partition_name']}")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("--input-bytes", type=int, help="size of the input; of the landing files if not given")
    parser.add_argument("--cores", type=int, help="cores of the cluster; Spark's own count if not given")
    actions = parser.add_subparsers(required=True)

    def action(name, function, help_text):
        sub = actions.add_parser(name, help=help_text)
        sub.set_defaults(function=function)
        sub.add_argument("--root", required=True, help="folder of all tables and registries")
        return sub

    for name, function, help_text in (
        ("load", _load, "load a landing file or folder and archive it"),
        ("ingest", _ingest, "load what is new in a landing folder"),
    ):
        sub = action(name, function, help_text)
        sub.add_argument("table", choices=TABLES)
        sub.add_argument("--landing", required=True)
        sub.add_argument("--jdbc-url")
        sub.add_argument("--jdbc-options", help="JSON file with driver, user, password, ...")
        if name == "load":
            sub.add_argument("--started-at", type=datetime.fromisoformat, default=datetime.now())
            sub.add_argument("--run-id")
            sub.add_argument("--replace", action="store_true", help="replace a finished run")
            sub.add_argument("--infer", action="store_true", help="guess all types from the data")
        else:
            sub.add_argument("--checkpoint", required=True)
            sub.add_argument("--columns", help="header, if no file is there yet")
            sub.add_argument("--per-batch", action="store_true", help="totals over the batch")

    report = action("report", _report, "row counts of one run")
    report.add_argument("--run-id", required=True)
    clean = action("reconcile", _reconcile, "drop the rows of missing snapshots")
    clean.add_argument("--prune-log", action="store_true", help="also drop their registry rows")
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session("tidemark")
    landing = getattr(args, "landing", None)
    size = args.input_bytes or (total_bytes(spark, landing) if landing else 0)
    if size:
        for key, value in sizing(size, args.cores or spark.sparkContext.defaultParallelism).items():
            spark.conf.set(key, value)
    args.function(spark, args)


if __name__ == "__main__":
    main()
