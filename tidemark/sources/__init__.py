"""Scans: delimited files, serving tables, registries, snapshot folders."""

from tidemark.sources.delimited import header_of, scan_csv
from tidemark.sources.tables import (
    existing_snapshots,
    read_jdbc,
    read_metrics,
    read_partition,
    read_runs,
    read_serving,
    read_sketches,
    read_snapshots,
    stored_partitions,
)

__all__ = [
    "existing_snapshots",
    "header_of",
    "read_jdbc",
    "read_metrics",
    "read_partition",
    "read_runs",
    "read_serving",
    "read_sketches",
    "read_snapshots",
    "scan_csv",
    "stored_partitions",
]
