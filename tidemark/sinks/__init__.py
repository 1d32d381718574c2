"""Sinks: serving table, snapshot, registries, relational append, archive."""

from tidemark.sinks.registries import (
    forget_snapshot,
    log_metric,
    log_run,
    log_sketches,
    log_snapshot,
)
from tidemark.sinks.tables import (
    Relational,
    append_jdbc,
    drop_partition,
    write_runs,
    fit_to_table,
    write_serving,
    write_serving_sketched,
    write_snapshot,
)

__all__ = [
    "Relational",
    "append_jdbc",
    "drop_partition",
    "forget_snapshot",
    "log_metric",
    "log_run",
    "log_sketches",
    "log_snapshot",
    "write_runs",
    "fit_to_table",
    "write_serving",
    "write_serving_sketched",
    "write_snapshot",
]
