"""DataFrame -> DataFrame operators."""

from tidemark.operators.aggregates import (
    concatenate,
    cube_totals,
    last_attempts,
    row_count,
    run_outcome,
)
from tidemark.operators.filters import with_status
from tidemark.operators.joins import delete_rows, lookup, missing_from, succeeded_only
from tidemark.operators.ordered import (
    asof_join,
    previous_value,
    range_join,
    range_overlaps,
    running_total,
)
from tidemark.operators.projections import (
    add_label,
    add_season,
    replace,
    stamp,
    stamp_run,
    to_int,
    to_numeric,
    trim_strings,
)
from tidemark.operators.sketches import (
    distinct_counts,
    distinct_estimate,
    distinct_sketch,
    distinct_sketches,
)
from tidemark.operators.windows import window_total

__all__ = [
    "add_label",
    "add_season",
    "asof_join",
    "concatenate",
    "cube_totals",
    "delete_rows",
    "distinct_counts",
    "distinct_estimate",
    "distinct_sketch",
    "distinct_sketches",
    "last_attempts",
    "lookup",
    "missing_from",
    "previous_value",
    "range_join",
    "range_overlaps",
    "replace",
    "row_count",
    "run_outcome",
    "running_total",
    "stamp",
    "stamp_run",
    "succeeded_only",
    "to_int",
    "to_numeric",
    "trim_strings",
    "window_total",
    "with_status",
]
