"""Column functions with the exact cast, text and naming rules of the loads."""

from tidemark.functions.casts import parse_int, safe_cast, safe_int, safe_numeric
from tidemark.functions.naming import (
    check_name,
    run_date,
    run_duration,
    run_name,
    run_name_column,
    snapshot_path,
)
from tidemark.functions.text import capitalise, label_when, season_of, trim_spaces

__all__ = [
    "capitalise",
    "check_name",
    "label_when",
    "parse_int",
    "run_date",
    "run_duration",
    "run_name",
    "run_name_column",
    "safe_cast",
    "safe_int",
    "safe_numeric",
    "season_of",
    "snapshot_path",
    "trim_spaces",
]
