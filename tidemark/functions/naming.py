"""Names, paths, dates and durations of runs."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_FOLDER_SAFE = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def check_name(name: str) -> str:
    """``name`` itself if it can stand in a folder path as it is; otherwise an error."""
    if not _FOLDER_SAFE.fullmatch(name):
        raise ValueError(f"not usable as a folder name: {name!r}")
    return name


def run_name(table: str, started_at: datetime) -> str:
    """``<table>_<yyyyMMdd>_<HHmmss>``: one-second resolution, same as `run_name_column`."""
    return check_name(f"{table}_{started_at:%Y%m%d_%H%M%S}")


def run_name_column(table: Column, started_at: Column) -> Column:
    return F.concat_ws("_", table, F.date_format(started_at, "yyyyMMdd_HHmmss"))


def snapshot_path(partition_name: Column, root: str) -> Column:
    """Folder of a snapshot below ``root``."""
    return F.concat(F.lit(root.rstrip("/") + "/"), partition_name)


def run_date(moment: Column) -> Column:
    return F.to_date(moment)


def run_duration(started_at: Column, ended_at: Column) -> Column:
    """Interval between two timestamps."""
    return ended_at.cast("timestamp") - started_at.cast("timestamp")
