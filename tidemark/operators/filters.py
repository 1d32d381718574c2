"""Status filter over task rows."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_status(
    tasks: DataFrame,
    status: str,
    without: Collection[str] = (),
    status_column: str = "status",
    task_column: str = "script_name",
) -> DataFrame:
    """Tasks in ``status``, minus the tasks named in ``without``."""
    kept = tasks.where(F.col(status_column) == status)
    return kept.where(~F.col(task_column).isin(*without)) if without else kept
