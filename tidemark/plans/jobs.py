"""What is done to each table between its file and its sinks."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.operators.projections import (
    Step,
    add_label,
    add_season,
    to_int,
    to_numeric,
    trim_strings,
)
from tidemark.operators.windows import window_total
from tidemark.storage import stored


@dataclass(frozen=True)
class GroupTotal:
    """A total over the rows of one load."""

    keys: tuple[str, ...]
    measure: str
    out: str


@dataclass(frozen=True)
class Job:
    """Row-wise ``steps`` in order, then at most one ``total``."""

    table: str
    declared: StructType
    steps: tuple[Step, ...]
    total: GroupTotal | None = None

    @property
    def script(self) -> str:
        return f"{self.table}_script"

    def clean(self, df: DataFrame) -> DataFrame:
        return reduce(lambda frame, step: step(frame), self.steps, df)

    def result(self, df: DataFrame, staging: str) -> DataFrame:
        """Cleaned rows with their total. With a total they are stored in ``staging``
        first, since `window_total` passes over them twice."""
        cleaned = self.clean(df)
        if self.total is None:
            return cleaned
        rows, total = stored(cleaned, staging), self.total
        return window_total(rows, total.keys, total.measure, total.out)


# Batsmen and bowlers cast before they trim; matches compares the method before it trims
# and casts afterwards. The order changes results, see the README.
BATSMEN = Job("batsmen", schemas.BATSMEN, (to_int("average"), trim_strings))

BOWLERS = Job(
    "bowlers",
    schemas.BOWLERS,
    (to_numeric("total_overs", "bowling_avg", "economy_rate", "strike_rate"), trim_strings),
)

MATCHES = Job(
    "matches",
    schemas.MATCHES,
    (
        add_season("date"),
        add_label("method", match="D/L", label="rain", out="rained"),
        trim_strings,
        to_int("player_id", "result_margin", "target_runs", "target_overs"),
    ),
)

DELIVERIES = Job(
    "deliveries",
    schemas.DELIVERIES,
    (trim_strings,),
    GroupTotal(("match_id", "inning", "over"), "total_runs", "runs_per_over"),
)

# In the order of the row-count report.
JOBS = (MATCHES, DELIVERIES, BATSMEN, BOWLERS)
