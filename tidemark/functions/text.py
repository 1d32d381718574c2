"""String functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_spaces(text: Column) -> Column:
    """Strip U+0020 at both ends; tabs and no-break spaces stay."""
    return F.trim(text)


def season_of(date_text: Column) -> Column:
    """Characters 7 to 10: the year of a ``dd-MM-yyyy`` text; ``''`` if it is too short."""
    return F.substring(date_text, 7, 4)


def label_when(value: Column, match: str, label: str) -> Column:
    """``label`` where ``value`` equals ``match``, NULL elsewhere, also for a NULL value."""
    return F.when(value == match, F.lit(label))


def capitalise(text: Column) -> Column:
    """First letter upper case, all others lower case."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.lower(F.substr(text, F.lit(2))))
