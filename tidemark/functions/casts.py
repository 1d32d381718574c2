"""Casts that give NULL instead of failing, with ANSI mode on or off.

``try_cast`` alone gives the right values, but every value it refuses costs a caught
exception, more than ten times an accepted one. Where the source type is known, a cheap test
that all accepted values pass goes first, so a column of mostly unusable values is about as
fast as a clean one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    FractionalType,
    IntegerType,
    LongType,
    NumericType,
    StringType,
)

# Spark's cast accepts a sign, digits and, around them, spaces and control characters.
WHOLE_NUMBER = r"^[\x00-\x20\x7F]*[+-]?0*[0-9]{1,%d}[\x00-\x20\x7F]*$"
MOST_DIGITS = {IntegerType: 10, LongType: 19}
INT_BOUND = 2**31


def _castable(value: Column, source: DataType | None, target: DataType) -> Column | None:
    """A test that holds for every value ``try_cast`` accepts; None if there is none."""
    if isinstance(source, StringType) and type(target) in MOST_DIGITS:
        return value.rlike(WHOLE_NUMBER % MOST_DIGITS[type(target)])
    if isinstance(source, NumericType) and isinstance(target, IntegerType):
        # The fraction is cut off, so anything up to one beyond the lowest may still fit.
        return value.cast("double").between(-INT_BOUND - 1.0, float(INT_BOUND))
    if isinstance(source, (DoubleType, FloatType)) and isinstance(target, DecimalType):
        return F.abs(value) <= 10.0 ** (target.precision - target.scale)
    return None


def safe_cast(value: Column, source: DataType | None, target: DataType) -> Column:
    """``try_cast`` to ``target``; with the type of ``value`` given, refusals are cheap."""
    castable = _castable(value, source, target)
    cast = value.try_cast(target)
    return cast if castable is None else F.when(castable, cast)


def safe_int(value: Column, source: DataType | None = None, via_double: bool = False) -> Column:
    """Integer or NULL.

    Text must be a whole number, spaces around it allowed: decimal and exponent texts give
    NULL. A double is cut toward zero; NaN and out-of-range values give NULL. With
    ``via_double`` decimal text is read as a double first, and so kept.
    """
    if via_double and not isinstance(source, FractionalType):
        value, source = safe_cast(value, source, DoubleType()), DoubleType()
    return safe_cast(value, source, IntegerType())


def safe_numeric(
    value: Column, source: DataType | None = None, precision: int = 10, scale: int = 0
) -> Column:
    """Decimal or NULL, rounding half away from zero; by default a whole number."""
    return safe_cast(value, source, DecimalType(precision, scale))


def parse_int(text: Column) -> Column:
    """Whole number from text such as a stored row count; NULL if it is not one."""
    return safe_cast(F.trim(text), StringType(), LongType())
