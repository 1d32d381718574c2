"""Ordered frames and as-of joins in which a key with most of the rows is not one task.

Rows are sorted into ranges of (keys, order), so such a key lies in many parts that follow one
another. Frames are taken within a part; what crosses from part to part is one row of a key and
part, carried over by a window of no more rows than there are parts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.projections import column
from tidemark.storage import new_folder, stored

PART = "_part"


def sorted_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None) -> DataFrame:
    """``df`` stored with the number of the range of (keys, order) that a row lies in.

    The numbers are frozen by the write, so every later pass sees the same ones.
    """
    by = [column(name) for name in (*keys, *order)]
    dealt = df.repartitionByRange(*([parts] if parts else []), *by)
    return stored(
        dealt.withColumn(PART, F.spark_partition_id()), new_folder(df.sparkSession, "ordered")
    )


def _within(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*map(column, (*keys, PART))).orderBy(*map(column, order))


def _carried(rows: DataFrame, carries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of ``carries`` of their key and part; NULL keys are equal."""
    names = [f"_key{i}" for i in range(len(keys))]
    carries = carries.withColumnsRenamed({**dict(zip(keys, names)), PART: "_of_part"})
    same = [F.col(f"rows.`{key}`").eqNullSafe(F.col(name)) for key, name in zip(keys, names)]
    same.append(F.col(f"rows.{PART}") == F.col("_of_part"))
    joined = rows.alias("rows").join(carries, reduce(and_, same), "left")
    return joined.drop(*names, "_of_part", PART)


def _before(keys: Sequence[str]):
    return Window.partitionBy(*map(column, keys)).orderBy(PART)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measure: str,
    out: str,
    parts: int | None = None,
) -> DataFrame:
    """Add ``out``: the sum of ``measure`` over the rows of equal ``keys`` up to the row itself.

    ``order`` has to tell rows of a key apart; rows alike in it have any order. NULL keys form one
    group, NULLs of the order come first, NULL measures are skipped, before any measure the total is
    NULL. ``out`` must be a new name.
    """
    rows = sorted_parts(df, keys, order, parts)
    frame = _within(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.withColumn("_inside", F.sum(column(measure)).over(frame))
    sums = rows.groupBy(*map(column, (*keys, PART))).agg(F.sum(column(measure)).alias("_sum"))
    earlier = _before(keys).rowsBetween(Window.unboundedPreceding, -1)
    carries = sums.withColumn("_before", F.sum("_sum").over(earlier)).drop("_sum")
    both = F.coalesce(F.col("_inside") + F.col("_before"), "_inside", "_before")
    return _carried(inside, carries, keys).withColumn(out, both).drop("_inside", "_before")


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    parts: int | None = None,
) -> DataFrame:
    """Add ``out``: ``value`` of the row before, among the rows of equal ``keys``; NULL for the
    first. NULL keys, the order and ``out`` are as in `running_total`."""
    rows = sorted_parts(df, keys, order, parts)
    # Wrapped, so that a NULL value is told from no row.
    wrapped = F.struct(column(value).alias("value"))
    inside = rows.withColumn("_inside", F.lag(wrapped).over(_within(keys, order)))
    place = F.struct(*map(column, order))
    lasts = rows.groupBy(*map(column, (*keys, PART))).agg(F.max_by(wrapped, place).alias("_last"))
    carries = lasts.withColumn("_before", F.lag("_last").over(_before(keys))).drop("_last")
    found = F.coalesce("_inside", "_before")["value"]
    return _carried(inside, carries, keys).withColumn(out, found).drop("_inside", "_before")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    parts: int | None = None,
) -> DataFrame:
    """Every row of ``left`` with the ``values`` of the last row of ``right`` that has equal
    ``keys`` and a time no later than its own; NULLs without one.

    Both sides are sorted together, right rows first at equal times, and the last right row is
    carried along. Of right rows of one time the one with the largest ``values`` counts. Rows of
    ``right`` without a key or time are left out, rows of ``left`` without one find nothing.
    ``values`` must be new names for ``left``.
    """
    matched = [column(name).isNotNull() for name in keys]
    whole = F.struct(*[column(name) for name in left.columns])
    found = F.struct(*[column(name) for name in values])
    kinds = {field.name: field.dataType for field in right.schema.fields}
    right_rows = right.where(reduce(and_, matched, column(right_time).isNotNull()))
    right_rows = right_rows.groupBy(*map(column, keys), column(right_time).alias("_time")).agg(
        F.max(found).alias("_found")
    )
    left_rows = left.select(
        *map(column, keys), column(left_time).alias("_time"), whole.alias("_row")
    )
    both = left_rows.withColumn("_side", F.lit(1)).unionByName(
        right_rows.withColumn("_side", F.lit(0)), allowMissingColumns=True
    )
    order = ["_time", "_side"]
    rows = sorted_parts(both, keys, order, parts)
    frame = _within(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = rows.withColumn("_inside", F.last("_found", ignorenulls=True).over(frame))
    lasts = rows.where(F.col("_found").isNotNull()).groupBy(*map(column, (*keys, PART))).agg(
        F.max_by("_found", "_time").alias("_last")
    )
    # A part without right rows has none to add, but passes on what came before.
    all_parts = rows.select(*map(column, (*keys, PART))).distinct()
    lasts = _carried(all_parts.withColumn("_at", F.col(PART)), lasts, keys)
    lasts = lasts.withColumnRenamed("_at", PART)
    earlier = _before(keys).rowsBetween(Window.unboundedPreceding, -1)
    carries = lasts.withColumn("_before", F.last("_last", ignorenulls=True).over(earlier))
    joined = _carried(inside.where("_side = 1"), carries.drop("_last"), keys)
    usable = reduce(and_, matched, F.col("_time").isNotNull())
    result = F.when(usable, F.coalesce("_inside", "_before"))
    return joined.withColumn("_result", result).select(
        "_row.*", *[F.col("_result")[name].cast(kinds[name]).alias(name) for name in values]
    )


def _number(df: DataFrame, name: str) -> Column:
    """A column as a number in its own order: seconds for dates and timestamps.

    Timestamps without a zone go by their own fields, so no zone's clock change disturbs them.
    """
    kind, value = dict(df.dtypes)[name], column(name)
    if kind not in ("date", "timestamp_ntz"):
        return value.cast("double")
    days = F.unix_date(value.cast("date")) * F.lit(86400.0)
    if kind == "date":
        return days
    seconds = F.date_part(F.lit("SECONDS"), value).cast("double")
    return days + F.hour(value) * 3600 + F.minute(value) * 60 + seconds


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    low: str,
    high: str,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Pairs of a row of ``points`` and one of ``intervals`` with equal ``keys`` and
    ``low`` <= ``point`` < ``high``: all columns of both, the keys once.

    An interval of a length between two powers of two lies in at most two cells of the larger one,
    whatever its length; a point lies in one cell of every such size that an interval has, at most
    some hundreds. So the join is one of equal keys, sizes and cells, and since a point has one cell
    of a size, a pair is found once. Numbers, dates and timestamps (by seconds) will do. NULL points,
    ends or keys and empty intervals match nothing. Columns other than the keys must differ in name.
    """
    ends = [_number(intervals, end) for end in (low, high)]
    length = ends[1] - ends[0]
    spans = intervals.where(length > 0)
    size = F.ceil(F.log2(length)).cast("int")
    spans = spans.withColumn("_size", size)
    width = F.pow(F.lit(2.0), F.col("_size"))
    cell = [F.floor(end / width) for end in ends]
    spans = spans.withColumn("_cell", F.explode(F.sequence(*cell)))
    sizes = sorted(row["_size"] for row in spans.select("_size").distinct().collect())
    each = F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")).alias("_size")
    cut = points.where(column(point).isNotNull()).select("*", each)
    cut = cut.withColumn("_cell", F.floor(_number(points, point) / width))
    joined = cut.join(spans, [*keys, "_size", "_cell"])
    inside = (column(point) >= column(low)) & (column(point) < column(high))
    return joined.where(inside).drop("_size", "_cell")


def range_overlaps(
    left: DataFrame, right: DataFrame, starts: tuple[str, str], ends: tuple[str, str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Pairs of intervals with equal ``keys`` that share a point: [start, end) of both sides.

    Two intervals overlap if the start of one lies in the other; where both starts are equal the
    pair is taken from the first of the two joins only, so every pair comes once.
    """
    first = range_join(left, right, starts[0], starts[1], ends[1], keys)
    second = range_join(right, left, starts[1], starts[0], ends[0], keys)
    real = column(ends[0]) > column(starts[0])
    both = (column(ends[1]) > column(starts[1])) & real
    later = second.where(column(starts[1]) > column(starts[0]))
    names = first.columns
    return first.where(both).unionByName(later.where(both).select(*map(column, names)))
