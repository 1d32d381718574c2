from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, IntegerType, LongType, StringType

from tidemark.functions import (
    capitalise,
    check_name,
    label_when,
    parse_int,
    run_date,
    run_duration,
    run_name,
    run_name_column,
    safe_cast,
    safe_int,
    safe_numeric,
    season_of,
    snapshot_path,
    trim_spaces,
)


def apply(spark, kind, values, function):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in frame.orderBy("i").select(function(F.col("v"))).collect()]


TEXT, DOUBLE = StringType(), DoubleType()


@pytest.mark.parametrize("source", [None, TEXT], ids=["plain", "guarded"])
def test_safe_int_from_text(spark, ansi, source):
    texts = ["9.7", " 12 ", "NA", "1e2", "", "-5", "+6", "3000000000", None]
    assert apply(spark, "string", texts, lambda c: safe_int(c, source)) == [
        None, 12, None, None, None, -5, 6, None, None,
    ]


@pytest.mark.parametrize("source", [None, DOUBLE], ids=["plain", "guarded"])
def test_safe_int_from_double(spark, ansi, source):
    values = [9.7, -9.7, 3e9, float("nan"), float("inf"), None, 2147483647.9, -2147483648.9]
    assert apply(spark, "double", values, lambda c: safe_int(c, source)) == [
        9, -9, None, None, None, None, 2147483647, -2147483648,
    ]


def test_safe_int_via_double_keeps_decimals(spark, ansi):
    texts = ["9.7", "NULL", "38.86", "1e2", "7"]
    for source in (None, TEXT):
        kept = apply(spark, "string", texts, lambda c: safe_int(c, source, via_double=True))
        assert kept == [9, None, 38, 100, 7]


ODD_TEXTS = [
    "\t7\n", "7\r\n", "\x007", "7\x7f", "\u00a07", "7\u2028", "\u20037",
    "+", "-", "- 7", "--7", "07",
    "000000000000000000000000007", "2147483647", "2147483648", "-2147483648", "-2147483649",
    "9999999999", "99999999999", "9223372036854775807", "9223372036854775808", "7.", ".7",
    "7.0", "7f", "0x7", "\u0667", "7 7", "1_000", "1,000", "Infinity", "NaN", "7L", "\x1c7",
]


@pytest.mark.parametrize("target", [IntegerType(), LongType()], ids=str)
def test_guarded_text_cast_equals_try_cast(spark, ansi, target):
    plain = apply(spark, "string", ODD_TEXTS, lambda c: c.try_cast(target))
    assert apply(spark, "string", ODD_TEXTS, lambda c: safe_cast(c, TEXT, target)) == plain


def test_guarded_casts_equal_try_cast_on_random_values(spark):
    draw = random.Random(7)
    texts = ["".join(draw.choices("0123456789+- .eE\t\x00\x7f\u00a0", k=draw.randint(0, 12)))
             for _ in range(20_000)]
    numbers = [draw.choice([1, -1]) * 10 ** draw.uniform(-3, 14) for _ in range(20_000)]
    numbers += [2**31 + d / 8 for d in range(-16, 17)] + [-(2**31) + d / 8 for d in range(-16, 17)]
    numbers += [1e10 + d / 8 for d in range(-16, 17)] + [-1e10 + d / 8 for d in range(-16, 17)]
    for kind, values, targets in (
        ("string", texts, (IntegerType(), LongType())),
        ("double", numbers, (IntegerType(), DecimalType(10, 0), DecimalType(12, 2))),
    ):
        frame = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        source = frame.schema[0].dataType
        for target in targets:
            plain = F.col("v").try_cast(target)
            same = safe_cast(F.col("v"), source, target).eqNullSafe(plain)
            seen = frame.agg(F.count_if(~same), F.count(plain)).first()
            assert seen[0] == 0 and seen[1] > 500


ODD_NUMBERS = [
    0.0, -0.0, 0.5, -0.5, 2147483647.0, 2147483647.5, 2147483648.0, -2147483648.0,
    -2147483648.5, -2147483649.0, 9999999999.0, 9999999999.4, 9999999999.5, 1e10, -9999999999.4,
    -9999999999.5, -1e10, 1e300, -1e300, float("nan"), float("inf"), float("-inf"), 4.9e-324, None,
]


@pytest.mark.parametrize("kind", ["double", "float", "decimal(30,4)", "bigint"])
def test_guarded_number_cast_equals_try_cast(spark, ansi, kind):
    values = [
        row[0]
        for row in spark.createDataFrame([(v,) for v in ODD_NUMBERS], "v double")
        .select(F.col("v").try_cast(kind))
        .collect()
    ]
    source = spark.createDataFrame([], f"v {kind}").schema[0].dataType
    for target in (IntegerType(), DecimalType(10, 0), DecimalType(8, 2)):
        plain = apply(spark, kind, values, lambda c: c.try_cast(target))
        assert apply(spark, kind, values, lambda c: safe_cast(c, source, target)) == plain


@pytest.mark.parametrize("source", [None, DOUBLE], ids=["plain", "guarded"])
def test_safe_numeric_rounds_half_away_from_zero(spark, ansi, source):
    values = [2.5, 3.5, -2.5, -0.5, 12.25, 1e12, None]
    expected = [3, 4, -3, -1, 12, None, None]
    assert apply(spark, "double", values, lambda c: safe_numeric(c, source)) == [
        None if v is None else Decimal(v) for v in expected
    ]
    assert apply(spark, "string", ["2.5", "x"], safe_numeric) == [Decimal(3), None]
    tenth = apply(spark, "double", [2.55], lambda c: safe_numeric(c, source, scale=1))
    assert tenth == [Decimal("2.6")]


def test_season_needs_the_year_at_seven(spark):
    texts = ["18-04-2008", "2008-04-18", "2008", "", None]
    assert apply(spark, "string", texts, season_of) == ["2008", "4-18", "", "", None]


def test_label_is_exact_and_null_safe(spark):
    texts = ["D/L", " D/L ", "NA", None]
    labelled = apply(spark, "string", texts, lambda c: label_when(c, "D/L", "rain"))
    assert labelled == ["rain", None, None, None]


def test_trim_strips_spaces_only(spark):
    texts = ["  a b  ", "\ta ", " a ", "   ", None]
    assert apply(spark, "string", texts, trim_spaces) == ["a b", "\ta", " a ", "", None]


def test_capitalise(spark):
    texts = ["batsmen", "ROW count", "x", "", None]
    assert apply(spark, "string", texts, capitalise) == ["Batsmen", "Row count", "X", "", None]


def test_parse_int(spark, ansi):
    assert apply(spark, "string", [" 668 ", "7\n", "x", None], parse_int) == [668, 7, None, None]


def test_run_names_agree(spark):
    moment = datetime(2025, 4, 18, 9, 5, 7, 999999)
    assert run_name("bowlers", moment) == "bowlers_20250418_090507"
    frame = spark.createDataFrame([("bowlers", moment)], "t string, m timestamp_ntz")
    named = frame.select(run_name_column(F.col("t"), F.col("m")).alias("n")).first()["n"]
    assert named == "bowlers_20250418_090507"


def test_paths_and_dates(spark):
    frame = spark.createDataFrame(
        [("x_1", datetime(2025, 4, 18, 23, 59), datetime(2025, 4, 19, 0, 1, 30))],
        "n string, a timestamp_ntz, b timestamp_ntz",
    )
    row = frame.select(
        snapshot_path(F.col("n"), "/partitions"),
        snapshot_path(F.col("n"), "/partitions/"),
        run_date(F.col("a")),
        run_duration(F.col("a"), F.col("b")),
    ).first()
    assert tuple(row) == (
        "/partitions/x_1", "/partitions/x_1", date(2025, 4, 18), timedelta(seconds=150),
    )


@pytest.mark.parametrize("name", ["", "../x", "a/b", "a b", "a=b", ".hidden", "_hidden", "x\n"])
def test_unsafe_names_are_refused(name):
    with pytest.raises(ValueError):
        check_name(name)
