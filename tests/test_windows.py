from __future__ import annotations

from collections import defaultdict

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import window_total

SCHEMA = "match_id int, inning int, over int, total_runs int"
KEYS = ["match_id", "inning", "over"]


def test_nulls(spark):
    data = [(1, 1, 1, 1), (1, 1, 1, None), (1, 1, 2, None), (None, 1, 1, 4), (None, 1, 1, 6)]
    totals = window_total(spark.createDataFrame(data, SCHEMA), KEYS, "total_runs", "t")
    assert totals.schema["t"].dataType.simpleString() == "bigint"
    assert totals.columns == [*KEYS, "total_runs", "t"]
    assert rows(totals) == sorted(
        [(1, 1, 1, 1, 1), (1, 1, 1, None, 1), (1, 1, 2, None, None), (None, 1, 1, 4, 10),
         (None, 1, 1, 6, 10)],
        key=lambda r: [(v is None, str(v)) for v in r],
    )


values = st.tuples(
    st.sampled_from([None, 1, 2]),
    st.sampled_from([None, "a", ""]),
    st.sampled_from([None, 0, 5, -3]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.lists(values, min_size=1, max_size=40))
def test_equals_brute_force(spark, data):
    sums = defaultdict(list)
    for a, b, v in data:
        sums[a, b] += [] if v is None else [v]
    expected = [(a, b, v, sum(sums[a, b]) if sums[a, b] else None) for a, b, v in data]
    frame = spark.createDataFrame(data, "a int, b string, v int")
    order = lambda r: [(x is None, str(x)) for x in r]
    assert rows(window_total(frame, ["a", "b"], "v", "t")) == sorted(expected, key=order)


def test_total_spread_over_its_group_gives_the_sum(spark):
    frame = spark.range(1000).select(
        (F.col("id") % 37).cast("int").alias("k"), (F.col("id") % 11).cast("int").alias("v")
    )
    totals = window_total(frame, ["k"], "v", "t").withColumn("n", F.count("*").over(_by("k")))
    spread = totals.agg(F.sum(F.col("t") / F.col("n"))).first()[0]
    assert round(spread) == frame.agg(F.sum("v")).first()[0]
    assert totals.count() == 1000


def _by(key):
    from pyspark.sql import Window

    return Window.partitionBy(key)


def skewed(spark):
    """A third of the rows share one key, the others are spread thin."""
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500)
    return spark.range(30_000).select(key.cast("int").alias("k"), F.col("id").alias("v"))


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("\n+- == Initial Plan ==")[0]


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.mark.parametrize("width", [0, 2000], ids=["number", "long text"])
def test_a_hot_key_is_split(spark, tmp_path, width):
    frame = skewed(spark)
    if width:
        frame = frame.withColumn("k", F.lpad(F.col("k").cast("string"), width, "x"))
    frame.repartition(16).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    before = {name: spark.conf.get(name, None) for name in SKEW}
    for name, value in SKEW.items():
        spark.conf.set(name, value)
    try:
        totals = window_total(stored, ["k"], "v", "t")
        plan = final_plan(totals)
        assert "SortMergeJoin(skew=true)" in plan and "Window" not in plan, plan
        assert plan.count("Scan parquet") <= 2
        plain = stored.groupBy("k").agg(F.sum("v").alias("t"))
        assert totals.select("k", "t").distinct().exceptAll(plain).count() == 0
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_replaces_a_column_in_another_case(spark):
    frame = spark.createDataFrame([(1, 7, 2), (1, 7, 3)], "k int, TOTAL long, v int")
    assert window_total(frame, ["k"], "v", "total").columns == ["k", "total", "v"]
    assert rows(window_total(frame, ["k"], "v", "total")) == [(1, 5, 2), (1, 5, 3)]


def test_keys_equal_but_not_in_bytes(spark):
    zeros = [(-0.0, 1), (0.0, 2), (float("nan"), 4), (float("nan"), 8), (None, 16)]
    frame = spark.createDataFrame(zeros, "k double, v int")
    totals = window_total(frame, ["k"], "v", "t").select("v", "t")
    assert rows(totals) == [(1, 3), (16, 16), (2, 3), (4, 12), (8, 12)]
    names = spark.createDataFrame([("a", 1), ("A", 2), ("b", 4)], "k string, v int")
    folded = names.withColumn("k", F.collate("k", "UTF8_LCASE"))
    assert rows(window_total(folded, ["k"], "v", "t").select("v", "t")) == [
        (1, 3), (2, 3), (4, 4),
    ]


def test_long_keys(spark):
    data = [("x" * 2000, 1), ("x" * 2000, 2), ("y", 4), ("y", 8), (None, 16), (None, 32)]
    frame = spark.createDataFrame(data, "k string, v int")
    assert rows(window_total(frame, ["k"], "v", "t").select("v", "t")) == [
        (1, 3), (16, 48), (2, 3), (32, 48), (4, 12), (8, 12),
    ]


def test_column_names_with_dots(spark):
    frame = spark.createDataFrame([(1, 2), (1, 3)], "`k.x` int, `v.y` int")
    assert rows(window_total(frame, ["k.x"], "v.y", "t.z")) == [(1, 2, 5), (1, 3, 5)]


def test_replaces_an_existing_column_in_place(spark):
    frame = spark.createDataFrame([(1, 7, 2), (1, 7, 3)], "k int, t long, v int")
    assert window_total(frame, ["k"], "v", "t").columns == ["k", "t", "v"]
    assert rows(window_total(frame, ["k"], "v", "t")) == [(1, 5, 2), (1, 5, 3)]
    assert rows(window_total(frame, ["k"], "v", "v")) == [(1, 7, 5), (1, 7, 5)]
