"""Physical plans: what is shuffled, pruned, pushed down and broadcast."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators import joins
from tidemark.operators import (
    add_label,
    add_season,
    stamp,
    succeeded_only,
    to_int,
    to_numeric,
    trim_strings,
    window_total,
)
from tidemark.plans.jobs import BATSMEN, BOWLERS, MATCHES
from tidemark.plans.serving import performance_by
from tidemark.sources import scan_csv


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lines(spark, tmp_path):
    spark.range(1000).select(
        (F.col("id") % 100).alias("k"),
        F.col("id").alias("v"),
        F.lit(" x ").alias("s"),
        F.lit("unused").alias("w"),
    ).write.parquet(str(tmp_path / "lines"))
    return spark.read.parquet(str(tmp_path / "lines"))


def test_row_steps_are_one_stage(lines):
    text = lines.withColumn("s", F.col("v").cast("string"))
    for step in (to_int("s"), to_numeric("s"), add_season("s"), add_label("s", "1", "one", "l")):
        text = step(text)
    text = stamp(trim_strings(text), "x_1")
    assert "Exchange" not in plan(text) and "Python" not in plan(text)


@pytest.mark.parametrize("job", [BATSMEN, BOWLERS, MATCHES], ids=lambda job: job.table)
def test_loads_without_total_do_not_shuffle(spark, landing, job):
    path = landing("x.csv", ",".join(job.declared.names))
    assert "Exchange" not in plan(job.clean(scan_csv(spark, path, job.declared)))


def test_filter_on_the_key_reaches_the_scan_of_a_total(lines):
    text = plan(window_total(lines, ["k"], "v", "t").where("k = 5").select("t"))
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,5)]" in text
    assert "w:string" not in text


def test_semi_join_combines_its_keys_first(spark, lines):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(succeeded_only(lines, lines.where("v > 3"), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text
    right = text[text.index("SortMergeJoin") :]
    assert right.count("HashAggregate(keys=[k") == 2


def test_facts_are_aggregated_before_the_dimension_join(spark, lines):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        teams = lines.select(F.col("k").alias("key"), F.col("w").alias("city")).distinct()
        text = plan(performance_by(lines, "k", teams, "key", ["city"], {"n": ("count", "v")}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = text.index("SortMergeJoin")
    assert "partial_count(v" in text[join:] and "partial_sum(n" in text[:join]
    # The aggregation's shuffle is the join's: scan -> partial -> exchange -> final -> join.
    left = text[join : text.index("partial_count(v")]
    assert left.count("Exchange hashpartitioning(k") == 1


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
}


def test_hot_key_of_a_shuffled_delete_is_split(spark, tmp_path):
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000)
    facts = spark.range(0, 600_000, 1, 8).select(key.alias("k"), F.col("id").alias("v"))
    facts.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    missing = spark.range(1000, 3000).select(F.col("id").alias("k"))
    before = {name: spark.conf.get(name) for name in SKEW}
    for name, value in SKEW.items():
        spark.conf.set(name, value)
    try:
        kept = joins.delete_rows(facts, missing, "k")
        count = kept.count()
        counted = kept.groupBy().count()
        counted.collect()
        text = plan(counted)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert "SortMergeJoin(skew=true)" in text, text
    assert count == facts.where("k < 1000 or k >= 3000").count()
