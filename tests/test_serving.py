from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.plans.serving import performance, performance_by, season_outcomes, top_k


def test_top_k_breaks_ties_by_name(spark):
    data = [("b", 5), ("a", 5), ("c", 9), ("d", None), ("e", 1)]
    scorers = spark.createDataFrame(data, "name string, runs int")
    best = top_k(scorers, "runs", ["name"], 3)
    assert [tuple(r) for r in best.collect()] == [("c", 9), ("a", 5), ("b", 5)]
    assert "TakeOrderedAndProject" in best._jdf.queryExecution().executedPlan().toString()


def test_outcomes_count_only_the_flagged(spark):
    data = [("2008", "rain"), ("2008", None), ("2009", None), (None, "rain")]
    matches = spark.createDataFrame(data, "season string, rained string")
    outcomes = season_outcomes(matches, F.col("season"), F.col("rained") == "rain")
    assert rows(outcomes) == [("2008", 2, 1), ("2009", 1, 0), (None, 1, 1)]


def test_performance_over_a_dimension_equals_the_plain_join(spark):
    facts = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("team"),
        F.when(F.col("id") % 97 != 0, F.col("id") % 13).alias("runs"),
        (F.col("id") % 2).alias("inning"),
    )
    teams = spark.range(40).select(F.col("id").alias("key"), (F.col("id") % 4).alias("city"))
    measures = {
        "n": ("count", "runs"), "total": ("sum", "runs"), "low": ("min", "runs"),
        "high": ("max", "runs"),
    }
    keys = ["city", "inning"]
    plain = performance(facts.join(teams, F.col("team") == F.col("key")), keys, measures)
    early = performance_by(facts, "team", teams, "key", keys, measures)
    assert rows(early) == rows(plain)


def test_facts_come_first_for_a_column_in_both(spark):
    facts = spark.createDataFrame([(1, "a", 5), (1, "b", 7)], "k int, name string, v int")
    teams = spark.createDataFrame([(1, "x")], "k int, name string")
    result = performance_by(facts, "k", teams, "k", ["name"], {"total": ("sum", "v")})
    assert rows(result) == [("a", 5), ("b", 7)]


def test_unknown_aggregate_is_refused(spark):
    with pytest.raises(ValueError, match="avg"):
        performance(spark.range(1), ["id"], {"x": ("avg", "id")})
