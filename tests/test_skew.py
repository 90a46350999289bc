"""A key that fills a third of a side is split over several tasks."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from scanyard.operators import aggregates, joins

c = F.col
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2.0",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def fact(spark, key="k"):
    """120,000 rows, a third of them under key 7."""
    rows = spark.range(0, 120_000, 1, 12)
    hot = F.when(c("id") % 3 == 0, 7).otherwise(c("id") % 500)
    return rows.select(hot.cast("string").alias(key), c("id").cast("string").alias("x"))


def lookup(spark, key="k"):
    return spark.range(0, 400, 1, 4).select(c("id").cast("string").alias(key))


def final_plan(df):
    rows = df.collect()
    # Joins are split at run time only, so the initial plans beside it don't matter.
    return rows, df._jdf.queryExecution().executedPlan().toString()


def grouped(df):
    """Rows that lie by the key already, as after an earlier step of a report."""
    return df.groupBy("k").agg(F.count("*").alias("n"))


CASES = {
    "where_exists": lambda s: joins.where_exists(fact(s), lookup(s), "k"),
    "flag_exists": lambda s: joins.flag_exists(fact(s), lookup(s), "k", "hit"),
    "not_in": lambda s: joins.not_in(fact(s), lookup(s), "k"),
    "outstanding": lambda s: joins.outstanding(fact(s), lookup(s), "k", F.lit(True)),
    "rejoin": lambda s: joins.rejoin(fact(s), lookup(s), "k"),
    "left_join_children": lambda s: joins.left_join_children(
        grouped(lookup(s)), fact(s), "k", lookup(s).select("k")),
}


@pytest.mark.parametrize("name", CASES)
def test_hot_key_is_split(small_partitions, name):
    rows, plan = final_plan(CASES[name](small_partitions))
    assert "skew=true" in plan
    small_partitions.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        unsplit, plan = final_plan(CASES[name](small_partitions))
    finally:
        small_partitions.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    assert "skew=true" not in plan
    assert sorted(rows, key=repr) == sorted(unsplit, key=repr)


def test_one_link_with_many_parents_and_children(small_partitions):
    """300 parents and 40,000 children share one link: 300 sums, not 12 million pairs."""
    spark = small_partitions
    parents = spark.range(300).select(
        c("id").alias("p"), F.when(c("id") < 300, "7").otherwise("8").alias("k"))
    got, plan = final_plan(
        aggregates.count_distinct_through(parents, fact(spark), ["p"], "k", "x", "n"))
    expected = fact(spark).where("k = '7'").select("x").distinct().count()
    assert {r["n"] for r in got} == {expected} and len(got) == 300
    assert not re.search("Cartesian|NestedLoop", plan)


def test_one_link_with_many_parents_and_shared_children(small_partitions):
    """All children lie under a second link too: they are one class, not 12 million pairs."""
    spark = small_partitions
    parents = spark.range(300).select(
        c("id").alias("p"), F.when(c("id") < 300, "7").otherwise("8").alias("k"))
    one = fact(spark).where("k = '7'")
    both = one.unionByName(one.withColumn("k", F.when(c("k") == "7", "8")))
    counted = aggregates.count_distinct_through(parents, both, ["p"], "k", "x", "n")
    got, plan = final_plan(counted)
    expected = one.select("x").distinct().count()
    assert {r["n"] for r in got} == {expected} and len(got) == 300
    shared = counted._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Cartesian|NestedLoop", plan) and "bit_xor" in shared
