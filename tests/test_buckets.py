"""Bucketed tables: grouped and joined by batch where they lie, with large batches in slices."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from scanyard.operators import joins
from scanyard.plans import extracts, outstanding, summary
from scanyard.plans.config import FCS, OMPF, VAULT
from scanyard.sources import buckets
from scanyard.sources.roles import derive_roles
from tests.conftest import AS_OF
from tests.plan_metrics import counters

START, SF, NUMBER = datetime(1995, 1, 1), "/root/testdata/sf0.001", 4


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    """Role tables as they are, and with the bucketed ones; batches of four rows are large."""
    base = str(tmp_path_factory.mktemp("bucketed"))
    roles = derive_roles(spark, SF)
    buckets.store_bucketed(roles, base, NUMBER, rows=3)
    return roles, buckets.load_bucketed(spark, base, NUMBER, roles), base


@pytest.fixture
def shuffled(spark):
    """Joins as between tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("report, line", [
    (extracts.intake_master, FCS), (extracts.intake_master, OMPF),
    (extracts.upload_records, VAULT), (extracts.upload_records, OMPF),
    (summary.r01_box_summary, FCS), (summary.r05_box_summary, OMPF),
    (outstanding.r02_outstanding_batches, FCS), (outstanding.r07_open_folders, OMPF)])
def test_reports_are_the_same(both, report, line):
    plain, bucketed, _ = both
    more = () if report in (extracts.intake_master, extracts.upload_records) else (AS_OF,)
    line = line.starting(START)
    assert rows(report(bucketed, line, *more)) == rows(report(plain, line, *more))


def _exchanges_over(df, table: str) -> list[str]:
    """Exchanges between the top and the scan of a table, of which there is one."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if f"default.{table}_" in line and "Scan" in line)
    found, depth = [], len(lines[at])
    for line in reversed(lines[:at + 1]):
        indent = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if indent < depth:
            depth = indent
            if "Exchange" in line:
                found.append(line.strip())
    return found


def test_folders_are_joined_where_they_lie(shuffled, both):
    plain, bucketed, base = both
    batches = plain["physical_batch"].select(F.col("PBatch").alias("BatchName"), "RMN")
    joined = extracts.with_folders(bucketed, batches)
    assert _exchanges_over(joined, "folder_map") == []
    moved = extracts.with_folders(plain, batches)
    assert rows(joined) == rows(moved.select(*joined.columns))


def test_records_are_grouped_where_they_lie(shuffled, both):
    _, bucketed, base = both
    line = VAULT.starting(START)
    records = extracts.upload_records(bucketed, line)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and f"Bucketed: true" in plan


def test_a_hot_batch_is_joined_in_several_tasks(shuffled, frame, tmp_path):
    spark = shuffled
    folders = spark.range(0, 30_000, 1, 6).select(
        F.lit("A").alias("RMN"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("b"), F.col("id") % 500)).alias("PBatch"),
        F.col("id").cast("string").alias("dcsid"),
        F.lit("2001-01-01").cast("timestamp_ntz").alias("InvTime"))
    roles = derive_roles(spark, SF)
    own = dict(roles) | {"folder_map": folders}
    buckets.store_bucketed(own, str(tmp_path), 8, rows=1000)
    tables = buckets.load_bucketed(spark, str(tmp_path), 8, own)
    assert [tuple(r) for r in tables["folder_map_slices"].collect()] == [("hot", 10)]
    names = folders.select(F.col("PBatch").alias("BatchName")).distinct().unionByName(
        spark.createDataFrame([("alone",), (None,)], "BatchName string"))
    joined = extracts.with_folders(tables, names)
    hot = joined.where("BatchName = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) >= 4 and sum(r["count"] for r in hot) == 10_000
    assert joined.count() == 30_000 + 2
    assert joined.where("dcsid is null").count() == 2
    read = counters(spark, lambda: joined.write.format("noop").mode("overwrite").save())
    sorted_rows = [m.get("shuffle records written", 0) for n, d, m in read if n == "Exchange"]
    assert sum(sorted_rows) < 5_000  # parents and slice list only


@pytest.mark.parametrize("most, join", [(2, "BroadcastHashJoin"), (1, "ShuffledHashJoin")])
def test_the_slice_list_is_joined_without_sorting_the_rows(shuffled, frame, values, tmp_path,
                                                           monkeypatch, most, join):
    monkeypatch.setattr(buckets, "MOST_BROADCAST", most)
    frame("PBatch string, slices int", [("hot", 3), ("warm", 2)]).write.parquet(str(tmp_path / "s"))
    slices = shuffled.read.parquet(str(tmp_path / "s"))
    rows_of = frame("PBatch string, n int", [("hot", 1), ("hot", 1), ("b", 2), (None, 3)])
    got = buckets.with_slices(rows_of, slices)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert join in plan and "SortMergeJoin" not in plan
    assert values(got, "PBatch", "n", "slices") == sorted(
        [("hot", 1, 3), ("hot", 1, 3), ("b", 2, None), (None, 3, None)], key=repr)


def test_sliced_join_keeps_parents_without_children(frame, values):
    parents = frame("k string, n int", [("a", 1), ("b", 2), (None, 3), ("hot", 4), ("hot", 5)])
    children = frame("k string, slice int, x int",
                     [("a", 0, 7), ("hot", 0, 8), ("hot", 2, 9), ("gone", 0, 1)])
    got = joins.left_join_sliced(parents, children, "k", frame("k string, s int", [("hot", 4)]))
    assert values(got, "k", "n", "x") == sorted(
        [("a", 1, 7), ("b", 2, None), (None, 3, None), ("hot", 4, 8), ("hot", 4, 9),
         ("hot", 5, 8), ("hot", 5, 9)], key=repr)
