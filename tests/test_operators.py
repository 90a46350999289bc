from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scanyard.operators import aggregates, joins, ordering, projection, sets
from tests.conftest import AS_OF

c = F.col


def test_not_in_follows_the_null_rules(frame, values):
    left = frame("k string, n int", [("a", 1), ("b", 2), (None, 3)])

    def kept(rows):
        return [n for n, in values(joins.not_in(left, frame("k string", rows), "k"), "n")]
    assert kept([("a",)]) == [2]
    assert kept([("a",), (None,)]) == []
    assert kept([("z",)]) == [1, 2]
    assert kept([]) == [1, 2, 3]


def test_not_in_keeps_columns_in_order(frame):
    left = frame("n int, k string", [(1, "a")])
    assert joins.not_in(left, frame("other string", []), "k", "other").columns == ["n", "k"]


def test_outstanding_is_not_an_anti_join(frame, values):
    left = frame("b string", [("none",), ("done",), ("open",), ("mixed",)])
    right = frame("b string, t string", [("done", "x"), ("open", None), ("mixed", "x"),
                                         ("mixed", None), ("mixed", None)])
    got = values(joins.outstanding(left, right, "b", c("t").isNull()))
    assert got == [("mixed",), ("none",), ("open",)]


def test_flag_exists_keeps_rows_once(frame, values):
    left = frame("k string", [("a",), ("a",), ("b",), (None,)])
    right = frame("k string, v int", [("a", 1), ("a", 2), ("b", 3)])
    got = values(joins.flag_exists(left, right, "k", "hit", c("v") < 3))
    assert got == [("a", True), ("a", True), ("b", False), (None, False)]


def test_where_exists_keeps_rows_once(frame, values):
    left = frame("k string", [("a",), ("a",), ("b",)])
    right = frame("k string", [("a",), ("a",)])
    assert values(joins.where_exists(left, right, "k")) == [("a",), ("a",)]


def test_left_join_children(frame, values):
    parents = frame("k string, p int", [("a", 1), ("b", 2), (None, 3)])
    children = frame("k string, x string", [("a", "u"), ("a", "v"), ("a", None), ("z", "w")])
    expected = values(parents.join(children, "k", "left"))
    got = joins.left_join_children(parents, children, "k", parents.select("k"))
    assert values(got.select("k", "p", "x")) == expected


def test_rejoin_replaces_absent_keys_by_null(frame, values):
    left = frame("p int, k string", [(1, "a"), (2, "b"), (3, None)])
    right = frame("k string", [("a",), ("a",), (None,)])
    assert values(joins.rejoin(left, right, "k")) == [(1, "a"), (2, None), (3, None)]


def naive_nonworking(calendar, start, as_of):
    return sum(start <= datetime.combine(day, datetime.min.time()) <= as_of
               and (name in ("Saturday", "Sunday") or note is not None)
               for day, name, note in calendar)


@pytest.mark.parametrize("as_of", [AS_OF, datetime(2001, 6, 16), datetime(2001, 5, 20, 1)])
@pytest.mark.parametrize("keep", [1.0, 0.4])
def test_nonworking_days_match_the_range_count(spark, frame, as_of, keep):
    """Dense and sparse calendars, repeated days, times at midnight, before and after it all."""
    rng = random.Random(7)
    first = datetime(2001, 4, 1)
    calendar = []
    for n in range(120):
        day = first + timedelta(days=n)
        if rng.random() < keep:
            note = "Holiday" if n % 17 == 0 else None
            calendar += [(day.date(), day.strftime("%A"), note)] * (2 if n % 29 == 0 else 1)
    starts = [first + timedelta(hours=rng.randrange(-400, 3200)) for _ in range(300)]
    starts += [first + timedelta(days=n) for n in range(-3, 125)]
    df = frame("i int, t timestamp_ntz", [(i, str(t)) for i, t in enumerate(starts)] + [(-1, None)])
    days = frame("calendardate date, DayOfWeekName string, CalendarDateDescription string",
                 [(str(d), n, t) for d, n, t in calendar])
    got = {r["i"]: r["nonworking"]
           for r in joins.nonworking_days(df, days, "t", as_of).collect()}
    assert got == {i: naive_nonworking(calendar, t, as_of) for i, t in enumerate(starts)} | {-1: 0}


def test_nonworking_days_without_a_calendar(frame, values):
    df = frame("t timestamp_ntz", [("2001-06-01 00:00:00",)])
    none = frame("calendardate date, DayOfWeekName string, CalendarDateDescription string", [])
    assert values(joins.nonworking_days(df, none, "t", AS_OF), "nonworking") == [(0,)]


def test_nonworking_days_need_no_row_by_day_comparison(frame):
    df = frame("t timestamp_ntz", [("2001-06-01 00:00:00",)])
    days = frame("calendardate date, DayOfWeekName string, CalendarDateDescription string", [])
    plan = joins.nonworking_days(df, days, "t", AS_OF)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("seed", range(4))
def test_count_distinct_through_matches_the_plain_join(frame, values, seed):
    """Parents share links, links share children, one link is hot, keys may be NULL."""
    rng = random.Random(seed)
    links = ["hot", None] + [f"l{n}" for n in range(12)]
    parents = frame("p int, l string", [(rng.randrange(6), rng.choice(links)) for _ in range(60)])
    children = frame("l string, x string", [
        (rng.choice(links + ["hot"] * 8), rng.choice([None] + [f"x{n}" for n in range(90)]))
        for _ in range(150)])
    plain = parents.join(children, "l").groupBy("p").agg(
        F.count_distinct("x").alias("n")).where("n > 0")
    got = aggregates.count_distinct_through(parents, children, ["p"], "l", "x", "n")
    assert values(got, "p", "n") == values(plain, "p", "n")


def test_count_distinct_through_by_kind(frame, values):
    parents = frame("p int, l string", [(1, "a"), (1, "b"), (2, "b")])
    children = frame("k string, l string, x string", [
        ("u", "a", "x"), ("u", "b", "x"), ("v", "a", "x"), ("v", "b", "y"), ("v", "b", "y")])
    got = aggregates.count_distinct_through(parents, children, ["p"], "l", "x", "n", "k")
    assert values(got, "p", "k", "n") == [(1, "u", 1), (1, "v", 2), (2, "u", 1), (2, "v", 1)]


def test_rollup_without_rows(frame, values):
    none = frame("d string, n bigint", [])
    assert values(aggregates.rollup_total(none, "d", ["n"])) == []
    assert values(aggregates.rollup_total(none, "d", ["n"], always=True)) == [("Total", None)]


@pytest.mark.parametrize("always", [False, True])
def test_rollup_tells_a_null_key_from_the_total(frame, values, always):
    rows = frame("d string, n bigint", [("a", 1), ("a", 2), (None, 4)])
    got = values(aggregates.rollup_total(rows, "d", ["n"], always=always))
    assert got == [("Total", 7), ("a", 3), (None, 4)]


def test_mean_pivot(frame, values):
    rows = frame("k string, l string, z int, a int", [
        ("x", "u", 1, None), ("x", "u", 2, None), ("x", None, 9, 9), ("y", "u", None, None)])
    got = aggregates.mean_pivot(rows, ["k", "l"], ["z", "a"])
    assert got.columns == ["k", "l", "a", "z"]
    assert values(got) == [("x", "u", "-", "1.5")]


def test_flag_max(frame, values):
    rows = frame("k string, n int", [("a", 1), ("b", 5), ("c", 5)])
    assert values(aggregates.flag_max(rows, ["n"])) == [
        ("a", 1, False), ("b", 5, True), ("c", 5, True)]
    totals = frame("k string, n int", [("a", 1), ("Total", 6)])
    assert values(aggregates.flag_max(totals, ["n"], "k")) == [
        ("Total", 6, True, True), ("a", 1, False, False)]


def test_column_widths(frame, values):
    rows = frame("ab string, longname int", [("abcdef", 1), (None, 123)])
    assert values(aggregates.column_widths(rows)) == [("ab", 6), ("longname", 8)]
    nulls = frame("a string", [(None,)])
    assert values(aggregates.column_widths(nulls)) == [("a", 4)]
    assert values(aggregates.column_widths(frame("abc string", []))) == [("abc", 3)]


def test_blank_row(frame, values):
    schema = "a string, `b(c)` int"
    assert values(projection.or_blank_row(frame(schema, []))) == [("", "")]
    assert values(projection.or_blank_row(frame(schema, [("x", 1)]))) == [("x", "1")]


def test_unions(frame, values):
    a = frame("x int, y int", [(1, 2), (1, 2)])
    assert values(sets.union_distinct(a, frame("y int, x int", [(1, 2), (3, 4)]))) == [(1, 2), (3, 4)]
    assert values(sets.union_shards(a, frame("y int, x int", [(2, 1), (4, 3)]))) == [(1, 2), (3, 4)]


def test_order_puts_nulls_first(frame):
    rows = ordering.order_by(frame("a string, b int", [("x", 1), (None, 2), ("a", 3)]), "a")
    assert [r["b"] for r in rows.collect()] == [2, 3, 1]
    assert [r["b"] for r in ordering.first_rows(rows, 2, ["b"]).collect()] == [1, 2]


def test_where_agg(frame, values):
    rows = frame("k string, n int", [("a", 1), ("a", 5), ("b", 2)])
    got = aggregates.where_agg(rows, ["k"], {"top": F.max("n")}, c("top") > 2)
    assert values(got) == [("a", 5)]


def test_rows_that_cannot_be_listed_are_not_moved(spark):
    """NOT IN a list too large to broadcast: only likely rows enter the exchange by the key."""
    from tests.plan_metrics import rows_moved
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # The map of the keys is broadcast by hand, the list itself may not be.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(0, 200_000, 1, 8).select(F.col("id").alias("key"))
        listed = spark.range(0, 200_000, 40, 4).select(F.col("id").alias("key"))
        kept = joins.not_in(left, listed, "key")
        moved = rows_moved(spark, lambda: kept.write.format("noop").mode("overwrite").save(),
                           "hashpartitioning(key")
        assert kept.count() == 195_000
        # The list itself once, its rows and about one in sixteen of the others.
        assert 10_000 <= moved < 10_000 + 200_000 / 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_map_of_keys_never_misses(spark, frame, values):
    from scanyard.operators.keymap import with_may_be_listed
    listed = spark.range(0, 50_000).select(F.concat(F.lit("k"), F.col("id")).alias("name"))
    left = spark.range(0, 100_000).select(F.concat(F.lit("k"), F.col("id")).alias("_chunk"), "id")
    marked = with_may_be_listed(left, F.col("_chunk"), listed, "near")
    assert marked.columns == ["_chunk", "id", "near"]
    found = marked.groupBy((F.col("id") < 50_000).alias("in"), "near").count().collect()
    counts = {(r["in"], r["near"]): r["count"] for r in found}
    assert counts[True, True] == 50_000 and (True, False) not in counts
    assert counts[False, True] < 50_000 / 10
    keys = frame("k string", [("a",), (None,)])
    for rows, expected in (([], [False, False]), ([("a",), (None,)], [True, False])):
        got = with_may_be_listed(keys, F.col("k"), frame("k string", rows), "near")
        assert [r["near"] for r in got.orderBy(F.desc("k")).collect()] == expected


def test_left_join_children_knows_the_parents_it_is_told(frame, values):
    """A parent without children whose key is not among ``every`` is lost; all others stay."""
    parents = frame("k string, n int", [("a", 1), ("b", 2), ("told", 3), (None, 4)])
    children = frame("k string, x int", [("a", 7), ("gone", 8)])
    every = frame("k string", [("a",), ("told",), (None,)])
    got = joins.left_join_children(parents, children, "k", every)
    assert values(got, "k", "n", "x") == sorted(
        [("a", 1, 7), ("told", 3, None), (None, 4, None)], key=repr)
    every = frame("k string", [("a",), ("b",), ("told",), (None,)])
    assert joins.left_join_children(parents, children, "k", every).count() == 4
