"""Joins.

Lookup sides are cut to one row per key before they are joined, so a key that fills a large
part of its table arrives as one row, and the joined side keeps its rows. A key that fills a
large part of the other side is split by Spark at run time. Spark does so only where both
inputs come straight from a shuffle, so the two helpers below see to that.

No side is forced into a broadcast here: Spark chooses it from the measured size. The one
exception is the calendar in ``nonworking_days``, which holds at most one row per day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanyard.functions.dates import day_start, last_day_before
from scanyard.functions.predicates import is_nonworking
from scanyard.operators.keymap import free_name, with_may_be_listed


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def one_per_key(df: DataFrame, on: str | Sequence[str], *aggregates: Column) -> DataFrame:
    """One row per key, with aggregates if given, ready to be joined on the key.

    Grouping by the key and its hash forms the same groups, but a following join cannot reuse
    that shuffle and adds its own, which is the one Spark can split.
    """
    keys = _keys(on)
    spread = [*keys, F.xxhash64(*keys).alias("_spread")]
    groups = df.groupBy(*spread).agg(*aggregates) if aggregates else df.select(*spread).distinct()
    return groups.drop("_spread")


def fresh_join(left: DataFrame, right: DataFrame, on: str | Sequence[str],
               how: str) -> DataFrame:
    """Join that shuffles both sides anew, whatever their order was before.

    For sides already lying together by the key, where one key may still be very large.
    """
    keys = _keys(on)
    spread = F.xxhash64(*keys)
    return left.withColumn("_spread", spread).join(
        right.withColumn("_spread", spread), [*keys, "_spread"], how).drop("_spread")


def left_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, _keys(on), "left")


def inner_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, _keys(on), "inner")


def left_join_children(parents: DataFrame, children: DataFrame, on: str,
                       every: DataFrame) -> DataFrame:
    """Left join for a right side with very many rows under one key.

    A left outer join cannot split the right side of a hot key; an inner join can be split on
    either side. So every key without children gets one child of NULLs first. ``every`` names
    the keys parents may have, in one column, straight from a narrow table, so that the parents
    themselves are planned once.
    """
    names = one_per_key(every.toDF(on), on)
    alone = names.join(one_per_key(children.select(on), on), on, "left_anti")
    known = children.unionByName(alone, allowMissingColumns=True).withColumnRenamed(on, "_child")
    # NULL keys have no children either, and their parents stay.
    spread = (F.xxhash64(on).alias("_spread"), F.xxhash64("_child").alias("_spread_child"))
    left, right = parents.select("*", spread[0]), known.select("*", spread[1])
    same = F.col(on).eqNullSafe(F.col("_child")) & (F.col("_spread") == F.col("_spread_child"))
    return left.join(right, same).drop("_child", "_spread", "_spread_child")


def left_join_sliced(parents: DataFrame, children: DataFrame, on: str, slices: DataFrame,
                     part: str = "slice") -> DataFrame:
    """Left join with children that lie by ``on`` and ``part``, without moving them.

    ``slices`` (``on``, slices) lists the keys whose children are cut into several parts; each of
    them has children. Parents bring one row per part, so a hot key is joined in as many tasks.
    """
    counted = parents.join(slices.toDF(on, "_parts"), on, "left")
    spread = counted.withColumn(part, F.explode(F.sequence(
        F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)))
    joined = spread.join(children.withColumn("_child", F.lit(True)), [on, part], "left")
    # A part that holds no children of a hot key says nothing.
    return joined.where(F.col("_child") | F.col("_parts").isNull()).drop(
        "_child", "_parts", part)


def where_exists(left: DataFrame, right: DataFrame, on: str | Sequence[str],
                 condition: Column | None = None) -> DataFrame:
    """Left rows with at least one partner; each left row stays once."""
    keys = _keys(on)
    rows = right if condition is None else right.where(condition)
    return left.join(one_per_key(rows, keys), keys, "left_semi")


def flag_exists(left: DataFrame, right: DataFrame, on: str | Sequence[str], name: str,
                condition: Column | None = None) -> DataFrame:
    """Existence of a partner as a boolean column; each left row stays once."""
    keys = _keys(on)
    rows = right if condition is None else right.where(condition)
    known = one_per_key(rows, keys).withColumn(name, F.lit(True))
    return left.join(known, keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def flag_any(fact: DataFrame, key: str, condition: Column, name: str) -> DataFrame:
    """One row per key: whether any row of the key meets the condition."""
    return one_per_key(fact, key, F.max(F.coalesce(condition, F.lit(False))).alias(name))


def near_listed(df: DataFrame, col: str, listed: DataFrame) -> DataFrame:
    """Rows whose ``col`` may be in the one column of ``listed``; rows that surely aren't are left out.

    For rows that meet the list itself later: those left out never move. NULLs are never in it.
    """
    flag = free_name(df, "_near")
    marked = with_may_be_listed(df, F.col(col), listed, flag)
    return marked.where(F.col(flag)).select(*df.columns)


def split_anti_join(left: DataFrame, listed: DataFrame, col: str) -> DataFrame:
    """Left rows whose ``col`` is not in the one column of ``listed``; NULLs are never in it.

    Only rows that a map of the list's keys cannot rule out are joined, so the others don't move
    however long the list is. The left side is read once for either kind.
    """
    flag = free_name(left, "_near")
    marked = with_may_be_listed(left, F.col(col), listed, flag)
    near = marked.where(F.col(flag)).join(listed.toDF(col), col, "left_anti")
    far = marked.where(~F.col(flag))
    return far.select(*left.columns).unionByName(near.select(*left.columns))


def not_in(left: DataFrame, right: DataFrame, col: str, right_col: str | None = None) -> DataFrame:
    """``col NOT IN (right)`` with its NULL rules, without broadcasting the list.

    An empty list keeps every row, a NULL in the list keeps none, and a NULL key is kept only
    by an empty list. Rows that cannot be listed are not shuffled.
    """
    listed = one_per_key(right.select(F.col(right_col or col).alias(col)), col)
    # From the distinct values, in one go: 2 for an empty list, 0 for one with a NULL, else 1.
    let_pass = listed.agg(F.when(F.count("*") == 0, 2).when(
        F.count_if(F.col(col).isNull()) > 0, 0).otherwise(1)).scalar()
    # Before the rows are marked, so that those that cannot pass are not.
    asked = left.where(let_pass + F.col(col).isNotNull().cast("int") >= 2)
    return split_anti_join(asked, listed, col).select(*left.columns)


def outstanding(left: DataFrame, right: DataFrame, on: str | Sequence[str],
                open_when: Column) -> DataFrame:
    """Left rows without any partner, or with a partner still open.

    The same rows as a left join that keeps NULL payloads, but the right side is first reduced
    to one row per key, so a left row stays once however many open partners it has.
    """
    keys = _keys(on)
    state = one_per_key(right, keys, F.max(F.coalesce(open_when, F.lit(False))).alias("_open"))
    joined = left.join(state, keys, "left")
    return joined.where(F.coalesce("_open", F.lit(True))).select(*left.columns)


def rejoin(left: DataFrame, right: DataFrame, child: str) -> DataFrame:
    """Replace the child key by the one found on the right; NULL when it is not there."""
    known = one_per_key(
        right.select(F.col(child).alias("_found")).where("_found is not null"), "_found")
    joined = left.join(known, F.col(child) == F.col("_found"), "left")
    return joined.withColumn(child, F.col("_found")).select(*left.columns)


def nonworking_rows(calendar: DataFrame) -> DataFrame:
    """Weekend days and named days."""
    return calendar.where(is_nonworking(F.col("DayOfWeekName"), F.col("CalendarDateDescription")))


def nonworking_days(df: DataFrame, calendar: DataFrame, start: str, as_of: datetime,
                    name: str = "nonworking", since: datetime | None = None) -> DataFrame:
    """Add the number of non-working calendar rows from ``start`` up to ``as_of``.

    ``since`` says that no row starts before that day, so earlier days need not be counted.

    A calendar row counts when its midnight lies in the closed range. Instead of comparing
    every row with every day, the calendar becomes a running count per day, read once at
    ``as_of`` and once, by an equality join, at the day before the range.
    """
    today = day_start(as_of).date()
    if since is not None:
        calendar = calendar.where(F.col("calendardate") >= F.lit(day_start(since, -1).date()))
    flagged = (
        nonworking_rows(calendar).where(F.col("calendardate") <= F.lit(today))
        .groupBy(F.to_date("calendardate").alias("_day"))
        .agg(F.count("*").alias("_n"))
    )
    every_day = flagged.agg(F.min("_day").alias("_first")).select(
        F.explode(F.sequence("_first", F.lit(today))).alias("_day")
    )
    # One row per day, so a window without partitions stays small.
    so_far = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = every_day.join(flagged, "_day", "left").select(
        "_day", F.sum(F.coalesce("_n", F.lit(0))).over(so_far).alias("_before")
    )
    total = flagged.agg(F.sum("_n")).scalar()
    counted = (
        F.when(F.col("_from").isNull() | (F.col("_from") >= F.lit(today)), F.lit(0))
        .otherwise(F.coalesce(total, F.lit(0)) - F.coalesce("_before", F.lit(0)))
    )
    return (
        df.withColumn("_from", last_day_before(F.col(start)))
        .join(F.broadcast(running), F.col("_from") == F.col("_day"), "left")
        .withColumn(name, counted.cast("bigint"))
        .select(*df.columns, name)
    )
