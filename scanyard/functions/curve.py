"""Order of rows along a curve through two columns, so that ranges of either lie close together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Steps a column is cut into, and rows of the sample for each.
BITS, SAMPLE = 6, 64


def edges(df: DataFrame, column: str, bits: int = BITS) -> Column:
    """Values that cut the column into ``2^bits`` parts of about as many rows, as an array.

    They are read from a sample of bounded size inside the plan that uses them, in one pass: the
    rows of the smallest random numbers, of which each task keeps no more than the sample.
    """
    parts = 1 << bits
    value = F.col(f"`{column}`")
    known = df.where(value.isNotNull()).select(value.alias("v"))
    ordered = F.array_sort(F.collect_list("v"))
    size = F.size("ordered")
    places = F.transform(F.sequence(F.lit(1), F.lit(parts - 1)),
                         lambda i: F.get("ordered", F.floor(i * size / parts).cast("int")))
    return known.orderBy(F.rand(seed=11)).limit(2 * parts * SAMPLE).agg(
        ordered.alias("ordered")).select(F.array_compact(places).alias("edges")).scalar()


def step(column: Column, cuts: Column) -> Column:
    """Number of cuts at or below the value; NULL lies before all."""
    return F.coalesce(F.size(F.filter(cuts, lambda cut: cut <= column)), F.lit(0))


def interleave(first: Column, second: Column, bits: int = BITS) -> Column:
    """Morton key: the bits of two numbers in turn, those of ``first`` the higher ones."""
    def spread(number: Column, shift: int) -> list[Column]:
        return [F.shiftleft(F.shiftright(number, i).bitwiseAND(F.lit(1)), 2 * i + shift)
                for i in range(bits)]
    return reduce(Column.bitwiseOR, spread(first, 1) + spread(second, 0))


def along_curve(df: DataFrame, first: str, second: str, bits: int = BITS) -> DataFrame:
    """The rows in files of ranges of the curve through two columns, in its order within each."""
    cut = df.withColumns({"_first": edges(df, first, bits), "_second": edges(df, second, bits)})
    key = interleave(step(F.col(f"`{first}`"), F.col("_first")),
                     step(F.col(f"`{second}`"), F.col("_second")), bits)
    keyed = cut.withColumn("_curve", key).drop("_first", "_second")
    order = ["_curve", f"`{first}`", f"`{second}`"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_curve")
