"""Choosing, naming and adding columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace the whole header by position."""
    return df.toDF(*names)


def with_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def key_when(condition: Column, key: Column) -> Column:
    """The key where the condition holds, else NULL; counted, it gives a conditional count."""
    return F.when(condition, key)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def blank_row(df: DataFrame) -> DataFrame:
    """One row of blanks under the frame's header."""
    return df.sparkSession.range(1).select(*[F.lit("").alias(c) for c in df.columns])


def or_blank_row(df: DataFrame, order: Sequence[str] = (),
                 known_by: DataFrame | None = None) -> DataFrame:
    """The frame as text, or one row of blanks under the same header when it has no rows.

    Nothing runs before the result does. The test asks for one row and reuses the shuffles of
    the frame; a sink that counts what it writes (``files.write_counted``) needs no test at all.
    ``order`` sorts the rows by their own values, not by their text. ``known_by`` has rows exactly
    where the frame has, and is asked in its place: less work where it is the frame's beginning.
    """
    by = {f"_by{n}": F.col(f"`{c}`") for n, c in enumerate(order)}
    rows = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns],
                     *[c.alias(n) for n, c in by.items()])
    blank = blank_row(df).where(~(known_by or df).select(F.lit(1)).exists())
    both = rows.unionByName(blank, allowMissingColumns=True)
    return (both.orderBy(*by) if by else both).drop(*by)
