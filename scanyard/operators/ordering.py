"""Order and limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def order_by(df: DataFrame, *cols: str) -> DataFrame:
    """Ascending, NULLs first."""
    return df.orderBy(*cols)


def first_rows(df: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """The first n rows in a fixed order; runs as a per-partition top-n."""
    return df.orderBy(*by).limit(n)
