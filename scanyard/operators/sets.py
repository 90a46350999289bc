"""Unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_distinct(*frames: DataFrame) -> DataFrame:
    """Rows of all frames without duplicates; columns meet by position, names from the first."""
    return reduce(DataFrame.union, frames).distinct()


def union_shards(*shards: DataFrame) -> DataFrame:
    """Rows of equally named shards without duplicates; columns meet by name."""
    return reduce(DataFrame.unionByName, shards).distinct()
