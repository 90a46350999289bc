"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Turn on run-time re-planning, with hot join keys split even at an extra shuffle.

    What the session has set itself stays.
    """
    # Above one advisory partition and five times the median counts as too large.
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    for key, value in (
            ("spark.sql.adaptive.enabled", "true"),
            ("spark.sql.adaptive.coalescePartitions.enabled", "true"),
            ("spark.sql.adaptive.skewJoin.enabled", "true"),
            ("spark.sql.adaptive.forceOptimizeSkewedJoin", "true"),
            ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", size),
            # What a Python worker is handed at once, however long the rows are.
            ("spark.sql.execution.arrow.maxBytesPerBatch", "8MB")):
        if not _is_set(spark, key):
            spark.conf.set(key, value)
    return spark


def _is_set(spark: SparkSession, key: str) -> bool:
    return spark._jsparkSession.sessionState().conf().contains(key)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside remove their shuffle files at once, not when the driver next collects
    its garbage. For frames that are not computed again.

    What the session has set itself stays.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    if _is_set(spark, key):
        yield
        return
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key)


def shared_dir(spark: SparkSession) -> str:
    """A new folder path under the cluster's shared folder.

    The folder is the one the session names in ``spark.checkpoint.dir``; without it, one under the
    warehouse, which every session has.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/scanyard/{uuid.uuid4().hex}"
