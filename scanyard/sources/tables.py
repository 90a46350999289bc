"""Table scans, lookups, staging and materialising."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanyard.sources.schemas import STAR_SCHEMAS


def scan(spark: SparkSession, base: str, table: str, schema: str | None = None) -> DataFrame:
    """Parquet table ``base/table.parquet`` under its declared schema."""
    return spark.read.schema(schema or STAR_SCHEMAS[table]).parquet(f"{base}/{table}.parquet")


def jdbc_options(url: str, query_or_table: str, *, split_on: str | None = None,
                 low: int | None = None, high: int | None = None, parts: int = 1,
                 fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options for a table in a database; ``split_on`` reads it in parallel ranges."""
    options = {"url": url, "dbtable": query_or_table, "fetchsize": str(fetch_size)}
    if split_on is not None:
        if low is None or high is None:
            raise ValueError("a split column needs its lowest and highest value")
        options |= {"partitionColumn": split_on, "lowerBound": str(low),
                    "upperBound": str(high), "numPartitions": str(parts)}
    return options


def scan_jdbc(spark: SparkSession, url: str, query_or_table: str, **split) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query_or_table, **split)).load()


def lookup(df: DataFrame, col: str, value: object) -> DataFrame:
    """The rows whose key equals ``value``, as that one column."""
    return df.where(F.col(col) == value).select(col)


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Register the frame under a name, replacing an earlier one; ``keep`` caches it."""
    if keep:
        df = df.persist()
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def unstage(spark: SparkSession, name: str) -> None:
    """Forget a staged name and free what it caches."""
    if spark.catalog.tableExists(name):
        spark.catalog.uncacheTable(name)
    spark.catalog.dropTempView(name)


def own_name(name: str) -> str:
    """A table name of this run, so that runs at the same time keep apart."""
    return f"{name}_{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write the result as a table, replacing an earlier one, and read it from there.

    The caller names the table: a fixed name replaces that of an earlier run, ``own_name`` does not.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
