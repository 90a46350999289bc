"""Role tables bucketed by batch, with large batches cut into slices.

Tables whose rows lie in buckets of the batch are grouped and joined by batch without moving. A
batch with very many rows would fill one bucket, so it is cut into slices by folder: the bucket of
a row follows from batch and slice, all other batches are slice 0, and a short list says how many
slices each large batch has. What is grouped by batch and folder stays within a slice. What is
joined by batch brings one copy of its row per slice (``joins.left_join_sliced``).

The files name their bucket, so a table can be registered in any session by ``load_bucketed``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanyard.sources.roles import Roles, normalise
from scanyard.sources.schemas import ROLE_SCHEMAS

BUCKETED = ("document", "folder_map")
SLICE = "slice"
# Rows of one slice of a large batch, about.
SLICE_ROWS = 1_000_000
# Longest list of large batches that is broadcast: some 20 MB.
MOST_BROADCAST = 200_000


def slice_of(slices: Column, folder: Column) -> Column:
    """The slice of a row of a batch with so many slices, or NULL for one."""
    return F.coalesce(F.pmod(F.xxhash64(folder), slices), F.lit(0)).cast("int")


def large_batches(df: DataFrame, rows: int = SLICE_ROWS) -> DataFrame:
    """(PBatch, slices) of the batches of more than ``rows`` rows: few, whatever the table."""
    counted = df.groupBy("PBatch").agg(F.count("*").alias("n")).where(
        (F.col("n") > rows) & F.col("PBatch").isNotNull())
    return counted.select("PBatch", F.ceil(F.col("n") / rows).cast("int").alias("slices"))


def with_slices(df: DataFrame, slices: DataFrame) -> DataFrame:
    """Rows with the slices of their batch, NULL for one; ``slices`` is read from storage.

    A short list goes to the rows, which then move to their bucket only. A longer one has one row
    per batch, so a task keeps its share of it in memory, and rows need no order for the join.
    """
    short = slices.count() <= MOST_BROADCAST
    return df.join(slices.hint("broadcast" if short else "shuffle_hash"), "PBatch", "left")


def store_bucketed(roles: Mapping[str, DataFrame], base: str, buckets: int,
                   rows: int = SLICE_ROWS) -> None:
    """Write the bucketed tables and their lists of large batches under ``base``."""
    for role in BUCKETED:
        clean = normalise(roles[role])
        path = f"{base}/{role}_slices"
        large_batches(clean, rows).write.mode("overwrite").parquet(path)
        slices = clean.sparkSession.read.schema("PBatch string, slices int").parquet(path)
        sliced = with_slices(clean, slices).withColumn(
            SLICE, slice_of(F.col("slices"), F.col("dcsid"))).select(*clean.columns, SLICE)
        # Rows of a bucket come together first, so a bucket is one file.
        name = f"stored_{uuid.uuid4().hex}"
        sliced.repartition(buckets, "PBatch", SLICE).write.mode("overwrite").format(
            "parquet").option("path", f"{base}/{role}").bucketBy(
            buckets, "PBatch", SLICE).sortBy("PBatch").saveAsTable(name)
        # The table is outside the warehouse: dropping its name leaves the files.
        clean.sparkSession.sql(f"drop table {name}")


def load_bucketed(spark: SparkSession, base: str, buckets: int,
                  others: Mapping[str, DataFrame]) -> Roles:
    """``others`` with the bucketed tables in place of theirs, and their slice lists.

    ``buckets`` is the number they were stored with.
    """
    def read(role: str) -> DataFrame:
        name = f"{role}_{uuid.uuid4().hex}"
        spark.sql(f"create table {name} ({ROLE_SCHEMAS[role]}, {SLICE} int) using parquet "
                  f"clustered by (PBatch, {SLICE}) sorted by (PBatch) into {buckets} buckets "
                  f"location '{base}/{role}'")
        return spark.table(name)

    def slices(role: str) -> DataFrame:
        return spark.read.schema("PBatch string, slices int").parquet(f"{base}/{role}_slices")

    builders = {role: (lambda role=role: others[role]) for role in others}
    for role in BUCKETED:
        builders[role] = lambda role=role: read(role)
        builders[f"{role}_slices"] = lambda role=role: slices(role)
    return Roles(builders)
