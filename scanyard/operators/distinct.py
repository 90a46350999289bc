"""Exact distinct counts that merge: bitmaps over dense numbers of the values.

Values get numbers once, in a stored table of their own, range by range of their order, without
gaps; later values get the numbers that follow. A group's values are then bits, in bitmaps of 32768
that are kept only where they have a bit. Bitmaps of parts, of days or months say, merge by OR, and
the count of the merged ones is the exact number of different values, whatever the parts share.

A bitmap takes 4 KB of memory however few bits it has, and compresses to little more than its bits
where it is stored or shuffled. This suits counts of very many values in groups that are not
very many. For many small groups plain distinct counts stay the better way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scanyard.session import shared_dir


class Numbers:
    """Stored numbers 1, 2, ... of the distinct values of one column."""

    def __init__(self, spark: SparkSession, path: str, kind: str):
        self.spark, self.path, self.schema = spark, path, f"value {kind}, number bigint"

    def _exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def table(self) -> DataFrame:
        if not self._exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def extend(self, values: DataFrame) -> DataFrame:
        """Number the values (one column) that have no number yet; the whole table.

        New values are sorted in ranges, and a range begins where the one before it ends: only the
        size of each range is known to all. NULL gets no number.
        """
        new, top = values.toDF("value").where("value is not null").distinct(), 0
        if self._exists():
            known = self.table()
            new = new.join(known.select("value"), "value", "left_anti")
            top = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
        # Written first, so that ranges and places stay as they are.
        ranges = f"{shared_dir(self.spark)}/ranges"
        new.repartitionByRange("value").sortWithinPartitions("value").select(
            "value", F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("place")).write.parquet(ranges)
        written = self.spark.read.parquet(ranges)
        # One row per range.
        before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = written.groupBy("part").agg(
            F.count("*").alias("n"), F.min("place").alias("first")).select(
            "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
        numbered = written.join(F.broadcast(starts), "part").select("value", (
            F.col("place") - F.col("first") + F.col("start") + 1 + top).alias("number"))
        numbered.write.mode("append").parquet(self.path)
        return self.table()


def bitmaps(df: DataFrame, keys: Sequence[str], numbers: Mapping[str, DataFrame]) -> DataFrame:
    """(keys, counted, bucket, bits): the different values of each column of ``numbers``.

    Each column is joined with its numbers by itself, and what is known of a group and a value is
    one row from there on. Those rows move to their bitmap, so each bitmap is made once, of at most
    32768 rows, whatever the number of tasks.
    """
    each = []
    for name, table in numbers.items():
        own = table.toDF(name, "_number")
        # Rows of a value lie together after the join, so they become one without moving. NULL
        # values have no number, but their group is there.
        found = df.select(*keys, name).join(own, name, "left").select(
            *keys, name, "_number").distinct()
        each.append(found.select(*keys, F.lit(name).alias("counted"), F.bitmap_bucket_number(
            "_number").alias("bucket"), F.bitmap_bit_position("_number").alias("_bit")))
    rows = reduce(DataFrame.unionByName, each).repartition(*keys, "counted", "bucket")
    return rows.groupBy(*keys, "counted", "bucket").agg(
        F.bitmap_construct_agg("_bit").alias("bits"))


def merged(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The bitmaps of all parts together."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy(*keys, "counted", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counts(maps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per group: how many different values each column has, NULLs left out."""
    found = maps.groupBy(*keys, "counted").agg(F.sum(
        F.when(F.col("bucket").isNull(), 0).otherwise(F.bitmap_count("bits"))).alias("n"))
    return found.groupBy(*keys).agg(*[F.coalesce(F.sum(F.when(
        F.col("counted") == name, F.col("n"))), F.lit(0)).alias(name) for name in names])
