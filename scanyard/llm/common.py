"""Helpers the operators share: tables kept in the shared folder, files on it, batches."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.compute
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanyard.operators.keymap import free_name, with_may_be_listed
from scanyard.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, tag: str) -> DataFrame:
    """Write the frame to the shared folder and read it from there.

    Later plans start from files that outlive any executor, and nothing above is computed twice.
    """
    path = f"{shared_dir(df.sparkSession)}/{tag}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_HELD: dict[object, object] = {}


def remembered(owner: object, make):
    """What this worker process remembers for one operator between tasks.

    Workers serve one operator after another: what others left is dropped, so it never adds up.
    """
    if owner not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[owner] = make()
    return _HELD[owner]


def give_back() -> None:
    """Return what this worker process has freed to the machine, where its library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def rest(spark: SparkSession) -> None:
    """Let the executors collect their garbage once, a small task for each core.

    Heap, classes and buffers that one stage of a long job leaves behind are then not held through
    the next, beside what its Python workers take.
    """
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.expr("java_method('java.lang.System', 'gc')")) \
        .write.format("noop").mode("overwrite").save()


def findable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def body_of(text_col: str) -> Column:
    """The text's UTF-8 bytes, null texts empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")


def pairs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and the text's UTF-8 bytes under fixed names, null texts empty.

    Only these two columns go on, so other columns of the input may bear any name.
    """
    findable(docs.sparkSession)
    return docs.select(F.col(id_col).alias("id"), body_of(text_col).alias("body"))


def lower_az(text):
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batch: pa.RecordBatch, column: str = "body",
           most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose values of one column take about ``most`` bytes, or one row."""
    sizes = pa.compute.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for row, size in enumerate(sizes):
        if total and total + size > most:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += int(size or 0)
    if start < batch.num_rows:
        yield batch.slice(start)


def open_folder(url: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder all machines reach."""
    if url.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlparse(url).path)
    if "://" not in url:
        return fs.LocalFileSystem(), url
    return fs.FileSystem.from_uri(url)


def near_keys(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """Rows whose key is, or by a clash of hashes seems to be, among ``keys`` (one column).

    This spares most other rows the shuffle of the join that must follow. The map of the keys
    that is broadcast grows with them up to a ceiling (``scanyard.operators.keymap``).
    """
    near = free_name(df, "near")
    return with_may_be_listed(df, key, keys, near).where(F.col(near)).drop(near)


def without(docs: DataFrame, id_col: str, key: Column, marks: DataFrame) -> DataFrame:
    """The rows of ``docs`` but those that ``marks`` (id, key, stays) takes out.

    A row is named by its id and ``key``, a hash of its text. Marked rows go, or, where they stay,
    one of those that repeat the name does. Rows whose key is surely not marked don't move. Each
    row travels as one column, so columns may bear any name.
    """
    whole = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), key.alias("key"))
    near = with_may_be_listed(whole, F.col("key"), marks.select("key"), "near")
    known = marks.select(F.col("id").alias("marked"), F.col("key").alias("mark"), "stays")
    asked = near.where("near").join(
        known.hint("merge"), F.col("id").eqNullSafe(F.col("marked"))
        & (F.col("key") == F.col("mark")), "left")
    once, again = asked.where("stays is null"), asked.where("stays").dropDuplicates(["id", "key"])
    return near.where("not near").select("row").unionByName(once.select("row")).unionByName(
        again.select("row")).select("row.*")
