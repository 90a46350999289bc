"""Report sets published as a whole.

A run writes its sheets, several at a time, into a folder of its own. One line per sheet in the
manifest then makes them the set that readers see; lines of a run appear together or not at all. A
run that ends before leaves the former set as it was, and its folder is never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanyard.sources import files

_MANIFEST = "number bigint, run string, sheet string, path string, `rows` bigint"
# Sheets written at the same time.
AT_ONCE = 4


def _manifest(spark: SparkSession, base: str) -> DataFrame:
    folder = f"{base}/manifest"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).json(folder)


def publish(sheets: Mapping[str, DataFrame], base: str, compression: str | None = None,
            or_blank: bool = False, named: Callable[[str], str] = str) -> str:
    """Write the sheets under ``base`` and make them the current set; the name of the run.

    ``named`` makes a folder name of a sheet's, such as a run-stamped one. With ``or_blank`` a
    sheet without rows has one row of blanks.
    """
    spark, run = next(iter(sheets.values())).sparkSession, uuid.uuid4().hex
    paths = {sheet: f"{base}/runs/{run}/{named(sheet)}" for sheet in sheets}

    def write(sheet: str) -> int:
        return files.write_counted(sheets[sheet], paths[sheet], compression, or_blank)

    with ThreadPoolExecutor(AT_ONCE) as pool:
        # All are waited for; the first error is raised, before anything is published.
        counted = [pool.submit(inheritable_thread_target(spark)(write), sheet) for sheet in sheets]
    rows = [one.result() for one in counted]
    number = (_manifest(spark, base).agg(F.max("number")).first()[0] or 0) + 1
    lines = [(number, run, sheet, paths[sheet], n) for sheet, n in zip(sheets, rows)]
    # One task, so one file: it appears when the job is committed.
    spark.createDataFrame(lines, _MANIFEST).coalesce(1).write.mode("append").json(
        f"{base}/manifest")
    return run


def published(spark: SparkSession, base: str, run: str | None = None) -> dict[str, tuple[str, int]]:
    """(path, rows) of each sheet of the current set, or of an earlier run's; empty before any."""
    known = _manifest(spark, base)
    chosen = known.where(F.col("run") == run) if run else known.where(
        F.struct("number", "run") == known.agg(F.max(F.struct("number", "run"))).scalar())
    return {r["sheet"]: (r["path"], r["rows"]) for r in chosen.orderBy("sheet").collect()}


def read_sheets(spark: SparkSession, base: str, run: str | None = None) -> dict[str, DataFrame]:
    """The sheets of a published set."""
    return {sheet: files.read_csv(spark, path)
            for sheet, (path, _) in published(spark, base, run).items()}
