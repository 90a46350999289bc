"""CSV, report and text files."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scanyard.functions.text import replace_char
from scanyard.operators.projection import blank_row

# Stamp formats in use for run-stamped names.
STAMP_MINUTE = "%m%d%Y_%H%M"
STAMP_DAY = "%Y%m%d"
STAMP_SECOND = "%Y%m%d%H%M%S"


def run_path(base: str, as_of: datetime, stamp: str = STAMP_MINUTE) -> str:
    return f"{base}_{as_of.strftime(stamp)}"


# Blanks are data, and a quote inside a value is doubled.
_PLAIN = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> str:
    """CSV with a header line per part file; ``compression`` as the writer names it (gzip)."""
    writer = df.write.mode("overwrite").option("header", True).options(**_PLAIN)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)
    return path


def write_counted(df: DataFrame, path: str, compression: str | None = None,
                  or_blank: bool = False) -> int:
    """``write_csv``, and the number of rows it wrote, counted on the way.

    With ``or_blank``, a frame without rows gives one row of blanks under its header, written when
    the count is known: the frame itself is computed once.
    """
    seen = Observation()
    write_csv(df.observe(seen, F.count(F.lit(1)).alias("n")), path, compression)
    rows = seen.get["n"]
    if or_blank and not rows:
        write_csv(blank_row(df).coalesce(1), path, compression)
        return 1
    return rows


def read_csv(spark: SparkSession, path: str, schema: str | None = None,
             multi_line: bool = False) -> DataFrame:
    """CSV with a header line. ``multi_line`` allows line breaks inside values, but then a file
    cannot be split."""
    reader = spark.read.option("header", True).option("multiLine", multi_line).options(**_PLAIN)
    if schema:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_checked(spark: SparkSession, path: str, schema: str, line: str = "line",
                 header: bool = True) -> tuple[DataFrame, DataFrame]:
    """CSV rows that parse under the schema, and a quarantine of those that don't.

    A row is damaged if a value is not of its column's type or it has too few or too many values.
    The quarantine has the whole text of such a row in ``line`` and its file in ``file``, beside
    what could be read of it.
    """
    columns = spark.createDataFrame([], schema).columns
    if clash := {line, "file"} & set(columns):
        raise ValueError(f"columns {sorted(clash)} are there already")
    rows = (spark.read.option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", line).options(**_PLAIN)
            .schema(f"{schema}, `{line}` string").csv(path))
    # Spark parses only columns that are asked for, and would miss damage in the others. This is
    # true of every row and asks for all.
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in columns]) >= F.lit(-(1 << 63))
    good = rows.where(F.col(line).isNull() & whole).drop(line)
    return good, rows.where(F.col(line).isNotNull() & whole).select(
        "*", F.col("_metadata.file_path").alias("file"))


def write_report(sheets: Mapping[str, DataFrame], path: str,
                 compression: str | None = None) -> dict[str, str]:
    """One CSV directory per sheet under ``path``."""
    return {name: write_csv(df, f"{path}/{name}", compression) for name, df in sheets.items()}


def redelimit(spark: SparkSession, src: str, dst: str, old: str = "\t", new: str = "|") -> None:
    """Rewrite the delimiter of text lines; quotes mean nothing."""
    lines = spark.read.text(src)
    lines.select(replace_char(F.col("value"), old, new).alias("value")).write.mode(
        "overwrite").text(dst)
