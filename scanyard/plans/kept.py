"""Upload records kept from run to run as partial aggregates, one partition per image month.

The reports ask of all documents ever imaged only when each folder, or image, was uploaded last and
whether it waits. Those answers are kept per day, folder and image month (``folder_uploads``) and
per image (``image_uploads``). A run aggregates the months that may have changed and leaves the
others as they lie; on read, partials of different days merge to the records a run from scratch
would give, as maxima do.

A month may have changed if documents were imaged in it, or uploaded from it, since the last run:
a late upload changes the month its document was imaged in. Stored documents lie by upload and image
month, so both the search for such months and their aggregation read those folders only.

Partitions are replaced as a whole, so a run that died is repeated without harm. The mark of how
far the partials go is written last.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanyard.functions.dates import moment, month_start, since
from scanyard.plans.config import Line
from scanyard.sources.roles import Roles
from scanyard.sources.schemas import image_month

# Kept table by the columns that make a record.
GRAINS = {"folder_uploads": ["RMN", "PBatch", "dcsid"],
          "image_uploads": ["RMN", "PBatch", "dcsid", "ImageID"]}
_MARK = "kept_until"


def _month_of(documents: DataFrame) -> Column:
    """The stored month where there is one, so that it prunes folders."""
    return F.col("image_month") if "image_month" in documents.columns else image_month()


def partials(documents: DataFrame, grain: str) -> DataFrame:
    """Per day and record: last upload, whether any document waits, number of documents.

    ``OnMidnight`` keeps apart what a bound at that midnight leaves out.
    """
    at = F.col("ImageDateTime")
    day = F.to_date(at)
    return documents.groupBy(
        _month_of(documents).alias("image_month"), day.alias("ImageDay"),
        (at == day.cast("timestamp_ntz")).alias("OnMidnight"), *GRAINS[grain]).agg(
        F.max("ftpstime").alias("UploadTime"),
        F.max(F.col("ftpstime").isNull()).alias("Waits"),
        F.count("*").alias("Documents"))


def to_folders(images: DataFrame) -> DataFrame:
    """The partials of folders out of those of their images, as ``partials`` makes them."""
    return images.groupBy("image_month", "ImageDay", "OnMidnight", *GRAINS["folder_uploads"]).agg(
        F.max("UploadTime").alias("UploadTime"), F.max("Waits").alias("Waits"),
        F.sum("Documents").alias("Documents"))


def imaged_since(start: datetime, inclusive: bool = True) -> Column:
    """Partials of documents imaged since a midnight; no other bound can be told from days."""
    if moment(start) != moment(moment(start).date()):
        raise ValueError("kept upload records know days, not times of day")
    day, first = F.col("ImageDay"), F.lit(moment(start).date())
    inside = (day >= first) & (F.col("image_month") >= F.lit(month_start(start).date()))
    return inside if inclusive else inside & ((day > first) | ~F.col("OnMidnight"))


def _in_months(month: Column, months: Iterable[date]) -> Column:
    return month.isin([F.lit(m) for m in months])


def changed_months(documents: DataFrame, after: datetime) -> list[date]:
    """Image months that may have changed since ``after``: at most one row each."""
    uploaded, imaged = since(F.col("ftpstime"), after), _month_of(documents) >= F.lit(
        month_start(after).date())
    if "upload_month" in documents.columns:
        uploaded = uploaded & (F.col("upload_month") >= F.lit(month_start(after).date()))
    months = documents.where(uploaded).select(_month_of(documents).alias("m")).unionByName(
        documents.where(imaged).select(_month_of(documents).alias("m"))).distinct()
    return sorted(r["m"] for r in months.collect())


def _write(documents: DataFrame, base: str, months: list[date] | None) -> None:
    """Replace the partitions of the months, or all of them.

    Documents are read for the images; folders come from what was written of those.
    """
    rows, mode = documents, "static"
    if months is not None:
        rows, mode = documents.where(_in_months(_month_of(documents), months)), "dynamic"
    found = partials(rows, "image_uploads")
    written = documents.sparkSession.read.schema(found.schema)
    for grain in ("image_uploads", "folder_uploads"):
        if grain == "folder_uploads":
            images = written.parquet(f"{base}/image_uploads").where("Documents > 0")
            if months is not None:
                images = images.where(_in_months(F.col("image_month"), months))
            found = to_folders(images)
        if months:
            # A month without documents any more is replaced too, by a row that counts none.
            blank = documents.sparkSession.createDataFrame([(m,) for m in months], "m date")
            found = found.unionByName(blank.select(F.col("m").alias("image_month"), F.lit(
                0).cast("bigint").alias("Documents")), allowMissingColumns=True)
        found.hint("rebalance", "image_month").write.mode("overwrite").option(
            "partitionOverwriteMode", mode).partitionBy("image_month").parquet(f"{base}/{grain}")


def kept_until(documents: DataFrame, base: str) -> datetime | None:
    """How far the partials under ``base`` go, or None without any."""
    spark = documents.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{_MARK}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema("at timestamp_ntz").parquet(f"{base}/{_MARK}").agg(F.max("at")).first()[0]


def refresh(documents: DataFrame, base: str, as_of: datetime) -> list[date] | None:
    """Bring the partials under ``base`` up to the documents; the months rewritten, or None if
    all were."""
    last = kept_until(documents, base)
    months = None if last is None else changed_months(documents, last)
    if months != []:
        _write(documents, base, months)
    mark = documents.sparkSession.createDataFrame([(moment(as_of),)], "at timestamp_ntz")
    mark.coalesce(1).write.mode("append").parquet(f"{base}/{_MARK}")
    return months


def with_kept(tables: Mapping[str, DataFrame], base: str,
              live: Iterable[date] = ()) -> Mapping[str, DataFrame]:
    """The role tables and the kept ones; ``live`` months come from the documents themselves.

    Reports on these tables read upload records from the partials, and of ``document`` no more
    than the live months.
    """
    live = list(live)

    def read(grain: str) -> DataFrame:
        documents = tables["document"]
        schema = partials(documents, grain).schema
        rows = documents.sparkSession.read.schema(schema).parquet(f"{base}/{grain}").where(
            F.col("Documents") > 0)
        if not live:
            return rows
        fresh = partials(documents.where(_in_months(_month_of(documents), live)), grain)
        return rows.where(~_in_months(F.col("image_month"), live)).unionByName(fresh)

    plain = {role: (lambda role=role: tables[role]) for role in tables}
    return Roles(plain | {grain: (lambda grain=grain: read(grain)) for grain in GRAINS})


def kept_records(tables: Mapping[str, DataFrame], line: Line, grain: str) -> DataFrame | None:
    """Partials of the line's time under ``grain``, if the tables have them."""
    if grain not in tables:
        return None
    rows = tables[grain]
    if line.imaged_since:
        rows = rows.where(imaged_since(line.imaged_since, line.imaged_since_inclusive))
    return rows
