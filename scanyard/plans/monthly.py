"""Monthly totals by upload day and line of business."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanyard.functions.dates import day_start, month_start, us_date
from scanyard.functions.decode import or_zero
from scanyard.functions.predicates import has_prefix
from scanyard.operators.aggregates import rollup_total
from scanyard.operators.joins import flag_exists
from scanyard.plans.extracts import Tables, uploaded_between

_LINES = ("FCS", "OMPF", "RMC")
MEASURES = [f"{line} {what}" for line in _LINES for what in ("Docs", "Images")]
SECOND_SITE = ["London Docs", "London Images"]


def upload_span(as_of: datetime, whole_previous_month: bool = False) -> tuple[datetime, datetime]:
    """Month to date without today, or the whole month before."""
    if whole_previous_month:
        return month_start(as_of, -1), month_start(as_of)
    return month_start(as_of), day_start(as_of)


def lob_counts(tables: Tables, low: datetime, high: datetime, dedupe: bool = True) -> DataFrame:
    """Documents and pages per upload day and line of business.

    Counts are taken per day, batch and box, so an image in two batches counts twice. The box
    is not part of the compared columns: with ``dedupe`` (the reports' way) two boxes of one
    batch with equal counts become one; without it every box counts.
    """
    documents = uploaded_between(tables["document"], low, high)
    groups = documents.groupBy(F.to_date("ftpstime").alias("Day"), "PBatch", "RMN").agg(
        F.count_distinct("ImageID").alias("Docs"), F.sum("NumPages").alias("Images"))
    flagged = flag_exists(groups, tables["check_in"], "RMN", "_claims",
                          F.col("claimtype") == "OMPF")
    in_02 = has_prefix(F.col("PBatch"), "02")
    line = (F.when(in_02 & F.col("_claims"), "OMPF").when(in_02, "FCS")
            .when(has_prefix(F.col("PBatch"), "01"), "RMC"))
    rows = flagged.select("Day", "PBatch", line.alias("Line"), "Docs", "Images")
    if dedupe:
        rows = rows.distinct()
    sums = [
        or_zero(F.sum(F.when(F.col("Line") == name, F.col(what)))).alias(f"{name} {what}")
        for name in _LINES for what in ("Docs", "Images")
    ]
    return rows.groupBy("Day").agg(*sums)


def _report(days: DataFrame, measures: list[str], always_total: bool) -> DataFrame:
    named = days.select(us_date(F.col("Day")).alias("UploadDate"),
                        *[F.col(f"`{m}`") for m in measures])
    return rollup_total(named, "UploadDate", measures, always=always_total)


def r11_monthly_totals(tables: Tables, line=None, as_of=None, previous_month: bool = False,
                       dedupe: bool = True, always_total: bool = False) -> DataFrame:
    """Docs and images per day and line of business, and a total row."""
    low, high = upload_span(as_of, previous_month)
    return _report(lob_counts(tables, low, high, dedupe), MEASURES, always_total)


def r12_monthly_totals_two_sites(tables: Tables, line=None, as_of=None,
                                 previous_month: bool = False, dedupe: bool = True,
                                 always_total: bool = False) -> DataFrame:
    """The monthly totals beside those of the second site.

    Days meet as dates. A day the second site reports more than once repeats the day's totals
    for each different report, and adds them up for equal ones.
    """
    low, high = upload_span(as_of, previous_month)
    site = tables["second_site"].where(
        (F.col("UploadDate") >= F.lit(low.date())) & (F.col("UploadDate") < F.lit(high.date()))
    ).groupBy(F.col("UploadDate").alias("Day"), "docs", "images").agg(
        F.count("*").alias("_times"))
    times = F.coalesce("_times", F.lit(1))
    days = lob_counts(tables, low, high, dedupe).join(site, "Day", "left").select(
        "Day",
        *[(F.col(f"`{m}`") * times).alias(m) for m in MEASURES],
        or_zero(F.col("docs")).alias("London Docs"),
        or_zero(F.col("images")).alias("London Images"),
    ).distinct()
    return _report(days, MEASURES + SECOND_SITE, always_total)
