"""Outstanding work: batches and folders that are not completely uploaded."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanyard import fixed
from scanyard.functions.dates import elapsed_days, iso_date, ts, whole_days
from scanyard.functions.decode import (batch_status, either, media_counts, media_flag, or_dash,
                                       or_zero, outstanding_status, pending_text, stage_name)
from scanyard.operators.aggregates import mean_pivot
from scanyard.operators.joins import nonworking_days, one_per_key, outstanding, rejoin
from scanyard.operators.projection import or_blank_row
from scanyard.plans.config import FCS, OMPF, OMPF_DIRECT, VAULT, Line
from scanyard.plans.extracts import (Tables, batch_upload_state, box_batches, folder_counts, known,
                                     recorded_folders, scanned_batches, second_ocr, with_folders,
                                     workflow_rows)

# Reports go by batch; the further columns let the sort spread the rows of one large batch.
_BATCH_ORDER = ["BatchName", "RMN", "TrackingNo"]
_FOLDER_ORDER = ["BatchName", "DCSID", "RMN", "TrackingNo"]
_STATE = ["RMN", "TrackingNo", "BatchName", "Location", "BatchStatus", "TotalImages", "Media"]


def _with_workflow(tables: Tables, line: Line, batches: DataFrame) -> DataFrame:
    """Stage and status from the workflow and the export list.

    The workflow is not cut down to the line's boxes first: the batches already are. Where those
    are at hand, rows of other batches don't move.
    """
    rows = workflow_rows(tables, line).withColumn("_known", F.col("BatchName"))
    status = batch_status(F.col("_exported"), F.col("BatchStatus"), F.col("_known"))
    return (
        batches.join(known(tables, "exported", "kbatch", "_exported", line), "BatchName",
                     "left")
        .join(rows, "BatchName", "left")
        .withColumn("Location", stage_name(F.col("WFStep"), F.col("BatchLocation")))
        .withColumn("BatchStatus", status)
    )


def waiting_batches(tables: Tables, line: Line) -> DataFrame:
    """Received batches without a complete upload, per box, shipment and class."""
    batches = box_batches(tables, line).groupBy(
        "RMN", "TrackingNo", "BatchName", "BatchClassName").agg(F.min("InvTime").alias("InvTime"))
    state = batch_upload_state(tables, line).withColumnRenamed("PBatch", "BatchName")
    return outstanding(batches, state, "BatchName", F.col("Open"))


def open_batches(tables: Tables, line: Line) -> DataFrame:
    """Batches without a complete upload, with stage, status, media and folder counts.

    Everything is brought to one row per batch before it is joined: folders as a count,
    documents as "any record still open". Where a group holds several receipt times the
    earliest is shown.
    """
    waiting = waiting_batches(tables, line)
    folders = folder_counts(tables, line)
    paper, special = media_counts(F.col("BatchClassName"), or_zero(F.col("_folders")))
    return (
        _with_workflow(tables, line, waiting).join(folders, "BatchName", "left")
        .select("RMN", "TrackingNo", "BatchName", "Location", "BatchStatus", "TotalImages",
                media_flag(F.col("BatchClassName")).alias("Media"),
                paper.alias("Paper"), special.alias("Special"), "InvTime")
        .groupBy(*_STATE, "Paper", "Special").agg(F.min("InvTime").alias("InvTime"))
    )


def _without_counts(batches: DataFrame) -> DataFrame:
    """Open batches without their folder counts, which the folder reports don't tell apart."""
    return batches.groupBy(*_STATE).agg(F.min("InvTime").alias("InvTime"))


def _per_folder(tables: Tables, line: Line, batches: DataFrame) -> DataFrame:
    """Rows of batches, one per folder; a batch without folders stays with NULL.

    All lookups by batch come before, so none meets the many folders of a batch.
    """
    return with_folders(tables, batches, "DCSID", line)


def _at_scanner(tables: Tables, df: DataFrame) -> DataFrame:
    known_there = scanned_batches(tables).withColumn("_scanned", F.lit(True))
    return df.join(known_there, "BatchName", "left").withColumn(
        "_scanned", F.coalesce("_scanned", F.lit(False)))


def _age(start: str, as_of: datetime) -> Column:
    """Whole working days; both parts are taken before the fraction is dropped."""
    return whole_days(elapsed_days(F.col(start), ts(as_of)) - F.col("nonworking"))


def _aged(tables: Tables, line: Line, df: DataFrame, as_of: datetime) -> DataFrame:
    status = outstanding_status(F.col("BatchStatus"), F.col("_scanned"), line.not_scanned)
    counted = nonworking_days(df, tables["calendar"], "InvTime", as_of,
                              since=line.received_since)
    return (
        _at_scanner(tables, counted)
        .withColumn("Status", status)
        .withColumn("Age", _age("InvTime", as_of))
        .withColumn("Day", iso_date(F.col("InvTime")))
    )


def r02_outstanding_batches(tables: Tables, line: Line = FCS, as_of=None,
                            batches: DataFrame | None = None) -> DataFrame:
    """Open batches with their age in working days; ``batches`` are the open ones, if at hand."""
    aged = _aged(tables, line, batches or open_batches(tables, line), as_of)
    return aged.select(
        "RMN", "TrackingNo", "BatchName", "Day", "Age", "Location", "Status", "TotalImages",
        "Media", "Paper", "Special",
    ).distinct().toDF(*fixed.AGED_BATCH_HEADER).orderBy(*_BATCH_ORDER)


def r03_outstanding_folders(tables: Tables, line: Line = FCS, as_of=None,
                            batches: DataFrame | None = None) -> DataFrame:
    """Open folders with their age in working days; ``batches`` are the open ones, if at hand."""
    aged = _aged(tables, line, _without_counts(batches or open_batches(tables, line)), as_of)
    return _per_folder(tables, line, aged).select(
        "RMN", "TrackingNo", "BatchName", "Day", "Age", "DCSID", "Location", "Status",
        "TotalImages", "Media",
    ).distinct().toDF(*fixed.AGED_FOLDER_HEADER).orderBy(*_FOLDER_ORDER)


def r04_vault_batches(tables: Tables, line: Line = VAULT, as_of=None) -> DataFrame:
    return r02_outstanding_batches(tables, line, as_of)


def r04_vault_folders(tables: Tables, line: Line = VAULT, as_of=None) -> DataFrame:
    return r03_outstanding_folders(tables, line, as_of)


def _second_job(tables: Tables, line: Line, df: DataFrame) -> DataFrame:
    """Status and images as the second OCR job sees them, where it has the batch."""
    if not line.second_job:
        status = outstanding_status(F.col("BatchStatus"), F.col("_scanned"), line.not_scanned)
        return _at_scanner(tables, df).withColumns({
            "Status": status, "Images": F.col("TotalImages"), "Day": iso_date(F.col("InvTime"))})
    jobs = second_ocr(tables).select(
        "BatchName", F.col("TotalImages").alias("_images"), F.lit(True).alias("_second"))
    joined = _at_scanner(tables, df).join(jobs, "BatchName", "left")
    in_second = F.coalesce(F.col("_second"), F.lit(False))
    return (
        joined
        .withColumn("Status", outstanding_status(
            F.col("BatchStatus"), F.col("_scanned"), line.not_scanned, in_second))
        .withColumn("Images", either(in_second, F.col("_images"), F.col("TotalImages")))
        .withColumn("Day", iso_date(F.col("InvTime")))
    )


def _shown(line: Line, names: tuple[str, ...], header: tuple[str, ...]) -> tuple[list, list]:
    """Columns and header of the line, without the day where it is not shown."""
    both = [(n, h) for n, h in zip(names, header) if line.show_day or n != "Day"]
    return [n for n, _ in both], [h for _, h in both]


def _open_batch_rows(tables: Tables, line: Line, batches: DataFrame | None = None) -> DataFrame:
    columns, header = _shown(line, (
        "RMN", "TrackingNo", "BatchName", "Day", "Location", "Status", "Images", "Media", "Paper",
        "Special"), fixed.OPEN_BATCH_HEADER)
    rows = _second_job(tables, line, batches or open_batches(tables, line))
    if line.show_day:
        rows = rows.withColumn("Location", or_dash(F.col("Location")))
    return rows.select(*columns).distinct().toDF(*header)


def r06_open_batches(tables: Tables, line: Line = OMPF, as_of=None,
                     placeholder: bool = False, batches: DataFrame | None = None) -> DataFrame:
    """Open batches, where the line asks for it aware of the second OCR job.

    With ``placeholder`` the report is text and never empty; ``batches`` are the open ones, if at
    hand.
    """
    rows = _open_batch_rows(tables, line, batches)
    if not placeholder:
        return rows.orderBy(*_BATCH_ORDER)
    return or_blank_row(rows, _BATCH_ORDER, batches or waiting_batches(tables, line))


def r07_open_folders(tables: Tables, line: Line = OMPF, as_of=None,
                     placeholder: bool = False, batches: DataFrame | None = None) -> DataFrame:
    """Open folders; where the line says so, the number is that of the upload records, or NULL."""
    states = _without_counts(batches or open_batches(tables, line))
    folders = _per_folder(tables, line, _second_job(tables, line, states))
    if line.recorded_folder:
        recorded = recorded_folders(tables, line).withColumnRenamed("dcsid", "DCSID")
        folders = rejoin(folders, recorded, "DCSID")
    columns, header = _shown(line, (
        "RMN", "TrackingNo", "BatchName", "Day", "DCSID", "Location", "Status", "Images", "Media"),
        fixed.OPEN_FOLDER_HEADER)
    rows = folders.select(*columns).distinct().toDF(*header)
    if not placeholder:
        return rows.orderBy(*_FOLDER_ORDER)
    # Left joins keep every waiting batch, so there are rows where there are any of those.
    return or_blank_row(rows, _FOLDER_ORDER, batches or waiting_batches(tables, line))


def r08_turnaround_pivot(tables: Tables, line: Line = OMPF, as_of=None) -> DataFrame:
    """The open batches by their six descriptive columns, with means of the numbers."""
    rows = _open_batch_rows(tables, line)
    keys = fixed.OPEN_BATCH_HEADER[:6]
    numbers = ["TotalImages(OpenBox)", "Paper(DCSID Count)", "SpecialMedia(DCSID Count)"]
    return mean_pivot(rows, keys, numbers).orderBy("InvDate", *_BATCH_ORDER)


def r10_direct_outstanding(tables: Tables, line: Line = OMPF_DIRECT, as_of=None) -> DataFrame:
    """Open batches straight from the documents, with the number still to be uploaded."""
    batches = box_batches(tables, line).select("RMN", "TrackingNo", "BatchName").distinct()
    if "image_uploads" in tables:
        images, not_uploaded = tables["image_uploads"], F.col("Waits")
    else:
        images, not_uploaded = tables["document"], F.col("ftpstime").isNull()
    documents = one_per_key(
        images.withColumnRenamed("PBatch", "BatchName"), "BatchName",
        F.count_distinct(F.when(not_uploaded, F.col("ImageID"))).alias("_docs"),
        F.max(not_uploaded).alias("_open"),
    )
    waiting = batches.join(documents, "BatchName", "left").where(
        F.coalesce("_open", F.lit(True))).withColumn("_docs", or_zero(F.col("_docs")))
    text = pending_text(F.col("_docs"), F.lit(0))
    status = (
        F.when(F.col("BatchStatus") == fixed.EXPORTED, text)
        .when((F.col("BatchStatus") == fixed.NOT_IMPORTED) & ~F.col("_scanned"),
              fixed.PENDING_SCANNER)
        .otherwise(F.col("BatchStatus"))
    )
    return (
        _at_scanner(tables, _with_workflow(tables, line, waiting))
        .select("RMN", "TrackingNo", "BatchName",
                F.col("Location").alias("OpenBoxBatchLocation"),
                status.alias("BatchStatus"), "TotalImages")
        .distinct()
        .orderBy("RMN", "TrackingNo", "BatchName")
    )
