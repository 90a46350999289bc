"""Shared extracts the reports are built from."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanyard.functions.dates import between, day_start, month_start, since
from scanyard.functions.predicates import has_prefix, not_test_batch, valid_tracking
from scanyard.operators.joins import (left_join_children, left_join_sliced, near_listed,
                                      nonworking_rows, one_per_key)
from scanyard.operators.sets import union_shards
from scanyard.plans.config import Line
from scanyard.plans.kept import kept_records

Tables = Mapping[str, DataFrame]


def _all(conditions: list[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def box_condition(line: Line) -> Column:
    """Check-in rows of the line; comparisons with NULL drop the row."""
    c, conditions = F.col, []
    if line.claim:
        conditions.append(c("claimtype") == line.claim)
    if line.not_claim:
        conditions.append(c("claimtype") != line.not_claim)
    if line.box_origin:
        conditions.append(F.upper(c("boxOrigin")) == line.box_origin.upper())
    if line.box_source:
        conditions.append(F.upper(c("boxSource")) == line.box_source.upper())
    if line.box_prefix:
        conditions.append(has_prefix(c("RMN"), line.box_prefix))
    if line.inserted_since:
        conditions.append(since(c("insertdate"), line.inserted_since))
    return _all(conditions)


def name_condition(line: Line, name: str = "BatchName") -> Column:
    """Batch names of the line."""
    conditions = []
    if line.batch_prefix:
        conditions.append(has_prefix(F.col(name), line.batch_prefix))
    if line.skip_test_batches:
        conditions.append(not_test_batch(F.col(name)))
    return _all(conditions)


def batch_condition(line: Line) -> Column:
    """Received batches of the line."""
    named = name_condition(line, "PBatch")
    return since(F.col("InvTime"), line.received_since) & named if line.received_since else named


def received_from(df: DataFrame, start: datetime | None) -> DataFrame:
    """Rows received since then; where the day is stored too, it prunes the scan."""
    if start is None:
        return df
    if "received_day" in df.columns:
        df = df.where(F.col("received_day") >= F.lit(day_start(start).date())).drop(
            "received_day")
    return df.where(since(F.col("InvTime"), start))


def box_keys(tables: Tables, line: Line) -> DataFrame:
    """Distinct boxes of the line."""
    return one_per_key(tables["check_in"].where(box_condition(line)), "RMN")


def shipped_boxes(tables: Tables, line: Line) -> DataFrame:
    """Boxes of the line that belong to a real shipment."""
    boxes = tables["check_in"].where(box_condition(line) & valid_tracking(F.col("trackingno")))
    return boxes.select("RMN", F.col("trackingno").alias("TrackingNo"), "claimtype").distinct()


def received(tables: Tables, line: Line) -> DataFrame:
    """Received batches of the line, whatever their box."""
    return received_from(tables["physical_batch"], line.received_since).where(
        name_condition(line, "PBatch")).withColumnRenamed("PBatch", "BatchName")


def box_batches(tables: Tables, line: Line) -> DataFrame:
    """Received batches of the shipped boxes."""
    if "line_batches" in tables:
        return tables["line_batches"]
    return shipped_boxes(tables, line).join(received(tables, line), "RMN")


def near_batches(tables: Tables, line: Line, df: DataFrame, name: str = "BatchName") -> DataFrame:
    """Rows that may be of received batches of the shipped boxes; few others are among them.

    For rows that are joined with such batches later, so that the rest is not moved.
    """
    return near_listed(df, name, box_batches(tables, line).select("BatchName"))


def claimed_batches(tables: Tables, line: Line) -> DataFrame:
    """(RMN, TrackingNo, ClaimType, BatchName) of the received batches, the smallest type of a
    shipment."""
    box, claim = ["RMN", "TrackingNo"], F.min("claimtype").alias("ClaimType")
    if "line_batches" in tables:
        # All batches of a box have all types of its shipments.
        return tables["line_batches"].groupBy(*box, "BatchName").agg(claim).select(
            *box, "ClaimType", "BatchName")
    boxes = shipped_boxes(tables, line).groupBy(*box).agg(claim)
    return boxes.join(received(tables, line), "RMN").select(
        *box, "ClaimType", "BatchName").distinct()


def line_folders(tables: Tables, line: Line) -> DataFrame:
    """(BatchName, dcsid) of folders that may be of the line's batches; few others are there.

    Each once, where they were stored for the line.
    """
    if "line_folders" in tables:
        return tables["line_folders"]
    return near_batches(tables, line, folder_names(tables).where(name_condition(line)))


def folder_names(tables: Tables) -> DataFrame:
    """(BatchName, dcsid) of the folders; from storage, where several lines share them."""
    if "folder_names" in tables:
        return tables["folder_names"]
    return tables["folder_map"].select(F.col("PBatch").alias("BatchName"), "dcsid")


def folder_counts(tables: Tables, line: Line) -> DataFrame:
    """Number of different folders per batch."""
    folders = line_folders(tables, line)
    counted = F.count if "line_folders" in tables else F.count_distinct
    return one_per_key(folders, "BatchName", counted("dcsid").alias("_folders"))


def near_stored(tables: Tables, line: Line, df: DataFrame) -> DataFrame:
    """``near_batches`` where the line's batches are at hand, else all rows."""
    return near_batches(tables, line, df) if "line_batches" in tables else df


def known(tables: Tables, role: str, key: str, name: str, line: Line | None = None) -> DataFrame:
    """Distinct batch names of a lookup table, with the name repeated as a column to test.

    For batches of the ``line``, where it is given.
    """
    names = tables[role].select(F.col(key).alias("BatchName"))
    if line is not None:
        names = near_stored(tables, line, names)
    return one_per_key(names, "BatchName").withColumn(name, F.col("BatchName"))


def intake_master(tables: Tables, line: Line) -> DataFrame:
    """Box, shipment, batch, folder, and whether the batch was scanned and exported."""
    scanned_key = "batchname" if line.scanned_role == "audit" else "kbatch"
    batches = (
        box_batches(tables, line)
        .join(known(tables, line.scanned_role, scanned_key, "ScannedBatchName"), "BatchName",
              "left")
        .join(known(tables, "exported", "kbatch", "ExportedBatchName"), "BatchName", "left")
    )
    columns = ["RMN", "TrackingNo", "claimtype", "BatchName", "BatchClassName", "dcsid",
               "ScannedBatchName", "InvTime", "ExportedBatchName"]
    if line.claim:
        columns.remove("claimtype")
    return with_folders(tables, batches, line=line).select(*columns).distinct()


def with_folders(tables: Tables, batches: DataFrame, name: str = "dcsid",
                 line: Line | None = None) -> DataFrame:
    """Rows of batches, one per folder; a batch without folders stays with NULL.

    Folders bucketed by batch are joined where they lie. With ``line``, the batches are received
    ones of its shipped boxes, and few other folders move.
    """
    folder = F.col("dcsid").alias(name)
    if line is not None and "line_folders" in tables:
        return left_join_children(
            batches, tables["line_folders"].select("BatchName", folder), "BatchName",
            box_batches(tables, line).select("BatchName"))
    folders = tables["folder_map"].withColumnRenamed("PBatch", "BatchName")
    if "folder_map_slices" in tables:
        return left_join_sliced(batches, folders.select("BatchName", "slice", folder).distinct(),
                                "BatchName", tables["folder_map_slices"])
    folders, names = folders.select("BatchName", folder), tables["physical_batch"].select("PBatch")
    if line is not None:
        folders = near_batches(tables, line, folders)
        names = box_batches(tables, line).select("BatchName")
    return left_join_children(batches, folders.distinct(), "BatchName", names)


def line_documents(tables: Tables, line: Line) -> DataFrame:
    """Documents imaged in the line's time, before any test of their box."""
    documents = tables["document"]
    if line.imaged_since:
        documents = documents.where(
            since(F.col("ImageDateTime"), line.imaged_since, line.imaged_since_inclusive))
        if "image_month" in documents.columns:
            documents = documents.where(
                F.col("image_month") >= F.lit(month_start(line.imaged_since).date()))
    if line.upload_prefix:
        documents = documents.where(has_prefix(F.col("PBatch"), line.upload_prefix))
    return documents


def _record_keys(line: Line) -> list[str]:
    keys = ["RMN", "PBatch", "dcsid"] if line.uploads_need_box else ["PBatch", "dcsid"]
    return keys + (["ImageID"] if line.image_grain else [])


def _line_uploads(tables: Tables, line: Line, image_grain: bool) -> DataFrame:
    """(box, batch, folder, perhaps image, UploadTime) of the line, several rows a record.

    From the kept partials where the tables have them, else from the documents. Where the line
    tests their box, rows whose box surely fails are left out before anything moves.
    """
    uploads = kept_records(tables, line, "image_uploads" if image_grain else "folder_uploads")
    if uploads is None:
        uploads = line_documents(tables, line).withColumn("UploadTime", F.col("ftpstime"))
    elif line.upload_prefix:
        uploads = uploads.where(has_prefix(F.col("PBatch"), line.upload_prefix))
    if line.uploads_need_box:
        boxes = tables["check_in"].where(box_condition(line)).select("RMN")
        uploads = near_listed(uploads, "RMN", boxes)
    return uploads


def _records(tables: Tables, line: Line) -> DataFrame:
    uploads = _line_uploads(tables, line, line.image_grain)
    # A record lies in one slice of its batch, so grouping by it too changes no group.
    part = ["slice"] if "slice" in uploads.columns else []
    return uploads.groupBy(*_record_keys(line), *part).agg(
        F.max("UploadTime").alias("UploadTime")).drop("slice")


def upload_records(tables: Tables, line: Line) -> DataFrame:
    """Last upload time per folder, or per image, of each batch; NULL when never uploaded.

    Documents are grouped before their box is tested, so the test sees one row per group, and few
    groups of other boxes.
    """
    records = _records(tables, line)
    if line.uploads_need_box:
        records = records.join(box_keys(tables, line), "RMN", "left_semi")
    return records


def recorded_folders(tables: Tables, line: Line) -> DataFrame:
    """(Batch, folder) of the upload records, once per box they were recorded for."""
    if "line_records" in tables:
        return tables["line_records"].select("PBatch", "dcsid")
    keys = ["RMN", "PBatch", "dcsid"] if line.uploads_need_box else ["PBatch", "dcsid"]
    uploads = _line_uploads(tables, line, False)
    part = ["slice"] if "slice" in uploads.columns else []
    folders = uploads.select(*keys, *part).distinct().drop("slice")
    if line.uploads_need_box:
        folders = folders.join(box_keys(tables, line), "RMN", "left_semi")
    return folders.select("PBatch", "dcsid")


def batch_upload_state(tables: Tables, line: Line) -> DataFrame:
    """Whether any upload record was never uploaded, per batch and, where it counts, per box.

    Records shrink to box and batch before their box is tested. Those stored for the line come as
    they are, one by folder.
    """
    if "line_records" in tables:
        return tables["line_records"].select("PBatch", "Open")
    records = _records(tables, line)
    any_open = F.max(F.col("UploadTime").isNull()).alias("Open")
    if not line.uploads_need_box:
        return records.groupBy("PBatch").agg(any_open)
    return records.groupBy("RMN", "PBatch").agg(any_open).join(
        box_keys(tables, line), "RMN", "left_semi")


def folder_records(tables: Tables, line: Line) -> DataFrame:
    """The upload records by box, where it counts, batch and folder: whether any was never uploaded.

    Documents are grouped before their box is tested, as in ``upload_records``.
    """
    keys = ["RMN", "PBatch", "dcsid"] if line.uploads_need_box else ["PBatch", "dcsid"]
    waits = F.col("UploadTime").isNull()
    records = _records(tables, line)
    if line.image_grain:
        records = records.groupBy(*keys).agg(F.max(waits).alias("Open"))
    else:
        records = records.select(*keys, waits.alias("Open"))
    if line.uploads_need_box:
        records = records.join(box_keys(tables, line), "RMN", "left_semi")
    return records


def uploaded_batches(tables: Tables, name: str = "PBatch") -> DataFrame:
    """Batches with at least one uploaded document; others are dropped by the scan."""
    if "folder_uploads" in tables:
        uploaded = tables["folder_uploads"].where(F.col("UploadTime").isNotNull())
    else:
        uploaded = tables["document"].where(F.col("ftpstime").isNotNull())
    return one_per_key(uploaded.withColumnRenamed("PBatch", name), name)


def active_folders(tables: Tables, line: Line, prefix: str, folder_since: datetime | None = None,
                   batch_since: datetime | None = None) -> DataFrame:
    """Folders of the line's boxes with the class of their batch.

    The start date tests the time of the folder entry or that of its batch.
    """
    folders = tables["folder_map"].where(has_prefix(F.col("PBatch"), prefix))
    if folder_since:
        folders = received_from(folders, folder_since)
    folders = folders.select("RMN", "PBatch", "dcsid").distinct().join(
        box_keys(tables, line), "RMN", "left_semi")
    batches = tables["physical_batch"]
    how = "left"
    if batch_since:
        batches, how = received_from(batches, batch_since), "inner"
    classes = batches.select("PBatch", "BatchClassName").distinct()
    return folders.join(classes, "PBatch", how).select(
        "RMN", "PBatch", "dcsid", "BatchClassName").distinct()


WORKFLOW_COLUMNS = ["BatchName", "WFStep", "BatchLocation", "BatchStatus", "TotalImages"]


def workflow_rows(tables: Tables, line: Line | None = None) -> DataFrame:
    """Different rows of the workflow; for batches of the ``line``, where it is given."""
    rows = tables["workflow"].select(*WORKFLOW_COLUMNS)
    return (rows if line is None else near_stored(tables, line, rows)).distinct()


def workflow_state(tables: Tables, line: Line) -> DataFrame:
    """Current step, location, status and images of the batches received in the line's boxes."""
    batches = tables["physical_batch"].select(F.col("PBatch").alias("BatchName"), "RMN",
                                              "InvTime")
    batches = batches.where(name_condition(line)).join(box_keys(tables, line), "RMN", "left_semi")
    if not line.latest_receipt_only:
        return workflow_rows(tables).join(
            one_per_key(batches, "BatchName"), "BatchName", "left_semi")
    latest = one_per_key(batches, "BatchName", F.max("InvTime").alias("InvTime")).where(
        since(F.col("InvTime"), line.received_since))
    return workflow_rows(tables).join(latest, "BatchName")


def scanned_batches(tables: Tables) -> DataFrame:
    """Batches the scanner knows."""
    return one_per_key(tables["scanner"], "BatchName")


def second_ocr(tables: Tables) -> DataFrame:
    """Batches inside one of the five second OCR jobs."""
    shards = [
        tables[f"ocr{n}"].where(F.col("BatchLocation") != 0).select("BatchName", "TotalImages")
        for n in range(1, 6)
    ]
    return union_shards(*shards)


def nonworking_calendar(tables: Tables) -> DataFrame:
    """Weekend days and named days."""
    return nonworking_rows(tables["calendar"])


def uploaded_between(documents: DataFrame, low: datetime, high: datetime | None) -> DataFrame:
    """Documents uploaded in low <= time < high; prunes upload months where they are kept."""
    t = F.col("ftpstime")
    inside = since(t, low) if high is None else between(t, low, high)
    if "upload_month" in documents.columns:
        month = F.col("upload_month")
        inside = inside & (month >= F.lit(month_start(low).date()))
        if high is not None:
            inside = inside & (month <= F.lit(month_start(high).date()))
    return documents.where(inside)
