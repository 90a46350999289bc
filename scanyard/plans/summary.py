"""Box summaries: how far each box has come."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanyard import fixed
from scanyard.functions.decode import completion, or_zero
from scanyard.operators.aggregates import count_distinct_through
from scanyard.operators.joins import one_per_key
from scanyard.plans.config import FCS, OMPF, OMPF_DIRECT, VAULT, Line
from scanyard.plans.extracts import (Tables, box_batches, claimed_batches, known, line_folders,
                                     name_condition, recorded_folders, uploaded_batches)

_BOX = ["RMN", "TrackingNo"]


def box_summary(tables: Tables, line: Line) -> DataFrame:
    """Totals per box and shipment, at batch grain wherever possible.

    "Uploaded" counts any document record of a batch, uploaded or not, and all folders
    recorded for the box's batches. Where a shipment carries several claim types the smallest
    is shown.
    """
    batches = claimed_batches(tables, line)
    records = recorded_folders(tables, line).withColumnRenamed("PBatch", "BatchName")
    recorded = one_per_key(records, "BatchName").withColumn("_recorded", F.col("BatchName"))
    totals = (
        batches.join(known(tables, "exported", "kbatch", "_exported", line), "BatchName", "left")
        .join(recorded, "BatchName", "left")
        .groupBy(*_BOX, "ClaimType")
        .agg(
            F.count("BatchName").alias("TotalBatches"),
            F.count("_exported").alias("Exported"),
            F.count("_recorded").alias("Uploaded"),
        )
    )
    folders, stored = line_folders(tables, line), "line_folders" in tables
    if stored:
        # Stored folders are different; the records are so but for their box.
        records = records.distinct()
    # Only names the line's batches can have; said here, every use below reads the same rows.
    both = folders.withColumn("_kind", F.lit("all")).unionByName(
        records.withColumn("_kind", F.lit("recorded"))).where(name_condition(line))
    counts = count_distinct_through(batches, both, _BOX, "BatchName", "dcsid", "_n", "_kind",
                                    unique=stored)

    def folders_of(kind: str) -> Column:
        return or_zero(F.sum(F.when(F.col("_kind") == kind, F.col("_n"))))

    wide = counts.groupBy(*_BOX).agg(folders_of("all").alias("TotalDCSIDs"),
                                     folders_of("recorded").alias("UploadedDCSIDs"))
    return totals.join(wide, _BOX, "left").select(
        *_BOX, "ClaimType", "TotalBatches",
        or_zero(F.col("TotalDCSIDs")).alias("TotalDCSIDs"),
        (F.col("TotalBatches") - F.col("Exported")).alias("InProgress"),
        "Exported", "Uploaded",
        or_zero(F.col("UploadedDCSIDs")).alias("UploadedDCSIDs"),
    )


def _claims_report(summary: DataFrame) -> DataFrame:
    header = list(fixed.BOX_SUMMARY_HEADER)
    header.insert(2, "ClaimType")
    named = summary.toDF(*header)
    return named.withColumn(
        "Status", completion(F.col("TotalBatches"), F.col("`Uploaded(Batches)`")))


def r01_box_summary(tables: Tables, line: Line = FCS, as_of=None) -> DataFrame:
    """Per box and shipment totals with Completed or Partial."""
    return _claims_report(box_summary(tables, line))


def r04_vault_summary(tables: Tables, line: Line = VAULT, as_of=None) -> DataFrame:
    """Vault boxes not yet complete."""
    return r01_box_summary(tables, line).where(F.col("Status") == fixed.PARTIAL)


def r05_box_summary(tables: Tables, line: Line = OMPF, as_of=None,
                    only_unfinished: bool = False) -> DataFrame:
    """Box totals without claim type; ``only_unfinished`` keeps boxes that lack both batches
    and folders."""
    summary = box_summary(tables, line).drop("ClaimType")
    if only_unfinished:
        summary = summary.where(
            (F.col("TotalBatches") != F.col("Uploaded"))
            & (F.col("TotalDCSIDs") != F.col("UploadedDCSIDs")))
    return summary.toDF(*fixed.BOX_SUMMARY_HEADER)


def r09_direct_summary(tables: Tables, line: Line = OMPF_DIRECT, as_of=None) -> DataFrame:
    """Batches, exported batches and batches with an uploaded document, per box."""
    batches = box_batches(tables, line).select(*_BOX, "BatchName").distinct()
    uploaded = uploaded_batches(tables, "BatchName").withColumn("_uploaded", F.col("BatchName"))
    return (
        batches.join(known(tables, "exported", "kbatch", "_exported"), "BatchName", "left")
        .join(uploaded, "BatchName", "left")
        .groupBy(*_BOX)
        .agg(F.count("BatchName").alias("Batches"), F.count("_exported").alias("Exported"),
             F.count("_uploaded").alias("Uploaded"))
        .select(*_BOX, "Batches", (F.col("Batches") - F.col("Exported")).alias("InProgress"),
                "Exported", "Uploaded")
    )
