"""Image review extracts of yesterday's uploads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanyard.functions.dates import day_start, iso_date
from scanyard.functions.text import mask_name, mask_tail
from scanyard.operators.joins import not_in, one_per_key
from scanyard.plans.extracts import Tables, uploaded_between

_PERSONAL = ["xFirstname", "xLastname", "xFileNumber"]


def review_rows(tables: Tables, as_of) -> DataFrame:
    """Yesterday's documents with the person and the claim type they belong to."""
    documents = uploaded_between(
        tables["document"], day_start(as_of, -1), day_start(as_of)).select(
        "RMN", F.col("dcsid").alias("dcsID"), "PBatch", "ImageID",
        iso_date(F.col("ImageDateTime")).alias("PDF Created"),
        F.col("NumPages").alias("Image Count Per PDF"),
        F.col("FileNumber").alias("xFileNumber"), F.col("docidDoctype").alias("DocType"),
    ).distinct()
    # Of all people only those of the day's folders are brought to one row.
    people = tables["customer_data"].select(
        F.col("dcsid").alias("dcsID"), "PBatch", F.col("Firstname").alias("xFirstname"),
        F.col("Lastname").alias("xLastname"), F.col("Recvdate").alias("Date of Receipt"),
    ).join(one_per_key(documents, ["dcsID", "PBatch"]), ["dcsID", "PBatch"], "left_semi").distinct()
    claims = tables["check_in"].select("RMN", "claimtype").distinct()
    return documents.join(people, ["dcsID", "PBatch"], "left").join(
        claims, "RMN", "left").drop("PBatch").distinct()


def r17_masked_review(tables: Tables, line=None, as_of=None) -> DataFrame:
    """The review extract with names and file numbers masked; masking does not merge rows."""
    masked = review_rows(tables, as_of).withColumns({
        "Veteran Name": mask_name(F.col("xFirstname"), F.col("xLastname")),
        "FileNumber": mask_tail(F.col("xFileNumber")),
    })
    return masked.drop(*_PERSONAL).select(
        "RMN", "dcsID", "ImageID", "PDF Created", "Image Count Per PDF", "Veteran Name",
        "FileNumber", "DocType", "Date of Receipt", "claimtype")


def r18_cleared_review(tables: Tables, line=None, as_of=None) -> DataFrame:
    """The review extract without boxes that have a quality exception.

    An exception that matches no batch makes the list hold a NULL, which clears nothing.
    """
    rows = review_rows(tables, as_of).select(
        "RMN", "dcsID", "ImageID", "PDF Created", "Image Count Per PDF", "DocType",
        "Date of Receipt", "claimtype").distinct()
    return not_in(rows, exception_boxes(tables), "RMN")


def exception_boxes(tables: Tables) -> DataFrame:
    """Boxes of the exception batches; NULL for a batch that is not known."""
    exceptions = one_per_key(
        tables["qa_exceptions"].select(F.col("batchname").alias("PBatch")), "PBatch")
    batches = tables["physical_batch"].select("PBatch", "RMN")
    return exceptions.join(batches, "PBatch", "left").select("RMN").distinct()
