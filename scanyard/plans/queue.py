"""Verification queue, daily counts, batch lookup and the delimiter job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanyard import fixed
from scanyard.functions.dates import yesterday
from scanyard.functions.decode import module_name, module_status
from scanyard.operators.projection import or_blank_row
from scanyard.operators.sets import union_distinct
from scanyard.plans.extracts import Tables
from scanyard.sources.files import redelimit
from scanyard.sources.tables import lookup


def r15_verification_queue(tables: Tables, line=None, as_of=None,
                           placeholder: bool = False) -> DataFrame:
    """Batches waiting for verification, with the source of their box."""
    step, at = F.col("WFStep"), F.col("BatchLocation")
    waiting = tables["workflow"].where(
        (step == fixed.VERIFICATION_STEP) & (at == fixed.VERIFICATION_LOCATION))
    # The queue is short: only its own batches and boxes are looked at.
    batches = tables["physical_batch"].select(F.col("PBatch").alias("BatchName"), "RMN")
    sources = tables["check_in"].select("RMN", "boxSource")
    rows = waiting.join(batches, "BatchName").join(sources, "RMN").select(
        "RMN", "BatchName", F.col("TotalImages").alias("TotalImages(OpenBox)"),
        module_name(step, at).alias("TSModule"),
        module_status(F.col("BatchStatus")).alias("Status"), "boxSource").distinct()
    return or_blank_row(rows) if placeholder else rows


def _labelled_count(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count("*").alias("Total")).select(F.lit(label).alias("Status"), "Total")


def r19_daily_completed(tables: Tables, line=None, as_of=None) -> DataFrame:
    """Boxes and folders completed yesterday."""
    done = yesterday(F.col("CompleteDate"), as_of)
    return union_distinct(
        _labelled_count(tables["boxes_done"].where(done), fixed.BOXES_DONE),
        _labelled_count(tables["folders_done"].where(done), fixed.FOLDERS_DONE),
    )


def r20_redelimit(spark: SparkSession, src: str, dst: str) -> None:
    """Tab-separated lines to pipe-separated lines."""
    redelimit(spark, src, dst, "\t", "|")


def r21_batch_lookup(tables: Tables, line=None, as_of=None, *, batch: str) -> DataFrame:
    """Whether the workflow knows a batch."""
    return lookup(tables["workflow"], "BatchName", batch).select(
        F.col("BatchName").alias("batchname"))
