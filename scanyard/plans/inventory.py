"""Inventories: images by workflow stage and boxes by state, per check-in day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanyard import fixed
from scanyard.functions.dates import us_date
from scanyard.functions.decode import inventory_stage
from scanyard.functions.predicates import has_prefix, in_tracked_stage, not_test_batch
from scanyard.operators.aggregates import sum_case
from scanyard.operators.projection import key_when, or_blank_row
from scanyard.plans.config import BOX_INVENTORY, IMAGE_INVENTORY, INVENTORY_JOB, Line
from scanyard.plans.extracts import (Tables, batch_condition, box_keys, received,
                                     uploaded_batches)

STAGES = [name for name, _, _ in fixed.INVENTORY_STAGES]


def stage_pivot(tables: Tables, line: Line, dedupe: bool = True) -> DataFrame:
    """Images per check-in day and stage, one column per stage.

    Sums are taken per step and location. The location is not part of the compared columns:
    with ``dedupe`` (the report's way) two locations of one stage with equal sums become one;
    without it every location counts.
    """
    days = received(tables, line).join(box_keys(tables, line), "RMN", "left_semi").select(
        F.to_date("InvTime").alias("Day"), "BatchName").distinct()
    step, at = F.col("WFStep"), F.col("BatchLocation")
    work = tables["workflow"].where(
        F.col("TotalImages").isNotNull() & in_tracked_stage(step, at)
        & (F.col("jobid") == INVENTORY_JOB)
        & has_prefix(F.col("BatchName"), line.batch_prefix)
        & not_test_batch(F.col("BatchName")))
    groups = days.join(work, "BatchName").groupBy("Day", "WFStep", "BatchLocation").agg(
        F.sum("TotalImages").alias("Images"))
    staged = groups.select("Day", inventory_stage(step, at).alias("Stage"), "Images")
    if dedupe:
        staged = staged.distinct()
    return sum_case(staged, ["Day"], "Stage", "Images", STAGES)


def r13_image_inventory(tables: Tables, line: Line = IMAGE_INVENTORY, as_of=None,
                        dedupe: bool = True, placeholder: bool = False) -> DataFrame:
    pivot = stage_pivot(tables, line, dedupe)
    rows = pivot.select(us_date(F.col("Day")).alias("CheckInDate"), "ImageCount", *STAGES)
    return or_blank_row(rows) if placeholder else rows


def box_states(tables: Tables, line: Line) -> DataFrame:
    """Per box: first check-in day, batches, and batches with an uploaded document.

    One pass over the batches: the first day looks only at batches of the line, the counts at
    all batches of the box.
    """
    own = batch_condition(line)
    batches = (
        tables["physical_batch"].join(box_keys(tables, line), "RMN", "left_semi")
        .groupBy("RMN", "PBatch").agg(F.min(F.when(own, F.col("InvTime"))).alias("_first"))
    )
    uploaded = uploaded_batches(tables).withColumn("_uploaded", F.col("PBatch"))
    boxes = batches.join(uploaded, "PBatch", "left").groupBy("RMN").agg(
        F.min("_first").alias("First"), F.count("PBatch").alias("Total"),
        F.count("_uploaded").alias("Uploaded"))
    return boxes.where(F.col("First").isNotNull())


def r14_box_inventory(tables: Tables, line: Line = BOX_INVENTORY, as_of=None,
                      placeholder: bool = False) -> DataFrame:
    """Boxes per first check-in day, split into active and completed."""
    done = F.col("Total") == F.col("Uploaded")
    rows = box_states(tables, line).groupBy(us_date(F.col("First")).alias("CheckInDate")).agg(
        F.count("RMN").alias("BoxCount"),
        F.count(key_when(~done, F.col("RMN"))).alias("ACTIVE"),
        F.count(key_when(done, F.col("RMN"))).alias("COMPLETED"),
    )
    return or_blank_row(rows) if placeholder else rows

