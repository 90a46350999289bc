"""Completed-work feed for billing: one row per completed batch and one per box."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanyard import fixed
from scanyard.functions.dates import ts, us_date
from scanyard.functions.decode import job_name
from scanyard.functions.predicates import has_any_prefix
from scanyard.operators.joins import not_in, where_exists
from scanyard.operators.projection import with_constants
from scanyard.plans.config import Feed
from scanyard.plans.extracts import Tables, received_from, uploaded_between


def excluded_keys(tables: Tables, feed: Feed) -> DataFrame:
    """Keys of the uploads inside the span whose folder is on the exclusion list."""
    span = uploaded_between(tables["document"], feed.excluded_after, feed.excluded_before)
    span = span.where(F.col("ftpstime") != ts(feed.excluded_after))
    listed = tables["excluded_folders"].select(F.col("dcs").alias("dcsid"))
    return where_exists(span, listed, "dcsid").select("SysKey")


def completed_batches(tables: Tables, feed: Feed) -> DataFrame:
    """Pages and documents per batch, box and upload day."""
    documents = uploaded_between(tables["document"], feed.uploaded_since, None).where(
        has_any_prefix(F.col("PBatch"), fixed.FEED_PREFIXES))
    if feed.excluded_after is not None:
        documents = not_in(documents, excluded_keys(tables, feed), "SysKey")
    return documents.groupBy("PBatch", "RMN", F.to_date("ftpstime").alias("Day")).agg(
        F.sum("NumPages").alias("ImageCount"), F.count_distinct("ImageID").alias("DocCount"))


def received_batches(tables: Tables, feed: Feed) -> DataFrame:
    """Received batches with the claim types of their box."""
    batches = received_from(tables["physical_batch"], feed.received_since).where(
        has_any_prefix(F.col("PBatch"), fixed.FEED_PREFIXES))
    claims = tables["check_in"].select("RMN", "claimtype").distinct()
    days = batches.select("PBatch", "RMN", F.to_date("InvTime").alias("Received")).distinct()
    return days.join(claims, "RMN", "left").select(
        "PBatch", F.col("RMN").alias("ReceivedRMN"), "Received", "claimtype")


def r16_completed_feed(tables: Tables, line=None, as_of=None, feed: Feed = Feed()) -> DataFrame:
    """Batch rows carry images and documents, box rows carry one box."""
    # Days become text before the join, once per group or batch.
    completed = completed_batches(tables, feed).withColumn("CompleteDate", us_date(F.col("Day")))
    received = received_batches(tables, feed).where(F.col("Received").isNotNull()).withColumn(
        "Received", us_date(F.col("Received")))
    both = completed.join(received, "PBatch")
    # Both rows of a group in one pass over the groups.
    zero = F.lit(0).cast("bigint")
    batch_row = F.struct(
        job_name(F.col("PBatch"), F.col("ReceivedRMN"), F.col("claimtype")).alias("JobName"),
        F.col("PBatch").alias("BatchName"), F.col("ImageCount").cast("bigint").alias("ImageCount"),
        F.col("DocCount").alias("DocCount"), F.lit(0).alias("Boxes"))
    box_row = F.struct(
        job_name(F.col("PBatch"), F.col("RMN"), F.col("claimtype")).alias("JobName"),
        F.col("RMN").alias("BatchName"), zero.alias("ImageCount"), zero.alias("DocCount"),
        F.lit(1).alias("Boxes"))
    rows = both.select("Received", "CompleteDate", F.inline(F.array(batch_row, box_row)))
    # Equal rows are equal in the order too, so they meet in its ranges, and rows move once.
    order = ["JobName", "BatchName", "CompleteDate", "Received"]
    full = with_constants(rows.repartitionByRange(*order).distinct(), fixed.FEED_ATTRIBUTES)
    return full.select(*[F.col(f"`{c}`") for c in fixed.FEED_HEADER]).orderBy(*order)
