"""Aggregates (A1 to A19)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog import report_sql as sql
from catalog.registry import START, case
from scanyard.functions import dates
from scanyard.functions.decode import media_counts
from scanyard.operators import aggregates, distinct
from scanyard.operators.joins import flag_any
from scanyard.operators.projection import key_when
from scanyard.operators.sets import union_distinct
from scanyard.plans import inventory, monthly
from scanyard.plans.config import IMAGE_INVENTORY
from scanyard.session import shared_dir

c = F.col


@case("a01_distinct", "select distinct RMN, dcsid from document")
def _(roles):
    return roles["document"].select("RMN", "dcsid").distinct()


@case("a02_count_rows", "select count(*) as documents from document")
def _(roles):
    return roles["document"].agg(F.count("*").alias("documents"))


@case("a03_count_distinct", """
    select RMN, count(distinct ImageID) as images from document group by RMN""")
def _(roles):
    return roles["document"].groupBy("RMN").agg(F.count_distinct("ImageID").alias("images"))


@case("a04_several_distinct_counts", """
    select RMN, count(distinct PBatch) as batches, count(distinct dcsid) as folders,
           count(distinct ImageID) as images, count(distinct docidDoctype) as types,
           count(distinct ftpstime) as upload_times
    from document group by RMN""")
def _(roles):
    return aggregates.distinct_counts(roles["document"], ["RMN"], {
        "batches": "PBatch", "folders": "dcsid", "images": "ImageID", "types": "docidDoctype",
        "upload_times": "ftpstime"})


@case("a04_mergeable_distinct_counts", """
    select docidDoctype, count(distinct PBatch) as "PBatch", count(distinct dcsid) as dcsid,
           count(distinct ImageID) as "ImageID"
    from document group by docidDoctype""")
def _(roles):
    """From bitmaps of uploaded and waiting documents, which share batches and folders."""
    names, waiting = ["PBatch", "dcsid", "ImageID"], c("ftpstime").isNull().alias("waiting")
    spark = roles["document"].sparkSession
    # Stored once, so that each column is read by itself.
    documents, path = roles["document"].select("docidDoctype", *names, waiting), shared_dir(spark)
    documents.write.parquet(path)
    documents = spark.read.schema(documents.schema).parquet(path)
    numbers = {name: distinct.Numbers(spark, f"{shared_dir(spark)}/{name}", "string").extend(
        documents.select(name)) for name in names}
    parts = distinct.bitmaps(documents, ["docidDoctype", "waiting"], numbers)
    return distinct.counts(distinct.merged([parts], ["docidDoctype"]), ["docidDoctype"], names)


@case("a05_two_level_sum", """
    select RMN, cast(sum(pages) as bigint) as pages, cast(max(pages) as bigint) as largest
    from (select RMN, PBatch, sum(NumPages) as pages from document group by RMN, PBatch)
    group by RMN""")
def _(roles):
    batches = roles["document"].groupBy("RMN", "PBatch").agg(F.sum("NumPages").alias("pages"))
    return batches.groupBy("RMN").agg(F.max("pages").alias("largest"),
                                      F.sum("pages").alias("pages"))


@case("a06_latest", """
    select PBatch, strftime(max(ftpstime), '%m/%d/%Y') as last_upload from document
    group by PBatch""")
def _(roles):
    return roles["document"].groupBy("PBatch").agg(
        dates.us_date(F.max("ftpstime")).alias("last_upload"))


@case("a07_earliest", """
    select RMN, strftime(min(InvTime), '%m/%d/%Y') as first_day from physical_batch group by RMN""")
def _(roles):
    return roles["physical_batch"].groupBy("RMN").agg(
        dates.us_date(F.min("InvTime")).alias("first_day"))


@case("a08_stage_pivot", sql.image_inventory().replace(
    "strftime(day, '%m/%d/%Y') as CheckInDate", 'day as "Day"'))
def _(roles):
    return inventory.stage_pivot(roles, IMAGE_INVENTORY.starting(START))


@case("a09_count_by_class", """
    select RMN, BatchClassName, if(BatchClassName <> 'SM', n, 0) as paper,
           if(BatchClassName = 'SM', n, 0) as special
    from (select RMN, BatchClassName, count(distinct PBatch) as n from physical_batch
          group by RMN, BatchClassName)""")
def _(roles):
    counted = roles["physical_batch"].groupBy("RMN", "BatchClassName").agg(
        F.count_distinct("PBatch").alias("n"))
    paper, special = media_counts(c("BatchClassName"), c("n"))
    return counted.select("RMN", "BatchClassName", paper.alias("paper"), special.alias("special"))


@case("a10_count_conditional_key", """
    select cast(first_time as date) as day, count(*) as boxes,
           count(*) filter (total > done) as active, count(*) filter (total = done) as completed
    from (select RMN, min(InvTime) as first_time, count(*) as total, count(u.PBatch) as done
          from physical_batch p left join
               (select distinct PBatch from document where ftpstime is not null) u using (PBatch)
          group by RMN)
    group by day""")
def _(roles):
    uploaded = flag_any(roles["document"], "PBatch", c("ftpstime").isNotNull(), "up").where("up")
    boxes = roles["physical_batch"].join(uploaded, "PBatch", "left").groupBy("RMN").agg(
        F.min("InvTime").alias("first"), F.count("*").alias("total"), F.count("up").alias("done"))
    active = c("total") != c("done")
    return boxes.groupBy(F.to_date("first").alias("day")).agg(
        F.count("RMN").alias("boxes"),
        F.count(key_when(active, c("RMN"))).alias("active"),
        F.count(key_when(~active, c("RMN"))).alias("completed"))


_SUMS = ", ".join(f'cast("{m}" as bigint) as "{m}"' for m in monthly.MEASURES)


@case("a11_line_of_business_counts", f"""
    with {sql.per_day('1995-01-01', '2002-01-01')} select day as "Day", {_SUMS} from per_day""")
def _(roles):
    return monthly.lob_counts(roles, START, START.replace(year=2002))


@case("a12_rollup_total", """
    select case when grouping(day) = 1 then 'Total' else cast(day as varchar) end as day,
           count(*) as docs, cast(sum(NumPages) as bigint) as pages
    from (select cast(ftpstime as date) as day, NumPages from document) group by rollup(day)""")
def _(roles):
    """Documents without an upload day stay a group of their own beside the total."""
    days = roles["document"].groupBy(F.to_date("ftpstime").alias("day")).agg(
        F.count("*").alias("docs"), F.sum("NumPages").alias("pages"))
    return aggregates.rollup_total(days, "day", ["docs", "pages"])


@case("a12_rollup_guaranteed_total", """
    with windows(until) as (values (timestamp '1998-03-01'), (timestamp '1998-03-15')),
    days as (
        select until, cast(ftpstime as date) as day, count(*) as docs
        from windows join document on ftpstime >= timestamp '1998-03-01' and ftpstime < until
        group by all)
    select cast(until as date) as until, cast(day as varchar) as day, docs from days
    union all
    select cast(until as date), 'Total', (select cast(sum(docs) as bigint) from days
                                          where days.until = windows.until) from windows""")
def _(roles):
    """Month to date: on the first of a month there is no day yet, but a total is wanted."""
    def totals(as_of):
        docs = roles["document"].where(dates.month_to_date(c("ftpstime"), as_of))
        days = docs.groupBy(F.to_date("ftpstime").alias("day")).agg(F.count("*").alias("docs"))
        rolled = aggregates.rollup_total(days, "day", ["docs"], always=True)
        return rolled.select(F.lit(as_of.date()).alias("until"), "*")
    return totals(datetime(1998, 3, 1, 10)).unionByName(totals(datetime(1998, 3, 15, 10)))


@case("a13_group_by_expression", """
    select strftime(ftpstime, '%Y-%m') as month, count(*) as docs from document group by month""")
def _(roles):
    return roles["document"].groupBy(F.date_format("ftpstime", "yyyy-MM").alias("month")).agg(
        F.count("*").alias("docs"))


@case("a14_bare_column", """
    select trackingno, min(claimtype) as claimtype, count(*) as boxes from check_in
    group by trackingno""")
def _(roles):
    return roles["check_in"].groupBy("trackingno").agg(
        F.min("claimtype").alias("claimtype"), F.count("*").alias("boxes"))


@case("a15_mean_pivot", """
    select BatchClassName, PBatch, coalesce(cast(avg(TotalImages) as varchar), '-') as TotalImages,
           coalesce(cast(avg(case when jobid = 8 then WFStep end) as varchar), '-') as Step
    from physical_batch left join workflow on BatchName = PBatch
    where BatchClassName is not null
    group by BatchClassName, PBatch having count(TotalImages) > 0""")
def _(roles):
    """Batches without a step in job 8 show the filler, those without any step are left out."""
    rows = roles["physical_batch"].join(
        roles["workflow"], c("PBatch") == c("BatchName"), "left").withColumn(
        "Step", F.when(c("jobid") == 8, c("WFStep")))
    return aggregates.mean_pivot(rows, ["BatchClassName", "PBatch"], ["TotalImages", "Step"])


@case("a16_distinct_after_grouping", """
    select distinct PBatch, docs from
    (select PBatch, dcsid, count(*) as docs from document group by PBatch, dcsid)""")
def _(roles):
    folders = roles["document"].groupBy("PBatch", "dcsid").agg(F.count("*").alias("docs"))
    return folders.select("PBatch", "docs").distinct()


@case("a17_labelled_counts", """
    select 'boxes' as label, count(*) as n from boxes_done
    union select 'folders', count(*) from folders_done""")
def _(roles):
    def counted(role, label):
        return roles[role].agg(F.count("*").alias("n")).select(F.lit(label).alias("label"), "n")
    return union_distinct(counted("boxes_done", "boxes"), counted("folders_done", "folders"))


@case("a18_column_widths", """
    select 'RMN' as "column", cast(greatest(3, max(length(RMN))) as integer) as width
    from physical_batch
    union all select 'BatchClassName', cast(greatest(14, max(coalesce(length(BatchClassName), 4)))
        as integer) from physical_batch
    union all select 'PBatch', cast(greatest(6, max(length(PBatch))) as integer)
    from physical_batch""")
def _(roles):
    return aggregates.column_widths(
        roles["physical_batch"].select("RMN", "BatchClassName", "PBatch"))


@case("a19_flag_max", """
    with days as (
        select cast(ftpstime as date) as day, count(*) as docs,
               cast(sum(NumPages) as bigint) as pages
        from document where ftpstime is not null group by day),
    rolled as (
        select cast(day as varchar) as day, docs, pages from days
        union all select 'Total', cast(sum(docs) as bigint), cast(sum(pages) as bigint) from days)
    select *, docs = (select max(docs) from rolled) as "docs is max",
           pages = (select max(pages) from rolled) as "pages is max", day = 'Total' as "is total"
    from rolled""")
def _(roles):
    """As the reports do it, the total row is among the rows compared."""
    days = roles["document"].where("ftpstime is not null").groupBy(
        F.to_date("ftpstime").alias("day")).agg(
        F.count("*").alias("docs"), F.sum("NumPages").alias("pages"))
    rolled = aggregates.rollup_total(days, "day", ["docs", "pages"])
    return aggregates.flag_max(rolled, ["docs", "pages"], "day")

