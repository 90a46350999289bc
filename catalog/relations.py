"""Joins (J1 to J17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import AS_OF, START, case
from catalog.report_sql import FCS_MASTER
from scanyard.functions.dates import between, day_start, month_start
from scanyard.operators import joins
from scanyard.operators.aggregates import count_distinct_through
from scanyard.plans.config import FCS
from scanyard.plans.extracts import intake_master

c = F.col


@case("j01_left_join", """
    select PBatch, RMN, kbatch is not null as exported
    from physical_batch left join exported on kbatch = PBatch""")
def _(roles):
    listed = roles["exported"].select(c("kbatch").alias("PBatch"), F.lit(True).alias("hit"))
    joined = joins.left_join(roles["physical_batch"], listed, "PBatch")
    return joined.select("PBatch", "RMN", F.coalesce("hit", F.lit(False)).alias("exported"))


@case("j01_left_join_children", """
    select distinct p.PBatch, d.dcsid from physical_batch p left join document d
      on d.PBatch = p.PBatch and d.ftpstime is not null""")
def _(roles):
    uploaded = roles["document"].where("ftpstime is not null").select("PBatch", "dcsid").distinct()
    batches = roles["physical_batch"].select("PBatch")
    return joins.left_join_children(batches.distinct(), uploaded, "PBatch", batches)


@case("j02_inner_join", """
    select BatchName, InvTime, TotalImages
    from physical_batch join workflow on BatchName = PBatch
    where InvTime >= timestamp '1995-01-01'""")
def _(roles):
    """Written as a left join whose condition needs the right side."""
    received = roles["physical_batch"].select(c("PBatch").alias("BatchName"), "InvTime")
    work = roles["workflow"].select("BatchName", "TotalImages")
    return joins.inner_join(work, received.where(c("InvTime") >= F.lit(START)), "BatchName").select(
        "BatchName", "InvTime", "TotalImages")


@case("j03_three_way_join", """
    select w.BatchName, p.RMN, c.boxSource
    from workflow w join physical_batch p on p.PBatch = w.BatchName
    join check_in c on rtrim(c.RMN) = p.RMN""")
def _(roles):
    received = roles["physical_batch"].select(c("PBatch").alias("BatchName"), "RMN")
    with_box = joins.inner_join(roles["workflow"].select("BatchName"), received, "BatchName")
    return joins.inner_join(with_box, roles["check_in"].select("RMN", "boxSource"), "RMN")


@case("j04_semi_join", """
    select PBatch from physical_batch p where exists (
        select 1 from check_in c where rtrim(c.RMN) = p.RMN and claimtype = 'OMPF')""")
def _(roles):
    return joins.where_exists(roles["physical_batch"], roles["check_in"], "RMN",
                              c("claimtype") == "OMPF").select("PBatch")


@case("j05_existence_flag", """
    select PBatch, count(distinct ImageID) filter (is_ompf) as ompf_docs,
           count(distinct ImageID) filter (not is_ompf) as other_docs
    from (select PBatch, ImageID, RMN in (select rtrim(RMN) from check_in
                                          where claimtype = 'OMPF') as is_ompf from document)
    group by PBatch""")
def _(roles):
    flagged = joins.flag_exists(roles["document"].select("PBatch", "RMN", "ImageID"),
                                roles["check_in"], "RMN", "is_ompf", c("claimtype") == "OMPF")
    # One row per image says whether it is under boxes of either kind; nothing is counted twice.
    known = c("ImageID").isNotNull()
    per_image = flagged.groupBy("PBatch", "ImageID").agg(
        F.max(c("is_ompf") & known).alias("ompf"), F.max(~c("is_ompf") & known).alias("other"))
    return per_image.groupBy("PBatch").agg(
        F.count_if("ompf").alias("ompf_docs"), F.count_if("other").alias("other_docs"))


@case("j06_not_in", """
    select PBatch from physical_batch
    where PBatch not in (select batchname from qa_exceptions)""")
def _(roles):
    return joins.not_in(roles["physical_batch"].select("PBatch"), roles["qa_exceptions"],
                        "PBatch", "batchname")


@case("j06_not_in_with_null", """
    select trackingno from check_in where trackingno not in (select BatchClassName
        from physical_batch)""")
def _(roles):
    """The list holds a NULL: nothing passes."""
    return joins.not_in(roles["check_in"].select("trackingno"), roles["physical_batch"],
                        "trackingno", "BatchClassName")


@case("j07_not_in_nested", """
    select SysKey from document where SysKey not in (
        select SysKey from document
        where ftpstime > timestamp '2001-05-01' and ftpstime < timestamp '2001-06-01'
          and dcsid in (select dcs from excluded_folders))""")
def _(roles):
    documents = roles["document"].select("SysKey", "dcsid", "ftpstime")
    span = documents.where((c("ftpstime") > F.lit("2001-05-01").cast("timestamp_ntz"))
                           & (c("ftpstime") < F.lit("2001-06-01").cast("timestamp_ntz")))
    listed = roles["excluded_folders"].select(c("dcs").alias("dcsid"))
    return joins.not_in(documents.select("SysKey"),
                        joins.where_exists(span, listed, "dcsid"), "SysKey")


@case("j08_outstanding", """
    select p.PBatch from physical_batch p
    where not exists (select 1 from document d where d.PBatch = p.PBatch)
       or exists (select 1 from document d where d.PBatch = p.PBatch and d.ftpstime is null)""")
def _(roles):
    return joins.outstanding(roles["physical_batch"].select("PBatch"), roles["document"],
                             "PBatch", c("ftpstime").isNull())


@case("j09_composite_key_join", """
    select d.ImageID, p.Lastname from document d
    left join customer_data p on p.dcsid = d.dcsid and p.PBatch = d.PBatch""")
def _(roles):
    people = roles["customer_data"].select("dcsid", "PBatch", "Lastname")
    return joins.left_join(roles["document"].select("ImageID", "dcsid", "PBatch"), people,
                           ["dcsid", "PBatch"]).select("ImageID", "Lastname")


@case("j10_lookup_flag", """
    select PBatch, PBatch in (select BatchName from scanner) as at_scanner
    from physical_batch""")
def _(roles):
    listed = roles["scanner"].select(c("BatchName").alias("PBatch"))
    return joins.flag_exists(roles["physical_batch"].select("PBatch"), listed, "PBatch",
                             "at_scanner")


@case("j11_rejoin", """
    select f.PBatch, d.dcsid from folder_map f left join
        (select distinct dcsid from document where ftpstime is not null) d using (dcsid)""")
def _(roles):
    uploaded = roles["document"].where("ftpstime is not null").select("dcsid")
    return joins.rejoin(roles["folder_map"].select("PBatch", "dcsid"), uploaded, "dcsid")


@case("j12_counts_through_parent", """
    select p.RMN, count(distinct d.ImageID) as images
    from physical_batch p join document d on d.PBatch = p.PBatch group by p.RMN""")
def _(roles):
    return count_distinct_through(roles["physical_batch"], roles["document"], ["RMN"], "PBatch",
                                  "ImageID", "images")


@case("j13_nonworking_days", """
    select PBatch, coalesce(n, 0) as days from physical_batch left join (
        select InvTime, count(*) as n from (select distinct InvTime from physical_batch)
        join calendar on cast(calendardate as timestamp)
             between InvTime and timestamp '2001-06-15 10:00:00'
        where DayOfWeekName in ('Saturday', 'Sunday') or CalendarDateDescription is not null
        group by InvTime) using (InvTime)""")
def _(roles):
    batches = roles["physical_batch"].select("PBatch", "InvTime")
    return joins.nonworking_days(batches, roles["calendar"], "InvTime", AS_OF, "days").drop(
        "InvTime")


@case("j14_join_on_day", """
    select strftime(l.day, '%m/%d/%Y') as day, l.n, s.docs from
        (select cast(ftpstime as date) as day, count(*) as n from document
         where ftpstime >= timestamp '2001-06-01' and ftpstime < timestamp '2001-06-15'
         group by day) l
    left join second_site s on s.UploadDate = l.day""")
def _(roles):
    window = between(c("ftpstime"), month_start(AS_OF), day_start(AS_OF))
    days = roles["document"].where(window).groupBy(F.to_date("ftpstime").alias("UploadDate")).agg(
        F.count("*").alias("n"))
    joined = joins.left_join(days, roles["second_site"], "UploadDate")
    return joined.select(F.date_format("UploadDate", "MM/dd/yyyy").alias("day"), "n", "docs")


@case("j15_any_uploaded", """
    select PBatch, bool_or(ftpstime is not null) as uploaded from document group by PBatch""")
def _(roles):
    return joins.flag_any(roles["document"], "PBatch", c("ftpstime").isNotNull(), "uploaded")


@case("j16_unused_join_left_out", """
    select p.RMN, count(distinct p.PBatch) as batches
    from physical_batch p left join document d on d.PBatch = p.PBatch group by p.RMN""")
def _(roles):
    """The joined documents add no column and the counts are distinct, so they are not read."""
    return roles["physical_batch"].groupBy("RMN").agg(F.count_distinct("PBatch").alias("batches"))


@case("j17_master_chain", f"""
    with {FCS_MASTER} select RMN, TrackingNo, BatchName, dcsid, ExportedBatchName from master""")
def _(roles):
    return intake_master(roles, FCS.starting(START)).select(
        "RMN", "TrackingNo", "BatchName", "dcsid", "ExportedBatchName")
