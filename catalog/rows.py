"""Filters (F1 to F15), order and limits (O1 to O4), set operations (U1 to U3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import AS_OF, START, case
from catalog.report_sql import NOT_TEST
from scanyard import fixed
from scanyard.functions import dates, predicates
from scanyard.operators import ordering, sets
from scanyard.operators.aggregates import where_agg
from scanyard.plans.extracts import second_ocr

c = F.col


@case("f01_equality", """
    select rtrim(RMN) as RMN from check_in
    where claimtype <> 'OMPF' and boxOrigin = 'fcs'""")
def _(roles):
    return roles["check_in"].where(
        (c("claimtype") != "OMPF") & (c("boxOrigin") == "fcs")).select("RMN")


@case("f02_lower_bound", """
    select 'from' as bound, count(*) as n from physical_batch
    where InvTime >= timestamp '1998-01-01'
    union all select 'after', count(*) from physical_batch
    where InvTime > timestamp '1998-01-01'""")
def _(roles):
    batches, start = roles["physical_batch"], START.replace(year=1998)

    def counted(name, inclusive):
        return batches.where(dates.since(c("InvTime"), start, inclusive)).agg(
            F.count("*").alias("n")).select(F.lit(name).alias("bound"), "n")
    return counted("from", True).unionByName(counted("after", False))


@case("f03_month_to_date", """
    select ImageID, ftpstime from document
    where ftpstime >= date_trunc('month', date '2001-06-15') and ftpstime < date '2001-06-15'""")
def _(roles):
    return roles["document"].where(dates.month_to_date(c("ftpstime"), AS_OF)).select(
        "ImageID", "ftpstime")


@case("f04_previous_month", """
    select ImageID, ftpstime from document
    where date_trunc('month', ftpstime) = date '2001-05-01'""")
def _(roles):
    return roles["document"].where(dates.previous_month(c("ftpstime"), AS_OF)).select(
        "ImageID", "ftpstime")


@case("f05_yesterday", """
    select ImageID, ftpstime from document where cast(ftpstime as date) = date '2001-06-14'""")
def _(roles):
    return roles["document"].where(dates.yesterday(c("ftpstime"), AS_OF)).select(
        "ImageID", "ftpstime")


@case("f06_prefix", "select PBatch from physical_batch where PBatch like '02%'")
def _(roles):
    return roles["physical_batch"].where(predicates.has_prefix(c("PBatch"), "02")).select("PBatch")


@case("f07_any_prefix", """
    select PBatch from physical_batch where substr(PBatch, 1, 2) in ('01', '07')""")
def _(roles):
    return roles["physical_batch"].where(
        predicates.has_any_prefix(c("PBatch"), ["01", "07"])).select("PBatch")


@case("f08_not_test", f"""
    select BatchName from workflow where {NOT_TEST.format(c='BatchName')}""")
def _(roles):
    return roles["workflow"].where(predicates.not_test_batch(c("BatchName"))).select("BatchName")


@case("f09_valid_tracking", """
    select trackingno from check_in
    where trackingno is not null and rtrim(trackingno) not in ('', '1234DUMMY1234')""")
def _(roles):
    return roles["check_in"].where(predicates.valid_tracking(c("trackingno"))).select("trackingno")


@case("f10_in_list", """
    select calendardate from calendar where DayOfWeekName in ('Saturday', 'Sunday')""")
def _(roles):
    return roles["calendar"].where(c("DayOfWeekName").isin("Saturday", "Sunday")).select(
        "calendardate")


@case("f11_null_tests", """
    select 'open' as state, count(*) as n from document where ftpstime is null
    union all select 'uploaded', count(*) from document where ftpstime is not null""")
def _(roles):
    uploaded = c("ftpstime").isNotNull()
    counts = roles["document"].agg(F.count_if(~uploaded).alias("open"),
                                   F.count_if(uploaded).alias("uploaded"))
    return counts.unpivot([], ["open", "uploaded"], "state", "n")


@case("f12_tracked_stage", """
    select BatchName from workflow
    where WFStep between 1 and 10 or (WFStep, BatchLocation) in ((12, 64), (13, 256), (13, 0))""")
def _(roles):
    return roles["workflow"].where(
        predicates.in_tracked_stage(c("WFStep"), c("BatchLocation"))).select("BatchName")


@case("f13_filter_on_aggregate", """
    select RMN, max(InvTime) as latest from physical_batch
    group by RMN having max(InvTime) >= timestamp '2001-06-10'""")
def _(roles):
    return where_agg(roles["physical_batch"], ["RMN"], {"latest": F.max("InvTime")},
                     dates.since(c("latest"), "2001-06-10"))


@case("f14_mask_filter", """
    select RMN, batches from
    (select RMN, count(*) as batches, count(kbatch) as done
     from physical_batch left join exported on kbatch = PBatch group by RMN)
    where not (batches = done)""")
def _(roles):
    joined = roles["physical_batch"].join(
        roles["exported"].distinct(), c("PBatch") == c("kbatch"), "left")
    counts = joined.groupBy("RMN").agg(F.count("*").alias("batches"),
                                       F.count("kbatch").alias("done"))
    partial = F.when(c("batches") == c("done"), fixed.COMPLETED).otherwise(fixed.PARTIAL)
    return counts.where(partial == fixed.PARTIAL).select("RMN", "batches")


@case("f15_column_inequality", """
    select BatchName, WFStep, BatchLocation from workflow where WFStep <> BatchLocation""")
def _(roles):
    return roles["workflow"].where(c("WFStep") != c("BatchLocation")).select(
        "BatchName", "WFStep", "BatchLocation")


@case("o01_order_by_one", "select PBatch, InvTime from physical_batch order by PBatch")
def _(roles):
    return ordering.order_by(roles["physical_batch"].select("PBatch", "InvTime"), "PBatch")


@case("o02_order_by_several", """
    select claimtype, rtrim(RMN) as RMN from check_in order by 1 nulls first, 2""")
def _(roles):
    return ordering.order_by(roles["check_in"].select("claimtype", "RMN"), "claimtype", "RMN")


@case("o03_order_by_group_key", """
    select cast(InvTime as date) as day, avg(o.TotalImages) as images
    from physical_batch join workflow o on BatchName = PBatch group by day order by day""")
def _(roles):
    work = roles["workflow"].select(c("BatchName").alias("PBatch"), "TotalImages")
    days = roles["physical_batch"].join(work, "PBatch").groupBy(
        F.to_date("InvTime").alias("day")).agg(F.avg("TotalImages").alias("images"))
    return ordering.order_by(days, "day")


@case("o04_first_rows", """
    select PBatch, InvTime from physical_batch order by InvTime, PBatch limit 100""")
def _(roles):
    return ordering.first_rows(roles["physical_batch"].select("PBatch", "InvTime"), 100,
                               ["InvTime", "PBatch"])


@case("u01_union_labelled_counts", """
    select 'boxes' as label, count(*) as n from check_in
    union select 'batches', count(*) from physical_batch""")
def _(roles):
    def counted(role, label):
        return roles[role].agg(F.count("*").alias("n")).select(F.lit(label).alias("label"), "n")
    return sets.union_distinct(counted("check_in", "boxes"), counted("physical_batch", "batches"))


@case("u02_union_by_position", """
    select RMN as name, 'box' as kind from document
    union select PBatch, 'batch' from document""")
def _(roles):
    documents = roles["document"]
    return sets.union_distinct(
        documents.select(c("RMN").alias("name"), F.lit("box").alias("kind")),
        documents.select(c("PBatch"), F.lit("batch")))


@case("u03_union_shards", """
    select distinct BatchName, TotalImages from (
        select * from ocr1 union all select * from ocr2 union all select * from ocr3
        union all select * from ocr4 union all select * from ocr5)
    where BatchLocation <> 0""")
def _(roles):
    return second_ocr(roles)
