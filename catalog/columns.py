"""Projections and conditional columns (P1 to P20) and scalar functions (C1 to C17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import AS_OF, case
from catalog.report_sql import AT_STAGE, CODES, STAGES
from scanyard import fixed
from scanyard.functions import dates, decode, text
from scanyard.operators import projection
from scanyard.plans.extracts import known, second_ocr

c = F.col


@case("p01_projection", "select RMN, PBatch from physical_batch")
def _(roles):
    return roles["physical_batch"].select("RMN", "PBatch")


@case("p02_positional_rename", """
    select rtrim(RMN) as "Box", claimtype as "Claim Type" from check_in""")
def _(roles):
    return projection.rename_all(roles["check_in"].select("RMN", "claimtype"),
                                 ["Box", "Claim Type"])


@case("p03_alias", """
    select ImageID as "PDF-Image", NumPages as "Image Count Per PDF" from document""")
def _(roles):
    return roles["document"].select(c("ImageID").alias("PDF-Image"),
                                    c("NumPages").alias("Image Count Per PDF"))


@case("p04_constants", """
    select kbatch, 'VA' as "CustomerName", 'OpenBox' as "ProcessType", 'COMPLETED' as "Status",
           'MTV' as "SiteName", 'Public Sector' as "Vertical", 'NA' as "Region",
           'US' as "Country", 'NA' as "BillType", 'Upload' as "Sub-Process", 0 as "Characters"
    from exported""")
def _(roles):
    return projection.with_constants(roles["exported"], fixed.FEED_ATTRIBUTES)


@case("p05_drop_columns", "select rtrim(RMN) as RMN, trackingno, claimtype from check_in")
def _(roles):
    return roles["check_in"].drop("boxOrigin", "boxSource", "insertdate")


@case("p06_aggregate_difference", """
    select RMN, count(*) - count(kbatch) as in_process
    from physical_batch left join exported on kbatch = PBatch group by RMN""")
def _(roles):
    joined = roles["physical_batch"].join(
        roles["exported"].distinct(), c("PBatch") == c("kbatch"), "left")
    return joined.groupBy("RMN").agg((F.count("*") - F.count("kbatch")).alias("in_process"))


@case("p07_stage_name", f"""
    with {STAGES} select BatchName, stage from workflow left join {AT_STAGE}""")
def _(roles):
    return roles["workflow"].select(
        "BatchName", decode.stage_name(c("WFStep"), c("BatchLocation")).alias("stage"))


def _batch_rows(roles):
    """Received batches beside their export, workflow, scanner and second OCR entries."""
    states = roles["workflow"].select("BatchName", "BatchStatus", "TotalImages").distinct()
    jobs = second_ocr(roles).select(
        "BatchName", c("TotalImages").alias("second_images"), F.lit(True).alias("second"))
    return (
        roles["physical_batch"].select(c("PBatch").alias("BatchName")).distinct()
        .join(known(roles, "exported", "kbatch", "exported"), "BatchName", "left")
        .join(states.withColumn("known", c("BatchName")), "BatchName", "left")
        .join(known(roles, "scanner", "BatchName", "scanned"), "BatchName", "left")
        .join(jobs, "BatchName", "left")
        .withColumn("second", F.coalesce("second", F.lit(False)))
        .withColumn("status", decode.batch_status(c("exported"), c("BatchStatus"), c("known")))
    )


_BATCH_ROWS = f"""{CODES},
    jobs as (select BatchName, TotalImages as second_images from ocr1 where BatchLocation <> 0
        union select BatchName, TotalImages from ocr2 where BatchLocation <> 0
        union select BatchName, TotalImages from ocr3 where BatchLocation <> 0
        union select BatchName, TotalImages from ocr4 where BatchLocation <> 0
        union select BatchName, TotalImages from ocr5 where BatchLocation <> 0),
    batch_rows as (
        select p.PBatch as BatchName, w.TotalImages, s.BatchName as scanned,
               j.BatchName as second_name, j.second_images,
               case when e.kbatch is not null then 'Exported' else coalesce(word,
                    case when w.BatchName is null then 'Pending OpenBox Import' end) end as status
        from (select distinct PBatch from physical_batch) p
        left join exported e on e.kbatch = p.PBatch
        left join (select distinct BatchName, BatchStatus, TotalImages from workflow) w
          on w.BatchName = p.PBatch
        left join codes on code = BatchStatus
        left join scanner s on s.BatchName = p.PBatch left join jobs j on j.BatchName = p.PBatch)"""


@case("p08_batch_status", f"with {_BATCH_ROWS} select BatchName, status from batch_rows")
def _(roles):
    return _batch_rows(roles).select("BatchName", "status")


@case("p09_outstanding_status", f"""
    with {_BATCH_ROWS}
    select BatchName, case status when 'Exported' then 'Pending Upload'
        when 'Pending OpenBox Import' then case when scanned is null then 'Pending IBML Scan'
        else status end else status end as status from batch_rows""")
def _(roles):
    status = decode.outstanding_status(c("status"), c("scanned").isNotNull(),
                                       fixed.PENDING_SCANNER)
    return _batch_rows(roles).select("BatchName", status.alias("status"))


@case("p10_second_ocr_status", f"""
    with {_BATCH_ROWS}
    select BatchName, case when second_name is not null then 'WIP 2nd Job OCR'
        when status = 'Exported' then 'Pending Upload'
        when status = 'Pending OpenBox Import' and scanned is null then 'Pending Scan'
        else status end as status from batch_rows""")
def _(roles):
    status = decode.outstanding_status(c("status"), c("scanned").isNotNull(),
                                       fixed.PENDING_SCAN, c("second"))
    return _batch_rows(roles).select("BatchName", status.alias("status"))


@case("p11_matched_value", f"""
    with {_BATCH_ROWS}
    select BatchName, case when second_name is null then TotalImages else second_images end
        as images from batch_rows""")
def _(roles):
    images = decode.either(c("second"), c("second_images"), c("TotalImages"))
    return _batch_rows(roles).select("BatchName", images.alias("images"))


@case("p12_null_to_dash", "select PBatch, coalesce(BatchClassName, '-') as class from physical_batch")
def _(roles):
    return roles["physical_batch"].select(
        "PBatch", decode.or_dash(c("BatchClassName")).alias("class"))


@case("p13_null_to_zero", """
    select calendardate, coalesce(docs, 0) as docs
    from calendar left join second_site on UploadDate = calendardate""")
def _(roles):
    days = roles["calendar"].join(
        roles["second_site"], c("calendardate") == c("UploadDate"), "left")
    return days.select("calendardate", decode.or_zero(c("docs")).alias("docs"))


@case("p14_media_flag", """
    select PBatch, case when BatchClassName is not distinct from 'SM' then 'SM' else 'P' end
        as media from physical_batch""")
def _(roles):
    return roles["physical_batch"].select(
        "PBatch", decode.media_flag(c("BatchClassName")).alias("media"))


_MODULES = """modules(step, place, module) as (values
    (1, 1, 'Scan/Capture'), (2, 2, 'Enhance1'), (3, 16, 'FOCR1'), (4, 2, 'Enhance2'),
    (5, 4, 'Separation'), (6, 128, 'QA1'), (7, 8, 'AutoIndex'), (8, 128, 'QA2'),
    (9, 128, 'QA3'), (10, 32, 'ManualIndex'), (11, 32, 'ManualIndex2'),
    (12, 64, 'Verification/BVTI'), (13, 256, 'Export'), (13, 0, 'Clean'))"""


@case("p15_module_name", f"""
    with {_MODULES}, places as (
        select BatchName, WFStep, BatchLocation from workflow
        union all select BatchName, WFStep, BatchStatus from workflow)
    select BatchName, WFStep, BatchLocation, coalesce(module,
           'WFStep' || cast(WFStep as varchar) || ' BchLoc ' || cast(BatchLocation as varchar)
           || ' - LocationError') as module
    from places left join modules on step = WFStep and place = BatchLocation""")
def _(roles):
    """The batches' own places, and their status codes as places to see odd ones."""
    rows = roles["workflow"].select("BatchName", "WFStep", "BatchLocation").unionAll(
        roles["workflow"].select("BatchName", "WFStep", "BatchStatus"))
    return rows.withColumn("module", decode.module_name(c("WFStep"), c("BatchLocation")))


@case("p16_module_status", """
    select BatchName, case BatchStatus when 0 then 'Error' when 1 then 'Ready'
        when 2 then 'In Process' when 4 then 'Suspended' when 8 then 'Auto-Fail' end as status
    from workflow""")
def _(roles):
    return roles["workflow"].select(
        "BatchName", decode.module_status(c("BatchStatus")).alias("status"))


@case("p17_job_name", """
    select PBatch, p.RMN, case
        when PBatch like '01%' then if(p.RMN like '101%', 'VAULT', 'RMC')
        when PBatch like '02%' then if(claimtype is null, null,
                                       if(claimtype = 'OMPF', 'OMPF', 'FCS'))
        when PBatch like '07%' then 'BWN' when PBatch like '08%' then 'REA' end as job
    from physical_batch p left join check_in c on rtrim(c.RMN) = p.RMN""")
def _(roles):
    joined = roles["physical_batch"].join(
        roles["check_in"].select("RMN", "claimtype").distinct(), "RMN", "left")
    job = decode.job_name(c("PBatch"), c("RMN"), c("claimtype"))
    return joined.select("PBatch", "RMN", job.alias("job"))


@case("p18_completion", """
    select RMN, case when count(*) = count(kbatch) then 'Completed' else 'Partial' end as status
    from physical_batch left join exported on kbatch = PBatch group by RMN""")
def _(roles):
    joined = roles["physical_batch"].join(
        roles["exported"].distinct(), c("PBatch") == c("kbatch"), "left")
    counts = joined.groupBy("RMN").agg(F.count("*").alias("total"),
                                       F.count("kbatch").alias("done"))
    return counts.select("RMN", decode.completion(c("total"), c("done")).alias("status"))


@case("p19_conditional_key", """
    select RMN, count(distinct PBatch) filter (BatchClassName = 'SM') as special_batches
    from physical_batch group by RMN""")
def _(roles):
    key = projection.key_when(c("BatchClassName") == "SM", c("PBatch"))
    return roles["physical_batch"].groupBy("RMN").agg(
        F.count_distinct(key).alias("special_batches"))


@case("p20_pending_text", """
    select PBatch, format('Exported [{} of {} doc(s) pending upload]',
                          count(*) - count(ftpstime), count(*)) as status
    from document group by PBatch""")
def _(roles):
    counts = roles["document"].groupBy("PBatch").agg(
        F.count("*").alias("total"), F.count("ftpstime").alias("done"))
    return counts.select("PBatch", decode.pending_text(c("total"), c("done")).alias("status"))


@case("c01_right_trim", "select rtrim(FileNumber) as number, ImageID from document")
def _(roles):
    return roles["document"].select(text.clean_key(c("FileNumber")).alias("number"), "ImageID")


@case("c02_mask_tail", """
    select ImageID, '********' || nullif(right(trim(FileNumber), 1), '') as masked
    from document""")
def _(roles):
    return roles["document"].select("ImageID", text.mask_tail(c("FileNumber")).alias("masked"))


@case("c03_mask_name", """
    select dcsid, substr(Firstname, 1, 1) || '*** ' || substr(Lastname, 1, 1) || '***' as masked
    from customer_data""")
def _(roles):
    return roles["customer_data"].select(
        "dcsid", text.mask_name(c("Firstname"), c("Lastname")).alias("masked"))


@case("c04_concat_text", """
    select BatchName || '/' || cast(WFStep as varchar) as label from workflow""")
def _(roles):
    return roles["workflow"].select(
        text.concat_text(c("BatchName"), F.lit("/"), c("WFStep")).alias("label"))


@case("c05_us_date", "select ImageID, strftime(ftpstime, '%m/%d/%Y') as day from document")
def _(roles):
    return roles["document"].select("ImageID", dates.us_date(c("ftpstime")).alias("day"))


@case("c06_iso_date", "select PBatch, strftime(InvTime, '%Y-%m-%d') as day from physical_batch")
def _(roles):
    return roles["physical_batch"].select("PBatch", dates.iso_date(c("InvTime")).alias("day"))


@case("c07_to_date", "select PBatch, cast(InvTime as date) as day from physical_batch")
def _(roles):
    return roles["physical_batch"].select("PBatch", dates.day_of(c("InvTime")).alias("day"))


@case("c08_first_of_month", """
    select PBatch, cast(date_trunc('month', InvTime) as date) as month from physical_batch""")
def _(roles):
    return roles["physical_batch"].select(
        "PBatch", dates.first_of_month(c("InvTime")).alias("month"))


@case("c09_shift_months", """
    select PBatch, cast(date_trunc('month', InvTime) - interval 1 month as date) as before,
           cast(date_trunc('month', InvTime) + interval 1 month as date) as after
    from physical_batch""")
def _(roles):
    return roles["physical_batch"].select(
        "PBatch", dates.shift_months(c("InvTime"), -1).alias("before"),
        dates.shift_months(c("InvTime"), 1).alias("after"))


@case("c10_shift_days", """
    select PBatch, cast(InvTime as date) - 1 as before from physical_batch""")
def _(roles):
    return roles["physical_batch"].select(
        "PBatch", dates.shift_days(c("InvTime"), -1).alias("before"))


@case("c11_yesterday_bound", """
    select PBatch, InvTime >= timestamp '2001-06-14 00:00:00' as from_yesterday
    from physical_batch""")
def _(roles):
    bound = dates.ts(dates.day_start(AS_OF, -1))
    return roles["physical_batch"].select("PBatch", (c("InvTime") >= bound).alias("from_yesterday"))


@case("c12_elapsed_days", """
    select PBatch, cast(trunc(date_diff('second', InvTime, timestamp '2001-06-15 10:00:00')
                              / cast(86400 as double)) as integer) as days
    from physical_batch""")
def _(roles):
    days = dates.elapsed_days(c("InvTime"), dates.ts(AS_OF))
    return roles["physical_batch"].select("PBatch", dates.whole_days(days).alias("days"))


@case("c13_as_of", """
    select PBatch, InvTime < timestamp '2001-06-15 10:00:00' as past from physical_batch""")
def _(roles):
    return roles["physical_batch"].select("PBatch", (c("InvTime") < dates.ts(AS_OF)).alias("past"))


@case("c14_null_substitute", """
    select rtrim(RMN) as RMN, coalesce(claimtype, 'none') as claim from check_in""")
def _(roles):
    return roles["check_in"].select("RMN", F.coalesce("claimtype", F.lit("none")).alias("claim"))


@case("c15_replace_char", "select replace(ImageID, '-', '|') as image from document")
def _(roles):
    return roles["document"].select(text.replace_char(c("ImageID"), "-", "|").alias("image"))


@case("c16_parse_us_time", """
    select PBatch, InvTime as parsed from physical_batch""")
def _(roles):
    """Receipt times written without leading zeros and read again."""
    written = F.date_format("InvTime", "M/d/yyyy H:m:s")
    return roles["physical_batch"].select("PBatch", dates.parse_us_ts(written).alias("parsed"))


@case("c17_text_length", "select BatchName, length(BatchName) as width from workflow")
def _(roles):
    return roles["workflow"].select(
        "BatchName", text.text_length(c("BatchName")).cast("bigint").alias("width"))
