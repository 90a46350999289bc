"""Comparison SQL for the report pipelines, in the plain form the reports define.

It joins first and counts afterwards, compares every row with every calendar day, and so on:
the shapes the Spark plans avoid.
"""

from __future__ import annotations

NOW = "timestamp '2001-06-15 10:00:00'"
START = "timestamp '1995-01-01 00:00:00'"

SHIPPED = "trackingno is not null and rtrim(trackingno) not in ('', '1234DUMMY1234')"
NOT_TEST = "{c} not ilike '%test%' and {c} not ilike '%train%'"

FCS_BOX = "claimtype <> 'OMPF' and boxOrigin = 'fcs' and boxSource = 'ro'"
VAULT_BOX = "RMN like '101%'"
OMPF_BOX = f"claimtype = 'OMPF' and insertdate >= {START}"

STAGES = """stages(step, place, stage) as (values
    (1, null, 'Capture'), (2, null, 'Enhance1'), (3, null, 'FOCR'), (4, null, 'Enhance2'),
    (5, null, 'Separation'), (6, null, 'ImageQC'), (7, null, 'AutoIndex'), (8, null, 'DocID'),
    (9, null, 'DocIDQC'), (10, null, 'Manual Index'), (11, null, 'Manual IndexQC'),
    (12, 64, 'Verification'), (13, -1, 'Export'))"""
AT_STAGE = ("stages on step = WFStep and (place is null or place = BatchLocation "
            "or (place = -1 and BatchLocation <> 0))")
CODES = """codes(code, word) as (values
    (1, 'Ready'), (2, 'In Process'), (4, 'Suspended'), (8, 'Auto-Fail'))"""


def boxes(condition: str) -> str:
    return f"""boxes as (
        select distinct rtrim(RMN) as RMN, trackingno as TrackingNo, claimtype
        from check_in where {SHIPPED} and {condition})"""


def master(box: str, batch: str, scanned: str = "scanner_stats", key: str = "kbatch") -> str:
    return f"""{boxes(box)},
    master as (
        select distinct b.RMN, b.TrackingNo, b.claimtype, p.PBatch as BatchName,
               p.BatchClassName, f.dcsid, s.{key} as ScannedBatchName, p.InvTime,
               e.kbatch as ExportedBatchName
        from boxes b
        join physical_batch p on p.RMN = b.RMN and p.InvTime >= {START} and {batch}
        left join folder_map f on f.PBatch = p.PBatch
        left join {scanned} s on s.{key} = p.PBatch
        left join exported e on e.kbatch = p.PBatch)"""


def records(columns: str, where: str, box: str | None) -> str:
    test = "" if box is None else (
        f" and RMN in (select rtrim(RMN) from check_in where {box})")
    return f"""records as (
        select {columns}, max(ftpstime) as uploaded
        from document where {where}{test} group by {columns})"""


FCS_MASTER = master(FCS_BOX, "p.PBatch like '02%'")
VAULT_MASTER = master(VAULT_BOX, "p.PBatch like '01%'")
OMPF_MASTER = master(OMPF_BOX, NOT_TEST.format(c="p.PBatch"), "audit", "batchname")
FIRST_BOX = "claimtype = 'OMPF'"
FIRST_MASTER = master(FIRST_BOX, "true")
FIRST_RECORDS = records("RMN, PBatch, dcsid, ImageID", f"ImageDateTime > {START}", FIRST_BOX)
FCS_RECORDS = records("RMN, PBatch, dcsid", f"ImageDateTime > {START} and PBatch like '02%'",
                      FCS_BOX)
VAULT_RECORDS = records("PBatch, dcsid", f"ImageDateTime > {START} and PBatch like '01%'", None)
OMPF_RECORDS = records("RMN, PBatch, dcsid, ImageID", f"ImageDateTime >= {START}", OMPF_BOX)

_COUNTED = """counted as (
    select m.RMN, m.TrackingNo, min(m.claimtype) as ClaimType,
           count(distinct m.BatchName) as batches, count(distinct m.dcsid) as folders,
           count(distinct m.ExportedBatchName) as exported_batches,
           count(distinct r.PBatch) as uploaded_batches,
           count(distinct r.dcsid) as uploaded_folders
    from master m left join records r on r.PBatch = m.BatchName
    group by m.RMN, m.TrackingNo)"""
_TOTALS = """batches as TotalBatches, folders as TotalDCSIDs,
    batches - exported_batches as "InProgress(Batches)",
    exported_batches as "Exported(Batches)", uploaded_batches as "Uploaded(Batches)",
    uploaded_folders as "Uploaded(DCSIDs)\""""


def claims_summary(master_sql: str, records_sql: str, where: str = "true") -> str:
    return f"""with {master_sql}, {records_sql}, {_COUNTED}
    select RMN, TrackingNo, ClaimType, {_TOTALS},
           case when batches = uploaded_batches then 'Completed' else 'Partial' end as "Status"
    from counted where {where}"""


def plain_summary(master_sql: str, records_sql: str, where: str = "true") -> str:
    return f"""with {master_sql}, {records_sql}, {_COUNTED}
    select RMN, TrackingNo, {_TOTALS} from counted where {where}"""


def open_rows(master_sql: str, records_sql: str, folders: bool) -> str:
    """Open batches, or open folders, with their raw status."""
    folder = "m.dcsid," if folders else ""
    keep = "dcsid," if folders else ""
    counts = "" if folders else """,
        case when BatchClassName <> 'SM' then folder_count else 0 end as paper,
        case when BatchClassName = 'SM' then folder_count else 0 end as special"""
    extra = "" if folders else ", paper, special"
    return f"""{master_sql}, {records_sql}, {STAGES}, {CODES},
    steps as (
        select distinct BatchName, WFStep, BatchLocation, BatchStatus, TotalImages
        from workflow),
    grouped as (
        select m.RMN, m.TrackingNo, m.BatchName, {folder} min(m.InvTime) as InvTime, WFStep,
               BatchLocation, ExportedBatchName, BatchStatus, w.BatchName as workflow_name,
               TotalImages, BatchClassName, count(distinct m.dcsid) as folder_count
        from master m left join steps w on w.BatchName = m.BatchName
        group by all),
    decoded as (
        select RMN, TrackingNo, BatchName, {keep} InvTime, stage,
               case when ExportedBatchName is not null then 'Exported'
                    when word is not null then word
                    when workflow_name is null then 'Pending OpenBox Import' end as status,
               TotalImages,
               case when BatchClassName = 'SM' then 'SM' else 'P' end as media{counts}
        from grouped left join {AT_STAGE} left join codes on code = BatchStatus),
    open_rows as (
        select RMN, TrackingNo, BatchName, {keep} stage, status, TotalImages, media{extra},
               min(InvTime) as InvTime
        from decoded d
        where not exists (select 1 from records r where r.PBatch = d.BatchName)
           or exists (select 1 from records r
                      where r.PBatch = d.BatchName and r.uploaded is null)
        group by all)"""


def aged(master_sql: str, records_sql: str, folders: bool) -> str:
    keep = 'dcsid as "DCSID",' if folders else ""
    extra = "" if folders else (
        ', paper as "Paper(DCSID Count)", special as "SpecialMedia(DCSID Count)"')
    return f"""with {open_rows(master_sql, records_sql, folders)},
    days as (
        select t.InvTime, count(c.calendardate) as free_days
        from (select distinct InvTime from open_rows) t
        left join calendar c
          on cast(c.calendardate as timestamp) between t.InvTime and {NOW}
         and (c.DayOfWeekName in ('Saturday', 'Sunday')
              or c.CalendarDateDescription is not null)
        group by t.InvTime)
    select distinct RMN, TrackingNo, o.BatchName, strftime(o.InvTime, '%Y-%m-%d') as InvTime,
           cast(trunc(date_diff('microsecond', o.InvTime, {NOW}) / cast(86400000000 as double)
                      - free_days) as integer) as "TAT(Days)",
           {keep} stage as "OpenBoxBatchLocation",
           case when status = 'Exported' then 'Pending Upload'
                when status = 'Pending OpenBox Import' and o.BatchName not in
                     (select BatchName from scanner) then 'Pending IBML Scan'
                else status end as "BatchStatus",
           TotalImages as "TotalImages(OpenBox)", media as "SpecialMedia/Paper"{extra}
    from open_rows o join days on days.InvTime = o.InvTime"""


_SECOND = """second_ocr as (
    select BatchName, TotalImages from ocr1 where BatchLocation <> 0
    union select BatchName, TotalImages from ocr2 where BatchLocation <> 0
    union select BatchName, TotalImages from ocr3 where BatchLocation <> 0
    union select BatchName, TotalImages from ocr4 where BatchLocation <> 0
    union select BatchName, TotalImages from ocr5 where BatchLocation <> 0)"""
_SECOND_STATUS = """case when two.BatchName is not null then 'WIP 2nd Job OCR'
                when status = 'Exported' then 'Pending Upload'
                when status = 'Pending OpenBox Import' and o.BatchName not in
                     (select BatchName from scanner) then 'Pending Scan'
                else status end as "BatchStatus",
           case when two.BatchName is not null then two.TotalImages else o.TotalImages end
               as "TotalImages(OpenBox)", media as "SpecialMedia/Paper\""""

OPEN_BATCHES = f"""with {open_rows(OMPF_MASTER, OMPF_RECORDS, False)}, {_SECOND}
    select distinct RMN, TrackingNo, o.BatchName, strftime(InvTime, '%Y-%m-%d') as "InvDate",
           coalesce(stage, '-') as "OpenBoxBatchLocation", {_SECOND_STATUS},
           paper as "Paper(DCSID Count)", special as "SpecialMedia(DCSID Count)"
    from open_rows o left join second_ocr two on two.BatchName = o.BatchName"""

OPEN_FOLDERS = f"""with {open_rows(OMPF_MASTER, OMPF_RECORDS, True)}, {_SECOND}
    select distinct RMN, TrackingNo, o.BatchName, strftime(InvTime, '%Y-%m-%d') as "InvDate",
           r.dcsid as "DCSID", stage as "OpenBoxBatchLocation", {_SECOND_STATUS}
    from open_rows o left join second_ocr two on two.BatchName = o.BatchName
    left join (select distinct dcsid from records) r on r.dcsid = o.dcsid"""

MASTER_FOLDERS = OPEN_FOLDERS.replace('r.dcsid as "DCSID"', 'o.dcsid as "DCSID"').replace(
    "left join (select distinct dcsid from records) r on r.dcsid = o.dcsid", "")


def open_first(folders: bool) -> str:
    """The first generation: no receipt day, no second job, folders as the master has them."""
    keep = 'o.dcsid as "DCSID",' if folders else ""
    extra = "" if folders else (
        ', paper as "Paper(DCSID Count)", special as "SpecialMedia(DCSID Count)"')
    return f"""with {open_rows(FIRST_MASTER, FIRST_RECORDS, folders)}
    select distinct RMN, TrackingNo, o.BatchName, {keep} stage as "OpenBoxBatchLocation",
           case when status = 'Exported' then 'Pending Upload'
                when status = 'Pending OpenBox Import' and o.BatchName not in
                     (select BatchName from scanner) then 'Pending IBML Scan'
                else status end as "BatchStatus",
           TotalImages as "TotalImages(OpenBox)", media as "SpecialMedia/Paper"{extra}
    from open_rows o"""


def or_blank(sql_text: str, columns: list[str]) -> str:
    """The rows as text, or one blank row."""
    names = ", ".join(f'cast("{c}" as varchar) as "{c}"' for c in columns)
    blanks = ", ".join(f"'' as \"{c}\"" for c in columns)
    return f"""with report as ({sql_text}) select {names} from report
    union all select {blanks} where not exists (select 1 from report)"""


TURNAROUND_PIVOT = f"""with report as ({OPEN_BATCHES})
    select RMN, TrackingNo, BatchName, "InvDate", "OpenBoxBatchLocation", "BatchStatus",
           coalesce(cast(avg("Paper(DCSID Count)") as varchar), '-') as "Paper(DCSID Count)",
           coalesce(cast(avg("SpecialMedia(DCSID Count)") as varchar), '-')
               as "SpecialMedia(DCSID Count)",
           coalesce(cast(avg("TotalImages(OpenBox)") as varchar), '-') as "TotalImages(OpenBox)"
    from report
    where RMN is not null and TrackingNo is not null and BatchName is not null
      and "InvDate" is not null and "OpenBoxBatchLocation" is not null
      and "BatchStatus" is not null
    group by RMN, TrackingNo, BatchName, "InvDate", "OpenBoxBatchLocation", "BatchStatus\""""

_DIRECT = f"""direct as (
    select distinct rtrim(c.RMN) as RMN, c.trackingno as TrackingNo, p.PBatch as BatchName
    from check_in c join physical_batch p on p.RMN = rtrim(c.RMN)
    where c.claimtype = 'OMPF' and p.PBatch like '02%' and p.InvTime >= {START}
      and {SHIPPED.replace('trackingno', 'c.trackingno')})"""

DIRECT_SUMMARY = f"""with {_DIRECT}
    select direct.RMN, TrackingNo, count(distinct BatchName) as Batches,
           count(distinct BatchName) - count(distinct kbatch) as InProgress,
           count(distinct kbatch) as Exported,
           count(distinct case when ftpstime is not null then PBatch end) as Uploaded
    from direct left join exported on kbatch = BatchName
    left join document d on d.PBatch = BatchName
    group by direct.RMN, TrackingNo"""

DIRECT_OUTSTANDING = f"""with {_DIRECT}, {STAGES}, {CODES},
    waiting as (
        select direct.RMN, TrackingNo, BatchName, count(distinct ImageID) as docs
        from direct left join document d on d.PBatch = BatchName
        where ftpstime is null
        group by direct.RMN, TrackingNo, BatchName)
    select distinct RMN, TrackingNo, x.BatchName, stage as "OpenBoxBatchLocation",
           case when kbatch is not null then 'Exported [' || cast(docs as varchar) || ' of '
                     || cast(docs as varchar) || ' doc(s) pending upload]'
                when word is not null then word
                when w.BatchName is null and i.BatchName is null then 'Pending IBML Scan'
                when w.BatchName is null then 'Pending OpenBox Import' end as "BatchStatus",
           TotalImages
    from waiting x
    left join exported on kbatch = x.BatchName
    left join workflow w on w.BatchName = x.BatchName
    left join {AT_STAGE} left join codes on code = BatchStatus
    left join scanner i on i.BatchName = x.BatchName"""

_LINES = ("FCS", "OMPF", "RMC")


def per_day(low: str, high: str, dedupe: bool = True) -> str:
    """Docs and images per day, from rows per day, batch and box."""
    sums = ", ".join(
        f"""coalesce(sum({col}) filter (where line = '{line}'), 0) as "{line} {name}\""""
        for line in _LINES for col, name in (("docs", "Docs"), ("images", "Images")))
    return f"""per_box as (
        select cast(ftpstime as date) as day, PBatch, RMN,
               case when PBatch like '02%' and RMN in
                         (select rtrim(RMN) from check_in where claimtype = 'OMPF') then 'OMPF'
                    when PBatch like '02%' then 'FCS'
                    when PBatch like '01%' then 'RMC' end as line,
               count(distinct ImageID) as docs, sum(NumPages) as images
        from document where ftpstime >= timestamp '{low}' and ftpstime < timestamp '{high}'
        group by day, PBatch, RMN),
    per_day as (
        select day, {sums}
        from (select {'distinct' if dedupe else ''} day, PBatch, line, docs, images
              from per_box)
        group by day)"""


def _named_sums(names: list[str]) -> str:
    return ", ".join(f'cast(sum("{n}") as bigint) as "{n}"' for n in names)


_MEASURES = [f"{line} {what}" for line in _LINES for what in ("Docs", "Images")]


def monthly(low: str, high: str, dedupe: bool = True) -> str:
    return f"""with {per_day(low, high, dedupe)}
    select strftime(day, '%m/%d/%Y') as "UploadDate", {_named_sums(_MEASURES)}
    from per_day group by day
    union all
    select 'Total', {_named_sums(_MEASURES)} from per_day having count(*) > 0"""


def monthly_two_sites(low: str, high: str) -> str:
    both = _MEASURES + ["London Docs", "London Images"]
    return f"""with {per_day(low, high)},
    two_sites as (
        select per_day.*, coalesce(s.docs, 0) as "London Docs",
               coalesce(s.images, 0) as "London Images"
        from per_day left join second_site s on s.UploadDate = per_day.day)
    select strftime(day, '%m/%d/%Y') as "UploadDate", {_named_sums(both)}
    from two_sites group by day
    union all
    select 'Total', {_named_sums(both)} from two_sites having count(*) > 0"""


_INVENTORY = (("Capture", "WFStep = 1"), ("Enhance1", "WFStep = 2"),
              ("FullPageOCR", "WFStep = 3"), ("Enhance2", "WFStep = 4"),
              ("Separation", "WFStep = 5"), ("ImageQC", "WFStep = 6"),
              ("AutoIndex", "WFStep = 7"), ("DocID", "WFStep = 8"), ("DocIDQC", "WFStep = 9"),
              ("ManualIndex", "WFStep = 10"),
              ("Verification", "WFStep = 12 and BatchLocation = 64"),
              ("Export", "WFStep = 13 and BatchLocation = 256"),
              ("Clean", "WFStep = 13 and BatchLocation = 0"))


def image_inventory(dedupe: bool = True) -> str:
    cases = ", ".join(
        f"case when {cond} then images else 0 end as {name}" for name, cond in _INVENTORY)
    names = ", ".join(f"cast(sum({name}) as bigint) as {name}" for name, _ in _INVENTORY)
    any_stage = " or ".join(f"({cond})" for _, cond in _INVENTORY)
    hidden = "" if dedupe else ", WFStep, BatchLocation"
    return f"""with received as (
        select distinct cast(InvTime as date) as day, PBatch as BatchName
        from physical_batch
        where PBatch like '02%' and InvTime >= {START}
          and RMN in (select rtrim(RMN) from check_in where claimtype = 'OMPF')),
    sums as (
        select day, WFStep, BatchLocation, sum(TotalImages) as images
        from received join workflow using (BatchName)
        where TotalImages is not null and ({any_stage}) and jobid = 8
          and {NOT_TEST.format(c='BatchName')}
        group by day, WFStep, BatchLocation),
    wide as (select distinct day, images, {cases}{hidden} from sums)
    select strftime(day, '%m/%d/%Y') as CheckInDate,
           cast(sum(images) as bigint) as ImageCount, {names}
    from wide group by day"""


BOX_INVENTORY = f"""with first_day as (
        select RMN, min(InvTime) as first_time from physical_batch
        where InvTime >= {START} and PBatch like '02%'
          and RMN in (select rtrim(RMN) from check_in where {OMPF_BOX})
        group by RMN),
    states as (
        select f.RMN, f.first_time, count(distinct p.PBatch) as total,
               count(distinct d.PBatch) as uploaded
        from first_day f join physical_batch p on p.RMN = f.RMN
        left join document d on d.PBatch = p.PBatch and d.ftpstime is not null
        group by f.RMN, f.first_time)
    select strftime(first_time, '%m/%d/%Y') as CheckInDate, count(distinct RMN) as BoxCount,
           count(distinct case when total <> uploaded then RMN end) as ACTIVE,
           count(distinct case when total = uploaded then RMN end) as COMPLETED
    from states group by 1"""

VERIFICATION = """
    select distinct p.RMN, w.BatchName, w.TotalImages as "TotalImages(OpenBox)",
           'Verification/BVTI' as TSModule,
           case BatchStatus when 0 then 'Error' when 1 then 'Ready' when 2 then 'In Process'
                when 4 then 'Suspended' when 8 then 'Auto-Fail' end as Status, c.boxSource
    from workflow w join physical_batch p on p.PBatch = w.BatchName
    join check_in c on rtrim(c.RMN) = p.RMN
    where WFStep = 12 and BatchLocation = 64"""

_FEED_BATCH = "substr({c}, 1, 2) in ('01', '02', '07', '08')"
_SPAN = {
    "closed": "ftpstime > timestamp '2001-05-01' and ftpstime < timestamp '2001-06-01'",
    "open": "ftpstime > timestamp '2001-05-01'",
}


def _job(box: str) -> str:
    return f"""case substr(d.PBatch, 1, 2)
        when '01' then case when {box} like '101%' then 'VAULT' else 'RMC' end
        when '02' then case when claimtype = 'OMPF' then 'OMPF'
                            when claimtype is not null then 'FCS' end
        when '07' then 'BWN' when '08' then 'REA' end"""


def feed(span: str | None = "closed") -> str:
    left_out = "" if span is None else f"""
          and SysKey not in (select SysKey from document
              where {_SPAN[span]} and dcsid in (select dcs from excluded_folders))"""

    def rows(box: str, name: str, images: str, docs: str, n_boxes: int) -> str:
        return f"""select strftime(Received, '%m/%d/%Y') as "Received", 'VA' as "CustomerName",
            {_job(box)} as "JobName", 'OpenBox' as "ProcessType", {name} as "BatchName",
            'COMPLETED' as "Status", cast({images} as bigint) as "ImageCount",
            cast({docs} as bigint) as "DocCount", 'MTV' as "SiteName",
            strftime(d.day, '%m/%d/%Y') as "CompleteDate", 'Public Sector' as "Vertical",
            'NA' as "Region", 'US' as "Country", 'NA' as "BillType",
            'Upload' as "Sub-Process", {n_boxes} as "Boxes", 0 as "Characters"
        from done d join received p on p.PBatch = d.PBatch"""

    return f"""with done as (
        select PBatch, RMN, cast(ftpstime as date) as day, sum(NumPages) as pages,
               count(distinct ImageID) as docs
        from document
        where ftpstime >= {START} and {_FEED_BATCH.format(c='PBatch')}{left_out}
        group by PBatch, RMN, day),
    received as (
        select distinct p.PBatch, p.RMN, cast(p.InvTime as date) as Received, c.claimtype
        from physical_batch p left join check_in c on rtrim(c.RMN) = p.RMN
        where {_FEED_BATCH.format(c='p.PBatch')} and p.InvTime >= {START})
    {rows('p.RMN', 'd.PBatch', 'pages', 'docs', 0)}
    union
    {rows('d.RMN', 'd.RMN', '0', '0', 1)}"""


_REVIEW = """yesterday as (
    select * from document
    where ftpstime >= timestamp '2001-06-14' and ftpstime < timestamp '2001-06-15'),
    review as (
    select distinct d.RMN, d.dcsid as "dcsID", d.ImageID,
           strftime(d.ImageDateTime, '%Y-%m-%d') as "PDF Created",
           d.NumPages as "Image Count Per PDF", p.Firstname, p.Lastname,
           d.FileNumber as raw_number, d.docidDoctype as "DocType",
           p.Recvdate as "Date of Receipt", c.claimtype
    from yesterday d
    left join customer_data p on p.dcsid = d.dcsid and p.PBatch = d.PBatch
    left join check_in c on rtrim(c.RMN) = d.RMN)"""

MASKED_REVIEW = f"""with {_REVIEW}
    select RMN, "dcsID", ImageID, "PDF Created", "Image Count Per PDF",
           left(Firstname, 1) || '*** ' || left(Lastname, 1) || '***' as "Veteran Name",
           '********' || nullif(right(trim(raw_number), 1), '') as "FileNumber",
           "DocType", "Date of Receipt", claimtype
    from review"""


def cleared_review(unmatched: bool = False) -> str:
    more = " union all select 'no such batch'" if unmatched else ""
    return f"""with {_REVIEW}
    select distinct RMN, "dcsID", ImageID, "PDF Created", "Image Count Per PDF", "DocType",
           "Date of Receipt", claimtype
    from review
    where RMN not in (select p.RMN from (select batchname from qa_exceptions{more}) q
                      left join physical_batch p on p.PBatch = q.batchname)"""


DAILY_COMPLETED = """
    select 'RMNs Uploaded by GDIT' as "Status", count(*) as "Total" from boxes_done
    where CompleteDate >= timestamp '2001-06-14' and CompleteDate < timestamp '2001-06-15'
    union
    select 'DCSIDs Uploaded by GDIT', count(*) from folders_done
    where CompleteDate >= timestamp '2001-06-14' and CompleteDate < timestamp '2001-06-15'"""
