"""Role tables as common table expressions, for the comparison SQL only."""

from __future__ import annotations

import re

_BOX = "case when {k} % 10 = 0 then '101' else '200' end || lpad(cast({k} as varchar), 9, '0')"
_BATCH = (
    "case when {o} % 8 < 2 then '01' when {o} % 8 < 6 then '02' when {o} % 8 = 6 then '07' "
    "else '08' end || lpad(cast({o} as varchar), 12, '0') "
    "|| case when {o} % 97 = 0 then 'TEST' else '' end"
)
BOX = _BOX.format(k="o_custkey")
BATCH = _BATCH.format(o="o_orderkey")
_EARLIER = _BATCH.format(o="(o_orderkey - 8)")
_NEXT_BOX = _BOX.format(k="(o_custkey + 1)")
_FOLDER = "cast(l_orderkey as varchar) || '-' || cast(l_linenumber % 3 as varchar)"
_RECEIVED = "o_orderdate + (o_orderkey % 24) * interval '1' hour"
_LINES = "lineitem join orders on l_orderkey = o_orderkey"


def _orders_where(condition: str, name: str) -> str:
    return f"select {BATCH} as {name} from orders where {condition}"


def _ocr(rest: int) -> str:
    return (
        f"select {BATCH} as BatchName, cast(floor(o_totalprice / 500) as integer) as TotalImages, "
        "cast(o_custkey % 4 as integer) as BatchLocation from orders "
        f"where o_orderkey % 29 = 0 and (o_orderkey % 5 = {rest} "
        f"or o_orderkey % 2 = 0 and (o_orderkey + 1) % 5 = {rest})"
    )


ROLE_SQL = {
    "check_in": f"""
        with boxes as (
        select c_custkey, {_BOX.format(k='c_custkey')} as RMN,
               case when c_custkey % 17 = 0 then null when c_custkey % 19 = 0 then ''
                    when c_custkey % 23 = 0 then '1234DUMMY1234' else c_name end as trackingno,
               case c_mktsegment when 'BUILDING' then 'OMPF' when 'MACHINERY' then null
                    else upper(c_mktsegment) end as claimtype,
               case when c_nationkey % 2 = 0 then 'fcs' else 'other' end as boxOrigin,
               case when c_nationkey % 3 = 0 then 'other' else 'ro' end as boxSource,
               cast(date '1995-01-01' + cast(c_custkey % 1000 as integer) as timestamp)
                   as insertdate
        from customer)
        select * exclude (c_custkey) from boxes
        union all select RMN, trackingno, case when claimtype = 'OMPF' then 'AUTOMOBILE'
                         else 'OMPF' end, boxOrigin, boxSource, insertdate
        from boxes where c_custkey % 43 = 0""",
    "physical_batch": f"""
        with batches as (
        select o_orderkey, o_custkey, {BATCH} as PBatch, {BOX} as RMN,
               case o_orderpriority when '1-URGENT' then 'SM' when '5-LOW' then null
                    else 'P' end as BatchClassName,
               {_RECEIVED} as InvTime
        from orders)
        select PBatch, RMN, BatchClassName, InvTime from batches
        union all select PBatch, {_NEXT_BOX}, BatchClassName, InvTime from batches
        where o_orderkey % 41 = 0
        union all select PBatch, RMN, BatchClassName, InvTime + interval '3' day from batches
        where o_orderkey % 47 = 0
        union all select PBatch || 'N', RMN, BatchClassName, InvTime from batches
        where o_orderkey % 59 = 0""",
    "document": f"""
        with documents as (
        select o_orderkey, o_custkey, {BOX} as RMN, {BATCH} as PBatch, {_FOLDER} as dcsid,
               cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as ImageID,
               l_returnflag as docidDoctype,
               ' ' || cast(l_partkey as varchar) || '  ' as FileNumber,
               l_orderkey * 10 + l_linenumber as SysKey,
               cast(l_quantity as integer) as NumPages,
               case when l_linestatus = 'F' then l_shipdate end as ftpstime,
               l_shipdate - interval '1' day as ImageDateTime
        from {_LINES})
        select * exclude (o_orderkey, o_custkey) from documents
        union all select * exclude (o_orderkey, o_custkey) replace (
            {_EARLIER} as PBatch, SysKey + 10000000000 as SysKey)
        from documents where o_orderkey % 37 = 0
        union all select * exclude (o_orderkey, o_custkey) replace (
            {_NEXT_BOX} as RMN, SysKey + 20000000000 as SysKey)
        from documents where o_orderkey % 39 = 0""",
    "folder_map": f"""
        select {BOX} as RMN, {BATCH} as PBatch, {_FOLDER} as dcsid, {_RECEIVED} as InvTime
        from {_LINES}
        union select {BOX}, {_EARLIER}, {_FOLDER}, {_RECEIVED}
        from {_LINES} where o_orderkey % 37 = 0
        union select {BOX}, {BATCH} || 'N', cast(o_orderkey as varchar) || '-9', {_RECEIVED}
        from orders where o_orderkey % 59 = 0""",
    "customer_data": f"""
        select distinct {_FOLDER} || case when o_orderkey % 7 = 0 then 'x' else '' end as dcsid,
               {BATCH} as PBatch, p_name as Firstname, p_brand as Lastname,
               o_orderdate as Recvdate
        from {_LINES} join part on l_partkey = p_partkey""",
    "workflow": f"""
        with steps as (
        select o_orderkey, {BATCH} as BatchName, cast(o_orderkey % 13 + 1 as integer) as WFStep,
               case o_orderkey % 13 + 1
                    when 1 then 1 when 2 then 2 when 3 then 16 when 4 then 2 when 5 then 4
                    when 6 then 128 when 7 then 8 when 8 then 128 when 9 then 128
                    when 10 then 32 when 11 then 32 when 12 then 64
                    else case when o_custkey % 2 = 0 then 256 else 0 end end as BatchLocation,
               case o_orderkey % 5 when 0 then 0 when 1 then 1 when 2 then 2 when 3 then 4
                    else 8 end as BatchStatus,
               cast(floor(o_totalprice / 1000) as integer) as TotalImages,
               case when o_custkey % 3 = 0 then 9 else 8 end as jobid
        from orders where o_orderkey % 11 <> 0)
        select * exclude (o_orderkey) from steps
        union all select * exclude (o_orderkey) replace (BatchLocation + 512 as BatchLocation)
        from steps where o_orderkey % 53 = 0 and WFStep <= 11""",
    "scanner": _orders_where("o_orderkey % 22 = 0", "BatchName"),
    "exported": _orders_where("o_orderstatus = 'F'", "kbatch"),
    "scanner_stats": _orders_where("o_orderstatus in ('F', 'P')", "kbatch"),
    "audit": _orders_where("o_orderstatus in ('F', 'P')", "batchname"),
    "ocr1": _ocr(1),
    "ocr2": _ocr(2),
    "ocr3": _ocr(3),
    "ocr4": _ocr(4),
    "ocr5": _ocr(0),
    "calendar": """
        select calendardate,
               case date_diff('day', date '1995-01-01', calendardate) % 7
                    when 0 then 'Sunday' when 1 then 'Monday' when 2 then 'Tuesday'
                    when 3 then 'Wednesday' when 4 then 'Thursday' when 5 then 'Friday'
                    else 'Saturday' end as DayOfWeekName,
               case strftime(calendardate, '%m-%d') when '01-01' then 'New Year'
                    when '07-04' then 'Independence Day' when '12-25' then 'Christmas Day'
                    end as CalendarDateDescription
        from (select distinct cast(o_orderdate as date) as calendardate from orders)""",
    "second_site": """
        select cast(l_shipdate as date) as UploadDate, count(*) as docs,
               cast(sum(l_quantity) as bigint) as images
        from lineitem where l_suppkey % 10 = 0 group by 1""",
    "qa_exceptions": _orders_where("o_orderkey % 101 = 0", "batchname"),
    "excluded_folders": """
        select distinct dcsid as dcs from document where dcsid like '5%'""",
    "boxes_done": "select RMN, max(ftpstime) as CompleteDate from document group by RMN",
    "folders_done": "select dcsid, max(ftpstime) as CompleteDate from document group by dcsid",
}
# Role tables defined on top of another one.
_NEEDS = {"excluded_folders": "document", "boxes_done": "document", "folders_done": "document"}


def with_roles(sql: str) -> str:
    """Put the role tables that ``sql`` mentions in front of it."""
    words = set(re.findall(r"[A-Za-z_0-9]+", sql))
    used = [r for r in ROLE_SQL if r in words or any(
        need == r and role in words for role, need in _NEEDS.items())]
    if not used:
        return sql.strip()
    ctes = ",\n".join(f"{role} as ({ROLE_SQL[role].strip()})" for role in used)
    body = sql.strip()
    if re.match(r"with\b", body, re.IGNORECASE):
        return f"with {ctes},\n{body[4:].strip()}"
    return f"with {ctes}\n{body}"
