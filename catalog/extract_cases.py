"""Shared extracts (E1 to E7)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from catalog import report_sql as sql
from catalog.registry import AS_OF, START, case
from scanyard.functions.dates import ts, us_date
from scanyard.plans import extracts, kept, outstanding
from scanyard.plans.config import FCS, OMPF, OMPF_FIRST, VAULT
from scanyard.session import shared_dir
from scanyard.sources.buckets import load_bucketed, store_bucketed

FCS_T, VAULT_T = FCS.starting(START), VAULT.starting(START)
OMPF_T, FIRST_T = OMPF.starting(START), OMPF_FIRST.starting(START)
_FIRST_MASTER = sql.master("claimtype = 'OMPF'", "true")


@case("e01_intake_master_fcs", f"with {sql.FCS_MASTER} select * from master")
def _(roles):
    return extracts.intake_master(roles, FCS_T)


@case("e01_intake_master_vault", f"with {sql.VAULT_MASTER} select * from master")
def _(roles):
    return extracts.intake_master(roles, VAULT_T)


@case("e01_intake_master_ompf",
      f"with {sql.OMPF_MASTER} select * exclude (claimtype) from master")
def _(roles):
    return extracts.intake_master(roles, OMPF_T)


@case("e01_intake_master_ompf_first",
      f"with {_FIRST_MASTER} select * exclude (claimtype) from master")
def _(roles):
    return extracts.intake_master(roles, FIRST_T)


def _uploads(roles, line):
    records = extracts.upload_records(roles, line)
    return records.withColumn("uploaded", us_date(records["UploadTime"])).drop("UploadTime")


def _uploads_sql(records: str) -> str:
    return f"""with {records} select * replace (strftime(uploaded, '%m/%d/%Y') as uploaded)
        from records"""


@case("e02_upload_records_fcs", _uploads_sql(sql.FCS_RECORDS))
def _(roles):
    return _uploads(roles, FCS_T)


@case("e02_upload_records_vault", _uploads_sql(sql.VAULT_RECORDS))
def _(roles):
    return _uploads(roles, VAULT_T)


@case("e02_upload_records_ompf", _uploads_sql(sql.OMPF_RECORDS))
def _(roles):
    return _uploads(roles, OMPF_T)


# A first run knew the documents up to here; later uploads were not done.
CUT = datetime(1997, 3, 10, 12)


def kept_tables(roles):
    """Upload records kept by a run at ``CUT`` and brought up to date by one at ``AS_OF``."""
    documents, cut = roles["document"], ts(CUT)
    uploaded = F.when(F.col("ftpstime") < cut, F.col("ftpstime"))
    base = shared_dir(documents.sparkSession)
    kept.refresh(documents.where(F.col("ImageDateTime") < cut).withColumn("ftpstime", uploaded),
                 base, CUT)
    kept.refresh(documents, base, AS_OF)
    return kept.with_kept(roles, base)


@case("e02_kept_records_fcs", _uploads_sql(sql.FCS_RECORDS))
def _(roles):
    return _uploads(kept_tables(roles), FCS_T)


@case("e02_kept_records_ompf", _uploads_sql(sql.OMPF_RECORDS))
def _(roles):
    return _uploads(kept_tables(roles), OMPF_T)


@case("r02_outstanding_batches_kept", sql.aged(sql.FCS_MASTER, sql.FCS_RECORDS, folders=False))
def _(roles):
    return outstanding.r02_outstanding_batches(kept_tables(roles), FCS_T, AS_OF)


@case("r06_open_batches_kept", sql.OPEN_BATCHES)
def _(roles):
    return outstanding.r06_open_batches(kept_tables(roles), OMPF_T)


def bucketed_tables(roles, rows=25):
    """Documents and folders bucketed by batch; batches of more than a few rows are cut."""
    spark = roles["document"].sparkSession
    base, number = shared_dir(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    store_bucketed(roles, base, number, rows)
    return load_bucketed(spark, base, number, roles)


@case("e01_intake_master_bucketed", f"with {sql.FCS_MASTER} select * from master")
def _(roles):
    return extracts.intake_master(bucketed_tables(roles, rows=3), FCS_T)


@case("e02_upload_records_bucketed", _uploads_sql(sql.OMPF_RECORDS))
def _(roles):
    return _uploads(bucketed_tables(roles), OMPF_T)


@case("e03_active_folders", f"""
    select distinct f.RMN, f.PBatch, f.dcsid, p.BatchClassName
    from folder_map f left join physical_batch p on p.PBatch = f.PBatch
    where f.PBatch like '02%' and f.InvTime >= {sql.START}
      and f.RMN in (select rtrim(RMN) from check_in where {sql.FCS_BOX})""")
def _(roles):
    return extracts.active_folders(roles, FCS_T, "02", folder_since=START)


@case("e03_active_folders_by_batch", f"""
    select distinct f.RMN, f.PBatch, f.dcsid, p.BatchClassName
    from folder_map f join physical_batch p on p.PBatch = f.PBatch
    where f.PBatch like '02%' and p.InvTime >= timestamp '2000-01-01'
      and f.RMN in (select rtrim(RMN) from check_in where {sql.OMPF_BOX})""")
def _(roles):
    return extracts.active_folders(roles, OMPF_T, "02", batch_since=START.replace(year=2000))


@case("e04_workflow_state_fcs", f"""
    select distinct BatchName, WFStep, BatchLocation, BatchStatus, TotalImages
    from workflow join physical_batch p on p.PBatch = BatchName
    where PBatch like '02%'
      and p.RMN in (select rtrim(RMN) from check_in where {sql.FCS_BOX})""")
def _(roles):
    return extracts.workflow_state(roles, FCS_T)


@case("e04_workflow_state_ompf", f"""
    select BatchName, WFStep, BatchLocation, BatchStatus, TotalImages, max(InvTime) as InvTime
    from workflow join physical_batch p on p.PBatch = BatchName
    where {sql.NOT_TEST.format(c='BatchName')}
      and p.RMN in (select rtrim(RMN) from check_in where {sql.OMPF_BOX})
    group by BatchName, WFStep, BatchLocation, BatchStatus, TotalImages
    having max(InvTime) >= {sql.START}""")
def _(roles):
    return extracts.workflow_state(roles, OMPF_T)


@case("e05_scanned_batches", "select distinct BatchName from scanner")
def _(roles):
    return extracts.scanned_batches(roles)


@case("e06_second_ocr", """
    select distinct BatchName, TotalImages from (
        from ocr1 union all from ocr2 union all from ocr3 union all from ocr4
        union all from ocr5) where BatchLocation <> 0""")
def _(roles):
    return extracts.second_ocr(roles)


@case("e07_nonworking_calendar", """
    select * from calendar
    where DayOfWeekName in ('Saturday', 'Sunday') or CalendarDateDescription is not null""")
def _(roles):
    return extracts.nonworking_calendar(roles)
