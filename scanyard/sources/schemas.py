"""Declared schemas: nothing is inferred when tables are read."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Role tables of the intake hierarchy:
# document -> folder (dcsid) -> batch (PBatch) -> box (RMN) -> shipment (trackingno).
ROLE_SCHEMAS = {
    "check_in": "RMN string, trackingno string, claimtype string, boxOrigin string, "
                "boxSource string, insertdate timestamp_ntz",
    "physical_batch": "PBatch string, RMN string, BatchClassName string, InvTime timestamp_ntz",
    "folder_map": "RMN string, PBatch string, dcsid string, InvTime timestamp_ntz",
    "document": "RMN string, PBatch string, dcsid string, ImageID string, docidDoctype string, "
                "FileNumber string, SysKey bigint, NumPages int, ftpstime timestamp_ntz, "
                "ImageDateTime timestamp_ntz",
    "customer_data": "dcsid string, PBatch string, Firstname string, Lastname string, "
                     "Recvdate timestamp_ntz",
    "workflow": "BatchName string, WFStep int, BatchLocation int, BatchStatus int, "
                "TotalImages int, jobid int",
    "scanner": "BatchName string",
    "exported": "kbatch string",
    "scanner_stats": "kbatch string",
    "audit": "batchname string",
    "ocr1": "BatchName string, TotalImages int, BatchLocation int",
    "ocr2": "BatchName string, TotalImages int, BatchLocation int",
    "ocr3": "BatchName string, TotalImages int, BatchLocation int",
    "ocr4": "BatchName string, TotalImages int, BatchLocation int",
    "ocr5": "BatchName string, TotalImages int, BatchLocation int",
    "calendar": "calendardate date, DayOfWeekName string, CalendarDateDescription string",
    "second_site": "UploadDate date, docs bigint, images bigint",
    "qa_exceptions": "batchname string",
    "excluded_folders": "dcs string",
    "boxes_done": "RMN string, CompleteDate timestamp_ntz",
    "folders_done": "dcsid string, CompleteDate timestamp_ntz",
}

# Columns compared as keys: stored with or without trailing blanks, compared without.
KEY_COLUMNS = ("RMN", "PBatch", "dcsid", "BatchName", "batchname", "kbatch", "dcs")
CODE_COLUMNS = ("claimtype",)

# Columns by which stored documents are kept apart.
DOCUMENT_MONTHS = "upload_month date, image_month date"
# Day of receipt beside the time in stored tables: Parquet skips rows by days, not by zone-free times.
RECEIVED_DAY = "received_day date"
# The image month of documents without an image time.
NO_MONTH = date(1900, 1, 1)


def image_month() -> Column:
    return F.coalesce(F.trunc(F.to_date("ImageDateTime"), "MM"), F.lit(NO_MONTH))


# Star-schema tables the role tables can be derived from.
STAR_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
}
