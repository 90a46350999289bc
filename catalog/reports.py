"""The report pipelines R1 to R21 on the test tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from catalog import report_sql as sql
from catalog.registry import AS_OF, START, case, table_case
from scanyard import fixed
from scanyard.plans import feed, inventory, monthly, outstanding, queue, review, summary
from scanyard.plans.config import (BOX_INVENTORY, FCS, IMAGE_INVENTORY, OMPF, OMPF_DIRECT,
                                   OMPF_FIRST, VAULT, Feed)
from scanyard.session import shared_dir
from scanyard.sources.tables import materialize, own_name, scan

FCS_T, VAULT_T, OMPF_T = (line.starting(START) for line in (FCS, VAULT, OMPF))
DIRECT_T, FIRST_T = OMPF_DIRECT.starting(START), OMPF_FIRST.starting(START)
FEED_T = Feed(START, START, datetime(2001, 5, 1), datetime(2001, 6, 1))


@case("r01_box_summary", sql.claims_summary(sql.FCS_MASTER, sql.FCS_RECORDS))
def _(roles):
    return summary.r01_box_summary(roles, FCS_T)


@case("r02_outstanding_batches", sql.aged(sql.FCS_MASTER, sql.FCS_RECORDS, folders=False))
def _(roles):
    return outstanding.r02_outstanding_batches(roles, FCS_T, AS_OF)


@case("r03_outstanding_folders", sql.aged(sql.FCS_MASTER, sql.FCS_RECORDS, folders=True))
def _(roles):
    return outstanding.r03_outstanding_folders(roles, FCS_T, AS_OF)


@case("r04_vault_summary", sql.claims_summary(
    sql.VAULT_MASTER, sql.VAULT_RECORDS, "batches <> uploaded_batches"))
def _(roles):
    return summary.r04_vault_summary(roles, VAULT_T)


@case("r04_vault_batches", sql.aged(sql.VAULT_MASTER, sql.VAULT_RECORDS, folders=False))
def _(roles):
    return outstanding.r04_vault_batches(roles, VAULT_T, AS_OF)


@case("r04_vault_folders", sql.aged(sql.VAULT_MASTER, sql.VAULT_RECORDS, folders=True))
def _(roles):
    return outstanding.r04_vault_folders(roles, VAULT_T, AS_OF)


@case("r05_box_summary", sql.plain_summary(sql.OMPF_MASTER, sql.OMPF_RECORDS))
def _(roles):
    return summary.r05_box_summary(roles, OMPF_T)


@case("r05_box_summary_unfinished", sql.plain_summary(
    sql.OMPF_MASTER, sql.OMPF_RECORDS,
    "batches <> uploaded_batches and folders <> uploaded_folders"))
def _(roles):
    return summary.r05_box_summary(roles, OMPF_T, only_unfinished=True)


@case("r06_open_batches", sql.OPEN_BATCHES)
def _(roles):
    return outstanding.r06_open_batches(roles, OMPF_T)


@case("r07_open_folders", sql.OPEN_FOLDERS)
def _(roles):
    return outstanding.r07_open_folders(roles, OMPF_T)


@case("r05_first", sql.plain_summary(sql.FIRST_MASTER, sql.FIRST_RECORDS))
def _(roles):
    return summary.r05_box_summary(roles, FIRST_T)


@case("r06_first", sql.open_first(folders=False))
def _(roles):
    return outstanding.r06_open_batches(roles, FIRST_T)


@case("r07_first", sql.open_first(folders=True))
def _(roles):
    return outstanding.r07_open_folders(roles, FIRST_T)


@case("r07_master_folder", sql.MASTER_FOLDERS)
def _(roles):
    return outstanding.r07_open_folders(roles, replace(OMPF_T, recorded_folder=False))


@case("r06_placeholder", sql.or_blank(sql.OPEN_BATCHES, list(fixed.OPEN_BATCH_HEADER)))
def _(roles):
    return outstanding.r06_open_batches(roles, OMPF_T, placeholder=True)


@case("r07_placeholder", sql.or_blank(sql.OPEN_FOLDERS, list(fixed.OPEN_FOLDER_HEADER)))
def _(roles):
    return outstanding.r07_open_folders(roles, OMPF_T, placeholder=True)


@case("r08_turnaround_pivot", sql.TURNAROUND_PIVOT)
def _(roles):
    return outstanding.r08_turnaround_pivot(roles, OMPF_T)


@case("r09_direct_summary", sql.DIRECT_SUMMARY)
def _(roles):
    return summary.r09_direct_summary(roles, DIRECT_T)


@case("r10_direct_outstanding", sql.DIRECT_OUTSTANDING)
def _(roles):
    return outstanding.r10_direct_outstanding(roles, DIRECT_T)


@case("r11_monthly_totals", sql.monthly("2001-06-01", "2001-06-15"))
def _(roles):
    return monthly.r11_monthly_totals(roles, as_of=AS_OF)


@case("r11_guaranteed_total", sql.monthly("2001-05-01", "2001-06-01"))
def _(roles):
    return monthly.r11_monthly_totals(roles, as_of=AS_OF, previous_month=True, always_total=True)


@case("r11_guaranteed_total_first_of_month", sql.monthly("2001-06-01", "2001-06-01").replace(
    " having count(*) > 0", ""))
def _(roles):
    """No day has passed yet; the total is there all the same."""
    return monthly.r11_monthly_totals(roles, as_of=AS_OF.replace(day=1), always_total=True)


@case("r11_previous_month", sql.monthly("2001-05-01", "2001-06-01"))
def _(roles):
    return monthly.r11_monthly_totals(roles, as_of=AS_OF, previous_month=True)


@case("r11_monthly_totals_every_box", sql.monthly("2001-06-01", "2001-06-15", dedupe=False))
def _(roles):
    return monthly.r11_monthly_totals(roles, as_of=AS_OF, dedupe=False)


@case("r12_monthly_totals_two_sites", sql.monthly_two_sites("2001-06-01", "2001-06-15"))
def _(roles):
    return monthly.r12_monthly_totals_two_sites(roles, as_of=AS_OF)


@case("r13_image_inventory", sql.image_inventory())
def _(roles):
    return inventory.r13_image_inventory(roles, IMAGE_INVENTORY.starting(START))


@case("r13_image_inventory_every_location", sql.image_inventory(dedupe=False))
def _(roles):
    return inventory.r13_image_inventory(roles, IMAGE_INVENTORY.starting(START), dedupe=False)


_IMAGES = ["CheckInDate", "ImageCount", *inventory.STAGES]
_BOXES = ["CheckInDate", "BoxCount", "ACTIVE", "COMPLETED"]


@case("r13_placeholder", f"""
    with found as ({sql.or_blank(sql.image_inventory(), _IMAGES)}),
    nothing as ({sql.or_blank("with r as (" + sql.image_inventory() + ") from r where false",
                              _IMAGES)})
    select 'found' as part, * from found union all select 'nothing', * from nothing""")
def _(roles):
    """The image inventory as text, and that of a line without batches."""
    line = IMAGE_INVENTORY.starting(START)
    parts = {"found": line, "nothing": replace(line, batch_prefix="no such prefix")}
    first, second = (inventory.r13_image_inventory(roles, chosen, placeholder=True).select(
        F.lit(name).alias("part"), "*") for name, chosen in parts.items())
    return first.unionByName(second)


@case("r14_placeholder", f"""
    with found as ({sql.or_blank(sql.BOX_INVENTORY, _BOXES)}),
    nothing as ({sql.or_blank("with r as (" + sql.BOX_INVENTORY + ") from r where false", _BOXES)})
    select 'found' as part, * from found union all select 'nothing', * from nothing""")
def _(roles):
    """The box inventory as text, and that of a line without batches."""
    line = BOX_INVENTORY.starting(START)
    parts = {"found": line, "nothing": replace(line, batch_prefix="no such prefix")}
    first, second = (inventory.r14_box_inventory(roles, chosen, placeholder=True).select(
        F.lit(name).alias("part"), "*") for name, chosen in parts.items())
    return first.unionByName(second)


@case("r14_box_inventory", sql.BOX_INVENTORY)
def _(roles):
    return inventory.r14_box_inventory(roles, BOX_INVENTORY.starting(START))


@case("r14_box_inventory_no_tests", sql.BOX_INVENTORY.replace(
    "PBatch like '02%'", "PBatch like '02%' and " + sql.NOT_TEST.format(c="PBatch")))
def _(roles):
    return inventory.r14_box_inventory(
        roles, replace(BOX_INVENTORY.starting(START), skip_test_batches=True))


@case("r15_verification_queue", sql.VERIFICATION)
def _(roles):
    return queue.r15_verification_queue(roles)


_QUEUE = ["RMN", "BatchName", "TotalImages(OpenBox)", "TSModule", "Status", "boxSource"]


@case("r15_placeholder", f"""
    with waiting as ({sql.or_blank(sql.VERIFICATION, _QUEUE)}),
    nothing as ({sql.or_blank(sql.VERIFICATION + " and w.BatchName = 'none'", _QUEUE)})
    select 'waiting' as part, * from waiting union all select 'nothing', * from nothing""")
def _(roles):
    """A queue with rows and an empty one."""
    none = dict(roles) | {"workflow": roles["workflow"].where("BatchName = 'none'")}
    parts = {"waiting": roles, "nothing": none}
    first, second = (queue.r15_verification_queue(t, placeholder=True).select(
        F.lit(name).alias("part"), "*") for name, t in parts.items())
    return first.unionByName(second)


@case("r16_completed_feed", sql.feed())
def _(roles):
    return feed.r16_completed_feed(roles, feed=FEED_T)


@case("r16_completed_feed_open_span", sql.feed("open"))
def _(roles):
    return feed.r16_completed_feed(roles, feed=Feed(START, START, datetime(2001, 5, 1), None))


@case("r16_completed_feed_no_exclusion", sql.feed(None))
def _(roles):
    return feed.r16_completed_feed(roles, feed=Feed(START, START, None, None))


@case("r17_masked_review", sql.MASKED_REVIEW)
def _(roles):
    return review.r17_masked_review(roles, as_of=AS_OF)


@case("r18_cleared_review", sql.cleared_review())
def _(roles):
    """Written as a table and read back, as the report does."""
    df = review.r18_cleared_review(roles, as_of=AS_OF)
    return materialize(df, own_name("cleared_review"), shared_dir(df.sparkSession))


@case("r18_cleared_review_unmatched_exception", sql.cleared_review(unmatched=True))
def _(roles):
    exceptions = roles["qa_exceptions"]
    unmatched = exceptions.sparkSession.range(1).select(F.lit("no such batch").alias("batchname"))
    more = dict(roles) | {"qa_exceptions": exceptions.unionByName(unmatched)}
    return review.r18_cleared_review(more, as_of=AS_OF)


@case("r19_daily_completed", sql.DAILY_COMPLETED)
def _(roles):
    return queue.r19_daily_completed(roles, as_of=AS_OF)


@table_case("r20_redelimit", """
    select cast(o_orderkey as varchar) || '|"' || o_orderstatus || '|' || o_orderpriority || '"'
        as value from orders""")
def _(spark, sf_dir):
    base = shared_dir(spark)
    line = F.concat(F.col("o_orderkey").cast("string"), F.lit('\t"'), F.col("o_orderstatus"),
                    F.lit("\t"), F.col("o_orderpriority"), F.lit('"'))
    scan(spark, sf_dir, "orders").select(line.alias("value")).write.text(f"{base}/tabbed")
    queue.r20_redelimit(spark, f"{base}/tabbed", f"{base}/piped")
    return spark.read.text(f"{base}/piped")


@case("r21_batch_lookup", """
    select BatchName as batchname from workflow where BatchName = '02000000000010'""")
def _(roles):
    return queue.r21_batch_lookup(roles, batch="02000000000010")
