from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest

from scanyard.plans import extracts, feed, inventory, monthly, outstanding, queue, review, summary
from scanyard.plans.config import (BOX_INVENTORY, FCS, IMAGE_INVENTORY, OMPF, OMPF_DIRECT, VAULT,
                                   Feed)
from scanyard.plans.report_set import report_set
from scanyard.sources.roles import derive_roles
from tests.conftest import AS_OF

START = datetime(1995, 1, 1)
T = "2001-06-04 09:00:00"
BOX = ("A  ", "1Z", "house", "fcs", "ro", T)
OBOX = ("A", "1Z", "ompf ", "x", "y", T)


def doc(box="A", batch="02a", folder="f1", image="i1", pages=10, up=None, made=T, key=1):
    return (box, batch, folder, image, "dd214", " 1234 ", key, pages, up, made)


def fcs(tables, **rows):
    rows.setdefault("check_in", [BOX])
    rows.setdefault("physical_batch", [("02a", "A", "P", T)])
    return tables(**rows), FCS.starting(START)


def ompf(tables, **rows):
    rows.setdefault("check_in", [OBOX])
    rows.setdefault("physical_batch", [("02a", "A", "P", T)])
    return tables(**rows), OMPF.starting(START)


def test_padded_keys_and_codes_meet(tables, values):
    roles, line = ompf(tables, physical_batch=[("02a ", "A   ", "P", T)],
                       folder_map=[("A", "02a", "f1 ", T)])
    got = extracts.intake_master(roles, line).collect()
    assert [(r["RMN"], r["BatchName"], r["dcsid"]) for r in got] == [("A", "02a", "f1")]


def test_master_keeps_batches_without_folders(tables, values):
    roles, line = fcs(tables, physical_batch=[("02a", "A", "P", T), ("02b", "A", None, T)],
                      folder_map=[("A", "02a", "f1", T)], exported=[("02b",)])
    got = extracts.intake_master(roles, line)
    assert values(got, "BatchName", "dcsid", "ExportedBatchName") == [
        ("02a", "f1", None), ("02b", None, "02b")]


def test_null_claim_is_not_in_the_filter(tables):
    roles, line = fcs(tables, check_in=[("A", "1Z", None, "fcs", "ro", T)])
    assert extracts.intake_master(roles, line).count() == 0


def test_record_without_upload_counts_as_uploaded_and_is_open(tables, values):
    roles, line = fcs(tables, folder_map=[("A", "02a", "f1", T)], document=[doc(up=None)])
    row = summary.r01_box_summary(roles, line).collect()[0]
    assert (row["Uploaded(Batches)"], row["Uploaded(DCSIDs)"], row["Status"]) == (1, 1, "Completed")
    assert values(outstanding.open_batches(roles, line), "BatchName") == [("02a",)]


def test_open_batches_by_kind_of_record(tables, values):
    roles, line = fcs(
        tables, physical_batch=[(b, "A", "P", T) for b in ("02none", "02done", "02open")],
        document=[doc(batch="02done", up=T), doc(batch="02open", up=None)])
    assert values(outstanding.open_batches(roles, line), "BatchName") == [("02none",), ("02open",)]


@pytest.mark.parametrize("image_grain, expected", [(True, [("02a",)]), (False, [])])
def test_grain_of_the_upload_records(tables, values, image_grain, expected):
    """One folder with an uploaded and a waiting image."""
    roles, line = ompf(tables, document=[doc(image="i1", up=T), doc(image="i2", up=None)])
    line = replace(line, image_grain=image_grain)
    assert values(outstanding.open_batches(roles, line), "BatchName") == expected


def test_records_of_other_boxes_count_only_where_the_line_says_so(tables, values):
    """The only record of the batch was made for a box outside the line."""
    rows = dict(check_in=[BOX], physical_batch=[("02a", "A", "P", T)],
                document=[doc(box="ELSEWHERE", up=T)])
    roles, line = fcs(tables, **rows)
    assert values(outstanding.open_batches(roles, line), "BatchName") == [("02a",)]
    anywhere = replace(line, uploads_need_box=False)
    assert values(outstanding.open_batches(roles, anywhere), "BatchName") == []


def test_summary_counts_all_folders_of_the_batches(tables):
    roles, line = fcs(
        tables, physical_batch=[("02a", "A", "P", T), ("02b", "A", "P", T)],
        folder_map=[("A", "02a", "f1", T), ("A", "02b", "f1", T), ("A", "02b", "f2", T)],
        exported=[("02a",)], document=[doc(folder="f1"), doc(folder="other")])
    row = summary.r01_box_summary(roles, line).collect()[0].asDict()
    assert row == {
        "RMN": "A", "TrackingNo": "1Z", "ClaimType": "HOUSE", "TotalBatches": 2,
        "TotalDCSIDs": 2, "InProgress(Batches)": 1, "Exported(Batches)": 1,
        "Uploaded(Batches)": 1, "Uploaded(DCSIDs)": 2, "Status": "Partial"}


def test_smallest_claim_type_is_shown(tables, values):
    roles, line = fcs(tables, check_in=[BOX, ("A", "1Z", "auto", "fcs", "ro", T)])
    assert values(summary.r01_box_summary(roles, line), "ClaimType", "TotalBatches") == [("AUTO", 1)]


def test_exported_and_in_process_make_the_total(tables):
    roles, line = fcs(
        tables, physical_batch=[(f"02{n}", "A", "P", T) for n in range(7)],
        exported=[("021",), ("021",), ("02x",), ("025",)])
    row = summary.r01_box_summary(roles, line).collect()[0]
    assert row["Exported(Batches)"] == 2
    assert row["Exported(Batches)"] + row["InProgress(Batches)"] == row["TotalBatches"] == 7


def test_unfinished_boxes(tables, values):
    """Both batches and folders must be missing for a box to stay."""
    roles, line = ompf(
        tables,
        check_in=[(b, "1Z", "OMPF", "x", "y", T) for b in "ABC"],
        physical_batch=[(f"02{b}{n}", b, "P", T) for b in "ABC" for n in (1, 2)],
        folder_map=[(b, f"02{b}{n}", f"{b}{n}", T) for b in "ABC" for n in (1, 2)],
        document=[doc("A", "02A1", "A1"), doc("B", "02B1", "B1"), doc("B", "02B2", "B2"),
                  doc("C", "02C1", "C1"), doc("C", "02C1", "C2")])
    assert values(summary.r05_box_summary(roles, line), "RMN") == [("A",), ("B",), ("C",)]
    assert values(summary.r05_box_summary(roles, line, only_unfinished=True), "RMN") == [("A",)]


def test_vault_keeps_partial_boxes(tables, values):
    roles = tables(
        check_in=[("1011", "1Z", None, "x", "y", T), ("1012", "1Z", "OMPF", "x", "y", T)],
        physical_batch=[("01a", "1011", "P", T), ("01b", "1012", "P", T)],
        document=[doc("1012", "01b", up=T)])
    line = VAULT.starting(START)
    assert values(summary.r04_vault_summary(roles, line), "RMN", "ClaimType") == [("1011", None)]
    assert values(outstanding.r04_vault_batches(roles, line, AS_OF), "BatchName") == [("01a",)]


def test_age_in_working_days(tables, values):
    """Monday 4 June 9:00 to Friday 15 June 10:00: 11.04 days, one weekend and one holiday."""
    days = [("2001-06-09", "Saturday", None), ("2001-06-10", "Sunday", None),
            ("2001-06-06", "Wednesday", "Founders"), ("2001-06-03", "Sunday", None),
            ("2001-06-16", "Saturday", None)]
    roles, line = fcs(tables, calendar=days, folder_map=[("A", "02a", "f1", T)],
                      scanner=[("02x",)])
    row = outstanding.r02_outstanding_batches(roles, line, AS_OF).collect()[0].asDict()
    assert row == {
        "RMN": "A", "TrackingNo": "1Z", "BatchName": "02a", "InvTime": "2001-06-04",
        "TAT(Days)": 8, "OpenBoxBatchLocation": None, "BatchStatus": "Pending IBML Scan",
        "TotalImages(OpenBox)": None, "SpecialMedia/Paper": "P", "Paper(DCSID Count)": 1,
        "SpecialMedia(DCSID Count)": 0}


def test_folders_repeat_the_batch_and_keep_folderless_ones(tables, values):
    roles, line = fcs(
        tables, physical_batch=[("02a", "A", "SM", T), ("02b", "A", None, T)],
        folder_map=[("A", "02a", "f1", T), ("A", "02a", "f2", T), ("A", "02a", None, T)],
        workflow=[("02a", 12, 64, 4, 70, 8)], scanner=[("02b",)])
    got = outstanding.r03_outstanding_folders(roles, line, AS_OF)
    assert values(got, "BatchName", "DCSID", "OpenBoxBatchLocation", "BatchStatus",
                  "`SpecialMedia/Paper`") == [
        ("02a", "f1", "Verification", "Suspended", "SM"),
        ("02a", "f2", "Verification", "Suspended", "SM"),
        ("02a", None, "Verification", "Suspended", "SM"),
        ("02b", None, None, "Pending OpenBox Import", "P")]


def test_media_counts_of_an_unknown_class(tables, values):
    roles, line = fcs(
        tables, physical_batch=[("02a", "A", "SM", T), ("02b", "A", "P", T), ("02c", "A", None, T)],
        folder_map=[("A", b, f"{b}{n}", T) for b in ("02a", "02b", "02c") for n in (1, 2)])
    assert values(outstanding.open_batches(roles, line), "BatchName", "Media", "Paper", "Special") == [
        ("02a", "SM", 0, 2), ("02b", "P", 2, 0), ("02c", "P", 0, 0)]


def test_earliest_receipt_is_shown(tables, values):
    roles, line = fcs(tables, physical_batch=[("02a", "A", "P", T),
                                              ("02a", "A", "P", "2001-05-01 01:00:00")])
    got = outstanding.r02_outstanding_batches(roles, line, AS_OF)
    assert values(got, "BatchName", "InvTime") == [("02a", "2001-05-01")]


def test_second_ocr_job_wins(tables, values):
    roles, line = ompf(
        tables, physical_batch=[(f"02{b}", "A", "P", T) for b in "abcd"],
        workflow=[("02a", 1, 1, 1, 10, 8), ("02b", 13, 0, 1, 20, 8), ("02c", 13, 256, 0, 30, 8)],
        exported=[("02b",)], ocr2=[("02a", None, 5), ("02c", 99, 0)], ocr5=[("02a", None, 7)],
        scanner=[])
    got = outstanding.r06_open_batches(roles, line)
    assert values(got, "BatchName", "OpenBoxBatchLocation", "BatchStatus",
                  "`TotalImages(OpenBox)`") == [
        ("02a", "Capture", "WIP 2nd Job OCR", None), ("02b", "-", "Pending Upload", 20),
        ("02c", "Export", None, 30), ("02d", "-", "Pending Scan", None)]


def test_folder_number_comes_from_the_records(tables, values):
    roles, line = ompf(tables, folder_map=[("A", "02a", "f1", T), ("A", "02a", "f2", T)],
                       document=[doc(folder="f1", up=None)])
    assert values(outstanding.r07_open_folders(roles, line), "DCSID") == [("f1",), (None,)]


def test_placeholder_rows(tables, values):
    roles, line = ompf(tables, physical_batch=[])
    row = outstanding.r06_open_batches(roles, line, placeholder=True).collect()
    assert [set(r.asDict().values()) for r in row] == [{""}]
    assert outstanding.r06_open_batches(roles, line).count() == 0
    assert outstanding.r07_open_folders(roles, line, placeholder=True).count() == 1


def test_turnaround_pivot(tables):
    roles, line = ompf(tables, physical_batch=[("02a", "A", "P", T), ("02b", "A", "P", T)],
                       workflow=[("02a", 1, 1, 1, 10, 8), ("02b", 1, 1, 0, 10, 8)])
    rows = outstanding.r08_turnaround_pivot(roles, line).collect()
    assert [r.asDict() for r in rows] == [{
        "RMN": "A", "TrackingNo": "1Z", "BatchName": "02a", "InvDate": "2001-06-04",
        "OpenBoxBatchLocation": "Capture", "BatchStatus": "Ready", "Paper(DCSID Count)": "0.0",
        "SpecialMedia(DCSID Count)": "0.0", "TotalImages(OpenBox)": "10.0"}]


def test_direct_reports(tables, values):
    roles = tables(
        check_in=[OBOX], physical_batch=[(f"02{b}", "A", "P", T) for b in "abc"],
        exported=[("02a",), ("02b",)],
        document=[doc(batch="02a", image="i1", up=T), doc(batch="02b", image="i1"),
                  doc(batch="02b", image="i1"), doc(batch="02b", image="i2"),
                  doc(batch="02b", image="i3", up=T)])
    line = OMPF_DIRECT.starting(START)
    assert values(summary.r09_direct_summary(roles, line)) == [("A", "1Z", 3, 1, 2, 2)]
    assert values(outstanding.r10_direct_outstanding(roles, line), "BatchName", "BatchStatus") == [
        ("02b", "Exported [2 of 2 doc(s) pending upload]"), ("02c", "Pending IBML Scan")]


MONTH = "2001-06-05 08:00:00"


def test_lookalike_boxes_in_the_totals(tables, values):
    """One batch, one day, two boxes with 2 images and 10 pages each."""
    roles = tables(document=[doc(box, "02x", image=f"{box}{n}", pages=5, up=MONTH)
                             for box in "AB" for n in (1, 2)])
    once = monthly.r11_monthly_totals(roles, as_of=AS_OF)
    assert values(once, "UploadDate", "`FCS Docs`", "`FCS Images`") == [
        ("06/05/2001", 2, 10), ("Total", 2, 10)]
    every = monthly.r11_monthly_totals(roles, as_of=AS_OF, dedupe=False)
    assert values(every, "`FCS Docs`", "`FCS Images`") == [(4, 20), (4, 20)]


def test_totals_by_line_and_an_image_in_two_batches(tables, values):
    roles = tables(
        check_in=[("A", "1Z", "OMPF", "x", "y", T), ("B", "1Z", None, "x", "y", T)],
        document=[doc("A", "02a", image="i", pages=1, up=MONTH),
                  doc("A", "02b", image="i", pages=2, up=MONTH),
                  doc("B", "02c", image="j", pages=4, up=MONTH),
                  doc("B", "01d", image="k", pages=8, up=MONTH),
                  doc("B", "07e", image="l", pages=16, up="2001-06-06 00:00:00"),
                  doc("B", "02f", image="m", pages=32, up="2001-06-15 00:00:00")])
    got = monthly.r11_monthly_totals(roles, as_of=AS_OF)
    assert values(got) == [
        ("06/05/2001", 1, 4, 2, 3, 1, 8), ("06/06/2001", 0, 0, 0, 0, 0, 0),
        ("Total", 1, 4, 2, 3, 1, 8)]


def test_totals_on_the_first_of_a_month(tables, values):
    roles = tables(document=[doc(up="2001-05-20 00:00:00")])
    first = datetime(2001, 6, 1, 10)
    assert monthly.r11_monthly_totals(roles, as_of=first).count() == 0
    total = monthly.r11_monthly_totals(roles, as_of=first, always_total=True).collect()
    assert [set(r.asDict().values()) for r in total] == [{"Total", None}]
    assert monthly.r11_monthly_totals(roles, as_of=first, previous_month=True).count() == 2


def test_second_site_totals(tables, values):
    roles = tables(document=[doc(up=MONTH, pages=3), doc(up="2001-06-07 00:00:00", pages=4)],
                   second_site=[("2001-06-05", 7, 70), ("2001-06-08", 1, 1)])
    got = monthly.r12_monthly_totals_two_sites(roles, as_of=AS_OF)
    assert values(got, "UploadDate", "`FCS Images`", "`London Docs`", "`London Images`") == [
        ("06/05/2001", 3, 7, 70), ("06/07/2001", 4, 0, 0), ("Total", 7, 7, 70)]
    twice = dict(roles)
    twice["second_site"] = roles["second_site"].unionAll(roles["second_site"])
    got = monthly.r12_monthly_totals_two_sites(twice, as_of=AS_OF)
    assert values(got, "UploadDate", "`FCS Images`", "`London Docs`")[0] == ("06/05/2001", 6, 7)


def test_lookalike_locations_in_the_inventory(tables, values):
    """Step 1 at two locations with 100 images each."""
    roles = tables(
        check_in=[OBOX], physical_batch=[("02a", "A", "P", T), ("02b", "A", "P", T)],
        workflow=[("02a", 1, 1, 1, 100, 8), ("02b", 1, 2, 1, 100, 8)])
    line = IMAGE_INVENTORY.starting(START)
    cols = ["CheckInDate", "ImageCount", "Capture", "Clean"]
    assert values(inventory.r13_image_inventory(roles, line), *cols) == [("06/04/2001", 100, 100, 0)]
    assert values(inventory.r13_image_inventory(roles, line, dedupe=False), *cols) == [
        ("06/04/2001", 200, 200, 0)]


def test_inventory_leaves_out_other_work(tables, values):
    batches = ("02a", "02b", "02c", "02d", "02TEST", "01f")
    roles = tables(
        check_in=[OBOX], physical_batch=[(b, "A", "P", T) for b in batches],
        workflow=[("02a", 12, 64, 1, 5, 8), ("02b", 12, 1, 1, 7, 8), ("02c", 11, 32, 1, 9, 8),
                  ("02d", 1, 1, 1, 11, 9), ("02TEST", 1, 1, 1, 13, 8), ("01f", 1, 1, 1, 15, 8),
                  ("02a", 13, 256, 1, None, 8)])
    got = inventory.r13_image_inventory(roles, IMAGE_INVENTORY.starting(START))
    assert values(got, "ImageCount", "Verification", "Export") == [(5, 5, 0)]


def test_box_inventory_looks_at_all_batches_of_the_box(tables, values):
    """The first day comes from the line's batches, the state from all batches."""
    roles = tables(
        check_in=[(b, "1Z", "OMPF", "x", "y", T) for b in "ABC"],
        physical_batch=[("02a", "A", "P", T), ("01a", "A", "P", "2001-01-01 00:00:00"),
                        ("02b", "B", "P", "2001-06-04 23:00:00"), ("01c", "C", "P", T)],
        document=[doc("A", "02a", up=T), doc("B", "02b", up=T), doc("B", "02b", up=None)])
    got = inventory.r14_box_inventory(roles, BOX_INVENTORY.starting(START))
    assert values(got) == [("06/04/2001", 2, 1, 1)]


def test_verification_queue(tables, values):
    roles = tables(
        check_in=[("A", "1Z", None, "x", "ro", T), ("A", "2Z", None, "x", "ro", T)],
        physical_batch=[("02a", "A", "P", T), ("02b", "A", "P", T)],
        workflow=[("02a", 12, 64, 0, 10, 8), ("02b", 12, 1, 1, 10, 8), ("02c", 12, 64, 1, 1, 8)])
    assert values(queue.r15_verification_queue(roles)) == [
        ("A", "02a", 10, "Verification/BVTI", "Error", "ro")]


def test_feed_rows(tables, values):
    roles = tables(
        check_in=[("101A", "1Z", None, "x", "y", T), ("B", "1Z", "OMPF", "x", "y", T),
                  ("C", "1Z", None, "x", "y", T)],
        physical_batch=[("01a", "101A", "P", T), ("02b", "B", "P", T), ("02c", "C", "P", T)],
        document=[doc("101A", "01a", image="i", pages=3, up=MONTH, key=1),
                  doc("B", "02b", image="j", pages=4, up=MONTH, key=2),
                  doc("C", "02c", image="k", pages=5, up=MONTH, key=3),
                  doc("C", "03d", image="k", pages=5, up=MONTH, key=4),
                  doc("B", "02b", folder="bad", image="l", pages=9, up="2001-05-10 00:00:00",
                      key=5),
                  doc("B", "02b", folder="bad", image="m", pages=9, up="2001-05-01 00:00:00",
                      key=6),
                  doc("Z", "02z", image="n", pages=5, up=MONTH, key=7)],
        excluded_folders=[("bad",)])
    span = Feed(START, START, datetime(2001, 5, 1), datetime(2001, 6, 1))
    cols = ["JobName", "BatchName", "CompleteDate", "ImageCount", "DocCount", "Boxes"]
    assert values(feed.r16_completed_feed(roles, feed=span), *cols) == [
        ("OMPF", "02b", "05/01/2001", 9, 1, 0), ("OMPF", "02b", "06/05/2001", 4, 1, 0),
        ("OMPF", "B", "05/01/2001", 0, 0, 1), ("OMPF", "B", "06/05/2001", 0, 0, 1),
        ("VAULT", "01a", "06/05/2001", 3, 1, 0), ("VAULT", "101A", "06/05/2001", 0, 0, 1),
        (None, "02c", "06/05/2001", 5, 1, 0), (None, "C", "06/05/2001", 0, 0, 1)]


def test_feed_rows_move_once_to_their_order(spark, tables):
    """Equal rows of several batches and claims become one in the ranges of the order."""
    roles = tables(
        check_in=[("A", "1Z", "OMPF", "x", "y", T), ("A", "2Z", "OMPF", "x", "y", T),
                  ("A", "1Z", "OTHER", "x", "y", T)],
        physical_batch=[("02a", "A", "P", T), ("02b", "A", "P", T), ("02a", "A", "SM", T)],
        document=[doc("A", "02b", image="i", pages=3, up=MONTH, key=1),
                  doc("A", "02a", image="j", pages=4, up=MONTH, key=2)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = feed.r16_completed_feed(roles, feed=Feed(START, START, None, None))
        plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
        found = [tuple(r) for r in got.select("JobName", "BatchName", "ImageCount",
                                              "Boxes").collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    moved = [line for line in plan[:join] if "Exchange" in line]
    assert len(moved) == 1 and "rangepartitioning" in moved[0]
    assert len(found) == len(set(found)) and found == sorted(
        found, key=lambda r: (r[0] is not None, r))
    assert sum(boxes for *_, boxes in found) == len({job for job, _, _, boxes in found if boxes})


REVIEW = dict(
    check_in=[("A", "1Z", "OMPF", "x", "y", T)],
    document=[doc(up="2001-06-14 10:00:00"), doc(box="B", folder="f9", up="2001-06-14 00:00:00"),
              doc(up="2001-06-15 00:00:00", image="late")],
    customer_data=[("f1", "02a", "Ann", "Lee", T), ("f1", "02other", "Bob", "Ray", T)],
    physical_batch=[("02a", "A", "P", T)])


def test_masked_review(tables, values):
    got = review.r17_masked_review(tables(**REVIEW), as_of=AS_OF)
    assert got.columns == ["RMN", "dcsID", "ImageID", "PDF Created", "Image Count Per PDF",
                           "Veteran Name", "FileNumber", "DocType", "Date of Receipt", "claimtype"]
    assert values(got, "RMN", "`Veteran Name`", "FileNumber", "`PDF Created`", "claimtype") == [
        ("A", "A*** L***", "********4", "2001-06-04", "OMPF"),
        ("B", None, "********4", "2001-06-04", None)]


@pytest.mark.parametrize("exceptions, expected", [
    ([], [("A",), ("B",)]), ([("02a",)], [("B",)]), ([("02a",), ("gone",)], [])])
def test_exceptions_without_a_batch_clear_nothing(tables, values, exceptions, expected):
    roles = tables(**REVIEW, qa_exceptions=exceptions)
    assert values(review.r18_cleared_review(roles, as_of=AS_OF), "RMN") == expected


def test_daily_completed(tables, values):
    roles = tables(boxes_done=[("A", "2001-06-14 00:00:00"), ("B", "2001-06-15 00:00:00")],
                   folders_done=[("f", "2001-06-13 23:59:59")])
    assert values(queue.r19_daily_completed(roles, as_of=AS_OF)) == [
        ("DCSIDs Uploaded by GDIT", 0), ("RMNs Uploaded by GDIT", 1)]


def test_batch_lookup(tables, values):
    roles = tables(workflow=[("02a", 1, 1, 1, 1, 8)])
    assert values(queue.r21_batch_lookup(roles, batch="02a")) == [("02a",)]
    assert queue.r21_batch_lookup(roles, batch="02b").count() == 0


def test_start_dates_move_only_where_set():
    moved = VAULT.starting(START)
    assert (moved.inserted_since, moved.received_since, moved.imaged_since) == (None, START, START)
    assert VAULT.received_since == datetime(2021, 4, 1)


def test_upload_month_is_pruned(spark, tables, tmp_path):
    from scanyard.sources.roles import load_roles, store_roles
    roles = tables(document=[doc(up=MONTH), doc(up="2001-05-02 00:00:00"), doc(up=None)])
    store_roles(roles, str(tmp_path))
    stored = load_roles(spark, str(tmp_path), clean=True)
    inside = extracts.uploaded_between(stored["document"], datetime(2001, 6, 1), AS_OF)
    assert inside.count() == 1
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(upload_month" in plan
    assert sorted(stored["document"].select("ImageID").collect()) == sorted(
        roles["document"].select("ImageID").collect())


@pytest.mark.parametrize("line", [FCS, VAULT, OMPF])
def test_report_set_has_the_reports_of_the_line(spark, line):
    """The shared open batches change nothing in the sheets."""
    roles = derive_roles(spark, "/root/testdata/sf0.001")
    line = line.starting(datetime(1995, 1, 1))
    sheets = report_set(roles, line, AS_OF)
    if line.claim:
        alone = summary.r05_box_summary, outstanding.r06_open_batches, outstanding.r07_open_folders
    else:
        alone = (summary.r04_vault_summary if line.box_prefix else summary.r01_box_summary,
                 outstanding.r02_outstanding_batches, outstanding.r03_outstanding_folders)
    assert list(sheets) == [f"{line.name} Summary", "Outstanding Batches", "Outstanding DCSIDs"]
    for sheet, report in zip(sheets.values(), alone):
        expected = report(roles, line, AS_OF)
        assert sheet.columns == expected.columns
        assert sorted(map(tuple, sheet.collect()), key=repr) == sorted(
            map(tuple, expected.collect()), key=repr)


def test_feed_joins_only_uploads_that_may_be_excluded(tables):
    """One anti join, below which rows are those a broadcast map of the list cannot rule out."""
    plan = feed.r16_completed_feed(tables())._jdf.queryExecution().analyzed().toString()
    assert plan.count("Join LeftAnti") == 1
    below = plan[plan.index("Join LeftAnti"):].splitlines()
    assert any("Filter _near" in line for line in below)


@pytest.mark.parametrize("folders,batches,line,more", [
    ("r03_outstanding_folders", "r02_outstanding_batches", FCS, 2),
    ("r07_open_folders", "r06_open_batches", OMPF, 4)])
def test_folder_reports_plan_the_batches_once(tables, folders, batches, line, more):
    """Beside the batch report's joins: folders and batches without any, then the folder number
    found among the records of the line's boxes."""
    roles = tables()
    joins = [getattr(outstanding, name)(roles, line, AS_OF)._jdf.queryExecution().analyzed()
             .toString().count("Join ") for name in (folders, batches)]
    assert joins[0] == joins[1] + more
