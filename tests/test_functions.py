from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from scanyard.functions import dates, decode, predicates, text
from tests.conftest import AS_OF

c = F.col


def column(frame, schema, rows, build):
    return [r[0] for r in frame(schema, rows).select(build).collect()]


def test_mask_tail(frame):
    rows = [(" 1234 ",), ("   ",), ("",), (None,), ("\t7\n",)]
    assert column(frame, "a string", rows, text.mask_tail(c("a"))) == [
        "********4", None, None, None, "********7"]


def test_mask_name(frame):
    rows = [("Ann", "Lee"), (None, "Lee"), ("Ann", None), ("", "Lee")]
    assert column(frame, "a string, b string", rows, text.mask_name(c("a"), c("b"))) == [
        "A*** L***", None, None, "*** L***"]


def test_clean_keys_and_codes(frame):
    assert column(frame, "a string", [("A",), ("A  ",)], text.clean_key(c("a"))) == ["A", "A"]
    assert column(frame, "a string", [(" ompf ",)], text.clean_code(c("a"))) == ["OMPF"]


def test_stage_name_over_the_code_domain(frame):
    places = [(1, 1), (2, 2), (3, 16), (4, 2), (5, 4), (6, 128), (7, 8), (8, 128), (9, 128),
              (10, 32), (11, 32), (12, 64), (12, 1), (13, 256), (13, 0), (None, 1), (12, None),
              (13, None), (14, 1)]
    assert column(frame, "s int, l int", places, decode.stage_name(c("s"), c("l"))) == [
        "Capture", "Enhance1", "FOCR", "Enhance2", "Separation", "ImageQC", "AutoIndex", "DocID",
        "DocIDQC", "Manual Index", "Manual IndexQC", "Verification", None, "Export", None, None,
        None, None, None]


def test_module_name_names_odd_places(frame):
    places = [(1, 1), (3, 16), (9, 128), (12, 64), (13, 0), (13, 256), (12, 1), (None, 1)]
    assert column(frame, "s int, l int", places, decode.module_name(c("s"), c("l"))) == [
        "Scan/Capture", "FOCR1", "QA3", "Verification/BVTI", "Clean", "Export",
        "WFStep12 BchLoc 1 - LocationError", None]


def test_batch_status_precedence(frame):
    rows = [("x", 4, "x"), (None, 1, "x"), (None, 2, "x"), (None, 4, "x"), (None, 8, "x"),
            (None, 0, "x"), (None, None, None), ("x", None, None)]
    assert column(frame, "e string, s int, b string", rows,
                  decode.batch_status(c("e"), c("s"), c("b"))) == [
        "Exported", "Ready", "In Process", "Suspended", "Auto-Fail", None,
        "Pending OpenBox Import", "Exported"]


@pytest.mark.parametrize("second, expected", [
    (False, ["Pending Upload", "Pending Scan", "Pending OpenBox Import", "Ready", None]),
    (True, ["WIP 2nd Job OCR"] * 5),
])
def test_outstanding_status(frame, second, expected):
    rows = [("Exported", False), ("Pending OpenBox Import", False),
            ("Pending OpenBox Import", True), ("Ready", False), (None, False)]
    status = decode.outstanding_status(c("s"), c("i"), "Pending Scan", F.lit(second))
    assert column(frame, "s string, i boolean", rows, status) == expected


def test_job_name(frame):
    rows = [("01x", "101", None), ("01x", "200", None), ("02x", "200", "OMPF"),
            ("02x", "200", "HOUSE"), ("02x", "200", None), ("07x", "1", None),
            ("08x", "1", None), ("03x", "1", "OMPF")]
    assert column(frame, "b string, r string, c string", rows,
                  decode.job_name(c("b"), c("r"), c("c"))) == [
        "VAULT", "RMC", "OMPF", "FCS", None, "BWN", "REA", None]


def test_matched_null_stays_null(frame):
    rows = [(True, None, 5), (False, None, 5), (True, 7, 5)]
    assert column(frame, "m boolean, a int, b int", rows,
                  decode.either(c("m"), c("a"), c("b"))) == [None, 5, 7]


def test_pending_text(frame):
    assert column(frame, "a int, b int", [(5, 2)], decode.pending_text(c("a"), c("b"))) == [
        "Exported [3 of 5 doc(s) pending upload]"]


def test_media(frame):
    rows = [("SM",), ("P",), (None,)]
    assert column(frame, "a string", rows, decode.media_flag(c("a"))) == ["SM", "P", "P"]
    paper, special = decode.media_counts(c("a"), F.lit(2))
    assert column(frame, "a string", rows, paper) == [0, 2, 0]
    assert column(frame, "a string", rows, special) == [2, 0, 0]


def test_test_batches_in_any_case(frame):
    rows = [("02a",), ("02TEST",), ("training",), (None,)]
    kept = frame("a string", rows).where(predicates.not_test_batch(c("a"))).collect()
    assert [r[0] for r in kept] == ["02a"]


def test_valid_tracking(frame):
    rows = [("1Z",), (None,), ("",), ("   ",), ("1234DUMMY1234",), ("1234DUMMY1234 ",)]
    kept = frame("a string", rows).where(predicates.valid_tracking(c("a"))).collect()
    assert [r[0] for r in kept] == ["1Z"]


def test_windows(frame):
    rows = [(t,) for t in ("2001-04-30 23:59:59", "2001-05-01 00:00:00", "2001-05-31 23:00:00",
                           "2001-06-01 00:00:00", "2001-06-13 23:59:59", "2001-06-14 00:00:00",
                           "2001-06-14 23:59:59", "2001-06-15 00:00:00")]
    df = frame("t timestamp_ntz", rows)

    def kept(condition):
        return [r[0].strftime("%m%d") for r in df.where(condition).collect()]
    assert kept(dates.month_to_date(c("t"), AS_OF)) == ["0601", "0613", "0614", "0614"]
    assert kept(dates.previous_month(c("t"), AS_OF)) == ["0501", "0531"]
    assert kept(dates.yesterday(c("t"), AS_OF)) == ["0614", "0614"]


def test_month_arithmetic():
    assert dates.month_start("2001-01-31", -1) == datetime(2000, 12, 1)
    assert dates.month_start("2001-12-31", 1) == datetime(2002, 1, 1)
    assert dates.day_start("2001-03-01 05:00:00", -1) == datetime(2001, 2, 28)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_elapsed_days_ignore_zone_changes(spark, frame, zone):
    """The clocks of the zone change between the two times."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        days = dates.elapsed_days(c("t"), dates.ts("2001-04-02 12:00:00"))
        rows = [("2001-04-01 00:00:00",), ("2001-04-01 06:00:00.500000",),
                ("2001-04-03 12:00:00",)]
        got = column(frame, "t timestamp_ntz", rows, days)
        assert got == [1.5, (1.25 * 86400 - 0.5) / 86400, -1.0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_parse_us_time(frame):
    got = column(frame, "a string", [("5/1/2021 0:0:0",), ("12/31/2021 23:5:9",)],
                 dates.parse_us_ts(c("a")))
    assert got == [datetime(2021, 5, 1), datetime(2021, 12, 31, 23, 5, 9)]


def test_whole_days_drop_the_fraction(frame):
    rows = [(1.9,), (-1.9,), (-0.5,)]
    assert column(frame, "a double", rows, dates.whole_days(c("a"))) == [1, -1, 0]
