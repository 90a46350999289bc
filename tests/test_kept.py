"""Kept upload records: equal to a run from scratch, and only changed months are read."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from scanyard.plans import extracts, kept, outstanding, summary
from scanyard.plans.config import FCS, OMPF, OMPF_DIRECT, VAULT
from scanyard.sources.roles import derive_roles, load_roles, store_roles
from scanyard.sources.schemas import NO_MONTH
from tests.conftest import AS_OF
from tests.plan_metrics import counters, files_read

START, SF = datetime(1995, 1, 1), "/root/testdata/sf0.001"
CUT = datetime(1997, 3, 10, 12)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def earlier(documents, cut=CUT):
    """The documents as they were: later ones not there, later uploads not done."""
    shown = F.when(F.col("ftpstime") < F.lit(str(cut)).cast("timestamp_ntz"), F.col("ftpstime"))
    return documents.where(F.col("ImageDateTime") < F.lit(str(cut)).cast("timestamp_ntz")) \
        .withColumn("ftpstime", shown)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("roles"))
    store_roles(derive_roles(spark, SF), base)
    return load_roles(spark, base, clean=True), base


@pytest.fixture(scope="module")
def after_two_runs(spark, stored, tmp_path_factory):
    """A first run on earlier documents, a second on all."""
    roles, _ = stored
    base = str(tmp_path_factory.mktemp("kept"))
    assert kept.refresh(earlier(roles["document"]), base, CUT) is None
    months = kept.refresh(roles["document"], base, AS_OF)
    return base, months


@pytest.mark.parametrize("report, line", [
    (summary.r01_box_summary, FCS), (outstanding.r02_outstanding_batches, FCS),
    (outstanding.r03_outstanding_folders, FCS), (summary.r04_vault_summary, VAULT),
    (outstanding.r04_vault_batches, VAULT), (summary.r05_box_summary, OMPF),
    (outstanding.r06_open_batches, OMPF), (outstanding.r07_open_folders, OMPF),
    (summary.r09_direct_summary, OMPF_DIRECT), (outstanding.r10_direct_outstanding, OMPF_DIRECT)])
def test_reports_equal_a_run_from_scratch(spark, stored, after_two_runs, report, line):
    roles, folder = stored
    tables = kept.with_kept(roles, after_two_runs[0])
    line = line.starting(START)
    assert rows(report(tables, line, AS_OF)) == rows(report(roles, line, AS_OF))
    read = counters(spark, lambda: report(tables, line, AS_OF).collect())
    assert not any("document.parquet" in desc for _, desc, _ in read)
    assert any("_uploads" in desc for _, desc, _ in read)


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("line", [FCS, OMPF], ids=["folders", "images"])
def test_bounds_within_a_month(stored, after_two_runs, line, inclusive):
    roles, _ = stored
    first = roles["document"].where("day(ImageDateTime) between 5 and 20").agg(
        F.min("ImageDateTime")).first()[0]
    line = replace(line.starting(START), imaged_since=first, imaged_since_inclusive=inclusive)
    tables = kept.with_kept(roles, after_two_runs[0])
    assert rows(extracts.upload_records(tables, line)) == rows(
        extracts.upload_records(roles, line))
    with pytest.raises(ValueError):
        kept.imaged_since(datetime(1995, 1, 1, 8))


def test_only_months_that_may_have_changed_are_rewritten(stored, after_two_runs):
    roles, _ = stored
    base, months = after_two_runs
    late = roles["document"].where(F.col("ftpstime") >= F.lit(str(CUT)).cast("timestamp_ntz"))
    imaged = {r[0] for r in late.select("image_month").distinct().collect()}
    # Uploads after the first run, of documents imaged before its month, too.
    assert imaged <= set(months) and min(months) <= date(1997, 3, 1)
    assert date(1996, 1, 1) not in months
    assert kept.kept_until(roles["document"], base) == AS_OF


def test_one_more_month_reads_that_month(spark, stored, tmp_path):
    """The plans of the batch reports read one month of documents, and the kept ones."""
    roles, folder = stored
    documents = roles["document"]
    month = documents.where("image_month < '1998-01-01'").agg(F.max("image_month")).first()[0]
    before = documents.where(F.col("image_month") < F.lit(month))
    up_to = documents.where(F.col("image_month") <= F.lit(month))
    kept.refresh(before, str(tmp_path), datetime(1997, 12, 1))
    now = dict(roles) | {"document": up_to}
    tables = kept.with_kept(now, str(tmp_path), live=[month])
    of_month = spark.read.parquet(f"{folder}/document.parquet").where(
        F.col("image_month") == F.lit(month)).select(F.input_file_name()).distinct().count()
    every = len(spark.read.parquet(f"{folder}/document.parquet").inputFiles())
    for report, line in ((outstanding.r02_outstanding_batches, FCS),
                         (outstanding.r06_open_batches, OMPF)):
        line = line.starting(START)
        expected = rows(report(now, line, AS_OF))
        assert rows(report(tables, line, AS_OF)) == expected
        read = files_read(spark, lambda: report(tables, line, AS_OF).collect(),
                          f"{folder}/document.parquet")
        assert 0 < read <= of_month < every / 4
    # And the run that brings the kept records up to date, likewise.
    read = files_read(spark, lambda: kept._write(up_to, str(tmp_path), [month]),
                      f"{folder}/document.parquet")
    assert read <= len(kept.GRAINS) * of_month
    tables = kept.with_kept(now, str(tmp_path))
    assert rows(outstanding.r02_outstanding_batches(tables, FCS.starting(START), AS_OF)) == rows(
        outstanding.r02_outstanding_batches(now, FCS.starting(START), AS_OF))


def test_a_late_upload_closes_an_old_record(spark, tables, tmp_path):
    old = ("A", "02a", "f1", "i1", "d", "1", 1, 1, None, "2001-01-10 00:00:00")
    new = ("A", "02b", "f2", "i2", "d", "1", 2, 1, None, "2001-05-10 08:00:00")
    none = ("A", "02c", "f3", "i3", "d", "1", 3, 1, None, None)
    uploaded = (*old[:8], "2001-06-01 09:00:00", old[9])
    base = str(tmp_path)
    first = tables(document=[old, none])
    assert kept.refresh(first["document"], base, datetime(2001, 4, 1)) is None
    second = tables(document=[uploaded, new, none])
    assert kept.refresh(second["document"], base, datetime(2001, 6, 2)) == [
        date(2001, 1, 1), date(2001, 5, 1)]
    line = replace(FCS.starting(START), uploads_need_box=False)
    got = extracts.upload_records(kept.with_kept(second, base), line)
    assert rows(got) == rows(extracts.upload_records(second, line))
    assert {r["dcsid"]: r["UploadTime"] is None for r in got.collect()} == {
        "f1": False, "f2": True}
    months = spark.read.parquet(f"{base}/folder_uploads").select("image_month").distinct()
    assert {r[0] for r in months.collect()} == {NO_MONTH, date(2001, 1, 1), date(2001, 5, 1)}


def test_a_month_without_documents_any_more_is_emptied(tables, tmp_path):
    one = ("A", "02a", "f1", "i1", "d", "1", 1, 1, None, "2001-05-10 00:00:00")
    base = str(tmp_path)
    kept.refresh(tables(document=[one])["document"], base, datetime(2001, 5, 20))
    none = tables(document=[])
    kept._write(none["document"], base, [date(2001, 5, 1)])
    assert kept.with_kept(none, base)["folder_uploads"].count() == 0


def test_nothing_to_refresh(tables, tmp_path):
    empty = tables(document=[])
    assert kept.refresh(empty["document"], str(tmp_path), AS_OF) is None
    assert kept.refresh(empty["document"], str(tmp_path), AS_OF) == []
    assert kept.with_kept(empty, str(tmp_path))["image_uploads"].count() == 0
