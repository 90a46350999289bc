"""Work that must not grow back: rows that stay where they are, sources read once."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import catalog.relations  # noqa: F401
from catalog.registry import ON_ROLES
from scanyard.functions import curve
from scanyard.operators import joins
from scanyard.operators.projection import or_blank_row
from scanyard.plans import extracts, kept, outstanding
from scanyard.plans.config import FCS, OMPF, VAULT
from scanyard.plans.report_set import report_set, with_folder_names
from scanyard.sources.roles import Roles, derive_roles
from scanyard.sources.tables import scan
from scanyard.sources.schemas import ROLE_SCHEMAS
from tests.conftest import AS_OF
from tests.plan_metrics import counters, files_read, rows_moved

SF, T = "/root/testdata/sf0.001", "2001-06-04 09:00:00"
LINE = OMPF.starting(datetime(1995, 1, 1))


def written(df):
    df.write.format("noop").mode("overwrite").save()


def planned(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def no_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # Maps of keys are broadcast by hand.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def boxes(spark, tables, documents=2_000):
    """Five boxes of the line and very many others, each with a batch, folder and document."""
    roles = tables(check_in=[(f"A{n}", "1Z", "OMPF", "x", "y", T) for n in range(5)])
    box = F.concat(F.lit("A"), F.col("id").cast("string"))
    batch = F.concat(F.lit("02a"), F.col("id").cast("string"))
    time, ids = F.lit(T).cast("timestamp_ntz"), spark.range(documents)
    roles["physical_batch"] = ids.select(
        batch.alias("PBatch"), box.alias("RMN"), F.lit("P").alias("BatchClassName"),
        time.alias("InvTime"))
    folder = F.concat(F.lit("f"), F.col("id").cast("string")).alias("dcsid")
    roles["folder_map"] = ids.select(box.alias("RMN"), batch.alias("PBatch"), folder,
                                     time.alias("InvTime"))
    roles["document"] = ids.select(
        box.alias("RMN"), batch.alias("PBatch"), folder,
        F.concat(F.lit("i"), F.col("id").cast("string")).alias("ImageID"),
        F.lit("x").alias("docidDoctype"), F.lit("1").alias("FileNumber"),
        F.col("id").alias("SysKey"), F.lit(1).alias("NumPages"),
        F.lit(None).cast("timestamp_ntz").alias("ftpstime"), time.alias("ImageDateTime"))
    return roles


def test_rows_that_are_surely_not_listed_are_left_out(frame, values):
    left = frame("k string, n int", [("a", 1), ("b", 2), ("a", 3), (None, 4)])
    assert values(joins.near_listed(left, "k", frame("key string", [("a",), (None,)])), "n") == [
        (1,), (3,)]
    assert values(joins.near_listed(left, "k", frame("key string", []))) == []


def test_uploads_of_other_boxes_are_not_moved(spark, tables, values, no_broadcasts):
    records = extracts.upload_records(boxes(spark, tables), LINE)
    moved = rows_moved(spark, lambda: written(records), "ImageID")
    assert values(records, "RMN") == [(f"A{n}",) for n in range(5)]
    assert 5 <= moved < 500


def test_folders_of_other_batches_are_not_moved(spark, tables, values, no_broadcasts):
    folders = outstanding.r07_open_folders(boxes(spark, tables), LINE)
    moved = rows_moved(spark, lambda: written(folders), "dcsid")
    assert values(folders, "DCSID") == [(f"f{n}",) for n in range(5)]
    assert 5 <= moved < 1_500


def test_placeholder_asks_what_it_is_told(frame, values):
    rows, none = frame("a string", [("x",)]), frame("a string", [])
    assert values(or_blank_row(rows, known_by=rows)) == [("x",)]
    assert values(or_blank_row(none, known_by=none)) == [("",)]


@pytest.mark.parametrize("role", ["document", "folder_map", "physical_batch", "workflow"])
def test_copies_are_made_by_compiled_code(spark, role):
    """No function of an array's elements, which is interpreted row by row."""
    assert "lambda" not in planned(derive_roles(spark, SF)[role])


def test_folders_without_a_number_are_found_once(spark, tmp_path, values):
    """Rows of different orders, alike but for numbers they don't have."""
    at = "timestamp_ntz '2001-06-04 00:00:00'"
    spark.sql(f"select o_orderkey, null as o_custkey, 'F' as o_orderstatus, 1.0d as o_totalprice, "
              f"cast(null as timestamp_ntz) as o_orderdate, '5-LOW' as o_orderpriority "
              "from values (37L), (29L), (29L) t(o_orderkey)").withColumn(
        "o_custkey", F.col("o_custkey").cast("bigint")).write.parquet(
        str(tmp_path / "orders.parquet"))
    spark.sql(f"select l_orderkey, 1L as l_partkey, 1L as l_suppkey, l_linenumber, 1.0d as "
              f"l_quantity, 1.0d as l_extendedprice, 0.0d as l_discount, 0.0d as l_tax, 'N' as "
              f"l_returnflag, 'F' as l_linestatus, {at} as l_shipdate from values (37L, null), "
              "(29L, cast(null as int)), (29L, 1), (29L, 4), (29L, 2) t(l_orderkey, l_linenumber)"
              ).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = derive_roles(spark, str(tmp_path))["folder_map"]
    assert found.count() == found.distinct().count() == 4
    assert values(found.where("dcsid is not null"), "dcsid") == [("29-1",), ("29-2",)]


def test_edges_read_their_rows_once(spark):
    asked = spark.range(1).select(curve.edges(spark.range(12_345), "id").alias("edges"))
    assert planned(asked).count("Range (0, 12345") <= 1
    read = counters(spark, lambda: written(asked))
    assert sum(m.get("number of output rows", 0) for n, _, m in read if n.startswith("Range")) \
        <= 12_345 + 1
    cuts = asked.first()["edges"]
    assert len(cuts) == (1 << curve.BITS) - 1 and cuts == sorted(cuts)


def test_folder_partials_come_from_image_partials(frame, values):
    documents = frame(
        "RMN string, PBatch string, dcsid string, ImageID string, ftpstime timestamp_ntz, "
        "ImageDateTime timestamp_ntz",
        [("A", "b", "f", "i", None, T), ("A", "b", "f", "i", "2001-06-05 10:00:00", T),
         ("A", "b", "f", "j", "2001-06-06 10:00:00", T), (None, "b", None, None, None, None),
         ("A", "b", "f", "k", None, "2001-06-04 00:00:00")])
    folders = kept.partials(documents, "folder_uploads")
    made = kept.to_folders(kept.partials(documents, "image_uploads"))
    assert values(made, *folders.columns) == values(folders) and folders.count() == 3


def test_images_are_flagged_without_expanding_rows(tables, values):
    rows = [("A", "b", "f", image, "x", "1", n, 1, None, T) for n, image in enumerate("iij")]
    rows += [("B", "b", "f", "i", "x", "1", 9, 1, None, T), ("B", "b", "f", None, "x", "1", 10, 1,
                                                             None, T)]
    counted = ON_ROLES["j05_existence_flag"](tables(
        check_in=[("A", "1Z", "OMPF", "x", "y", T)], document=rows))
    assert values(counted) == [("b", 2, 1)]
    assert "Expand" not in planned(counted)


@pytest.mark.parametrize("role", ["document", "folder_map"])
def test_a_report_set_reads_its_sources_once(spark, tmp_path, role):
    derived, base = derive_roles(spark, SF), str(tmp_path)
    derived[role].coalesce(1).write.parquet(f"{base}/{role}.parquet")
    tables = Roles({name: lambda name=name: derived[name] for name in derived} | {
        role: lambda: scan(spark, base, role, ROLE_SCHEMAS[role])})

    def run(given, line):
        for sheet in report_set(given, line.starting(datetime(1995, 1, 1)), AS_OF).values():
            written(sheet)

    def lines():
        shared = with_folder_names(tables)
        for line in (FCS, VAULT):
            run(shared, line)

    assert files_read(spark, lambda: run(tables, OMPF), tmp_path.name) == 1
    if role == "folder_map":
        assert files_read(spark, lines, tmp_path.name) == 1


def test_lines_of_an_order_are_one_row_before_they_meet_it(spark):
    derived = derive_roles(spark, SF)
    moved = sum(m.get("number of output rows", 0) for name, _, m in counters(
        spark, lambda: written(derived["folder_map"])) if "Join" in name)
    orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    assert orders / 2 < moved < 2 * orders
