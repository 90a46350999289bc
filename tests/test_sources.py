from __future__ import annotations

import threading
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from scanyard import session
from scanyard.operators.projection import or_blank_row
from scanyard.plans.queue import r20_redelimit
from scanyard.sources import files, publish, tables as source
from scanyard.sources.roles import derive_roles, load_roles
from scanyard.sources.schemas import ROLE_SCHEMAS
from tests.conftest import AS_OF
from tests.plan_metrics import counters

SF = "/root/testdata/sf0.001"


def test_redelimit_does_not_read_quotes(spark, tmp_path):
    src = tmp_path / "in.txt"
    src.write_text('a\t"b\tc"\n\nd\t|\n')
    r20_redelimit(spark, str(src), str(tmp_path / "out"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(lines) == ["", 'a|"b|c"', "d||"]


@pytest.mark.parametrize("compression, ending", [(None, ".csv"), ("gzip", ".csv.gz")])
def test_csv_round_trip(spark, frame, values, tmp_path, compression, ending):
    rows = [('say "x", y', 1), (None, 2), ("two words ", None)]
    path = files.write_csv(frame("a string, `b(c)` int", rows), str(tmp_path / "t"), compression)
    back = files.read_csv(spark, path, "a string, `b(c)` int")
    assert values(back) == sorted(rows, key=repr)
    assert all(p.name.endswith(ending) for p in (tmp_path / "t").glob("part-*"))


def test_report_sheets(spark, frame, tmp_path):
    sheets = {"Box Summary": frame("a int", [(1,)]), "Outstanding": frame("b int", [])}
    paths = files.write_report(sheets, str(tmp_path))
    assert [files.read_csv(spark, p).columns for p in paths.values()] == [["a"], ["b"]]


def test_run_path():
    assert files.run_path("x/FCS", AS_OF) == "x/FCS_06152001_1000"
    assert files.run_path("x", AS_OF, files.STAMP_DAY) == "x_20010615"
    assert files.run_path("x", datetime(2001, 6, 5, 4, 3, 2), files.STAMP_SECOND) == (
        "x_20010605040302")


def test_jdbc_options():
    plain = source.jdbc_options("jdbc:x", "(select 1) q")
    assert plain == {"url": "jdbc:x", "dbtable": "(select 1) q", "fetchsize": "10000"}
    split = source.jdbc_options("jdbc:x", "t", split_on="id", low=1, high=9, parts=4)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"],
            split["numPartitions"]) == ("id", "1", "9", "4")
    with pytest.raises(ValueError):
        source.jdbc_options("jdbc:x", "t", split_on="id")


def test_stage_replaces(spark, frame, values):
    source.stage(frame("a int", [(1,)]), "staged")
    staged = source.stage(frame("a int", [(2,)]), "staged", keep=True)
    assert values(staged) == [(2,)]
    spark.catalog.clearCache()


def test_materialize_replaces(frame, values, tmp_path):
    source.materialize(frame("a int", [(1,)]), "kept", str(tmp_path / "kept"))
    assert values(source.materialize(frame("a int", [(2,)]), "kept", str(tmp_path / "kept"))) == [(2,)]


def test_lookup(frame, values):
    df = frame("k string, n int", [("a", 1), ("b", 2)])
    assert values(source.lookup(df, "k", "b")) == [("b",)]


def test_derived_roles_have_the_declared_columns(spark):
    roles = derive_roles(spark, SF)
    assert set(roles) == set(ROLE_SCHEMAS)
    for role, schema in ROLE_SCHEMAS.items():
        declared = spark.createDataFrame([], schema).schema
        got = roles[role].schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in declared], role


def test_stored_filters_reach_the_scan(spark, tables, tmp_path):
    from scanyard.sources.roles import store_roles
    store_roles({"physical_batch": tables()["physical_batch"]}, str(tmp_path))
    df = load_roles(spark, str(tmp_path), clean=True)["physical_batch"]
    plan = df.where("PBatch like '02%'").select("RMN")._jdf.queryExecution().toString()
    assert "StringStartsWith(PBatch,02)" in plan
    assert "struct<PBatch:string,RMN:string>" in plan


class _Cluster:
    """Just the settings of a session that the folder choice looks at."""
    def __init__(self, folder, warehouse="/elsewhere"):
        self.conf = {"spark.sql.warehouse.dir": warehouse}
        if folder:
            self.conf["spark.checkpoint.dir"] = folder


def test_shared_folder_is_the_clusters():
    path = session.shared_dir(_Cluster("/shared/ckpt/"))
    assert path.startswith("/shared/ckpt/scanyard/")
    path = session.shared_dir(_Cluster(None, "/warehouse"))
    assert path.startswith("/warehouse/scratch/scanyard/")


def test_unstaged_names_are_gone_and_free(spark):
    from scanyard.sources.tables import stage, unstage
    stage(spark.range(3), "kept_rows", keep=True)
    assert spark.table("kept_rows").count() == 3 and spark.catalog.isCached("kept_rows")
    unstage(spark, "kept_rows")
    assert not spark.catalog.tableExists("kept_rows")
    unstage(spark, "kept_rows")


def test_damaged_rows_go_to_quarantine(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(
        'k,n,t\nx,1,"a, b"\ny,many,c\nz,3\n,,\nv,4,d,over\n"w ",5,\n')
    good, damaged = files.read_checked(spark, str(tmp_path / "in"), "k string, n int, t string")
    assert sorted(map(tuple, good.collect()), key=repr) == [
        ("w ", 5, None), ("x", 1, "a, b"), (None, None, None)]
    assert sorted(r.line for r in damaged.collect()) == ["v,4,d,over", "y,many,c", "z,3"]
    assert {r.file.endswith("/a.csv") for r in damaged.collect()} == {True}
    # Whatever is selected, the same rows are damaged.
    for names in (["k"], ["t"], ["n", "k"]):
        assert good.select(*names).count() == 3 and len(good.select(*names).collect()) == 3
    assert len(damaged.select("line").collect()) == len(damaged.select("t", "line").collect()) == 3
    assert good.count() == damaged.count() == 3
    with pytest.raises(ValueError):
        files.read_checked(spark, str(tmp_path), "line string")


def test_a_run_that_stops_between_sheets_leaves_the_former_set(spark, frame, values, tmp_path):
    base = str(tmp_path / "fcs")
    assert publish.published(spark, base) == {}
    first = {"Summary": frame("a int", [(1,)]), "Open": frame("b int", [(2,), (3,)])}
    run = publish.publish(first, base)
    stops = frame("b int", [(4,)]).select(F.raise_error(F.lit("stop")).cast("int").alias("b"))
    with pytest.raises(Exception, match="stop"):
        publish.publish({"Summary": frame("a int", [(9,)]), "Open": stops}, base)
    sheets = publish.read_sheets(spark, base)
    assert values(sheets["Summary"]) == [("1",)] and values(sheets["Open"]) == [("2",), ("3",)]
    assert {s: n for s, (_, n) in publish.published(spark, base).items()} == {
        "Summary": 1, "Open": 2}
    publish.publish({"Summary": frame("a int", [])}, base, or_blank=True,
                    named=lambda sheet: files.run_path(sheet, AS_OF))
    (path, n), = publish.published(spark, base).values()
    assert path.endswith("/Summary_06152001_1000") and n == 1
    assert values(files.read_csv(spark, path)) == [(None,)]
    # An earlier run can still be read.
    assert set(publish.published(spark, base, run)) == {"Summary", "Open"}


def test_sheets_are_written_at_the_same_time(spark, frame, tmp_path, monkeypatch):
    """Every sheet waits until all have begun."""
    begun, write = threading.Barrier(3, timeout=60), files.write_counted

    def together(*args):
        begun.wait()
        return write(*args)
    monkeypatch.setattr(files, "write_counted", together)
    publish.publish({str(n): frame("a int", [(n,)]) for n in range(3)}, str(tmp_path))
    assert set(publish.published(spark, str(tmp_path))) == {"0", "1", "2"}


def test_counted_write_computes_the_frame_once(spark, frame, tmp_path):
    from tests.plan_metrics import counters
    empty = spark.range(10).where("id > 10").selectExpr("id", "cast(id as string) as `b(c)`")
    run = counters(spark, lambda: files.write_counted(empty, str(tmp_path / "t"), or_blank=True))
    assert sum("Range (0, 10" in desc for _, desc, _ in run) == 1
    assert [r[0] for r in spark.read.text(str(tmp_path / "t")).collect()] == ["id,b(c)", '"",""']
    assert files.write_counted(spark.range(5).toDF("a"), str(tmp_path / "u"), or_blank=True) == 5
    assert files.write_counted(empty, str(tmp_path / "v")) == 0


def test_a_placeholder_report_starts_no_job(spark):
    from tests.plan_metrics import counters
    rows = spark.range(10).groupBy((F.col("id") % 3).alias("k")).agg(F.count("*").alias("n"))
    built = []
    assert counters(spark, lambda: built.append(or_blank_row(rows, ["k"]))) == []
    assert [tuple(r) for r in built[0].collect()] == [("0", "4"), ("1", "3"), ("2", "3")]


def test_the_curve_is_the_morton_order(spark):
    from scanyard.functions.curve import interleave
    cells = spark.range(64).select((F.col("id") % 8).cast("int").alias("x"),
                                   F.floor(F.col("id") / 8).cast("int").alias("y"))
    got = {(r.x, r.y): r.z for r in cells.select(
        "x", "y", interleave(F.col("x"), F.col("y"), 3).alias("z")).collect()}
    for (x, y), z in got.items():
        assert z == sum((x >> i & 1) << (2 * i + 1) | (y >> i & 1) << (2 * i) for i in range(3))


def test_windows_of_either_column_skip_rows(spark, tmp_path):
    """Rows that scans give for three windows: in the order of batches, and along the curve."""
    from scanyard.functions.curve import along_curve
    from tests.plan_metrics import counters
    ids = spark.range(0, 64_000, 1, 4)
    day = F.pmod(F.xxhash64("id"), F.lit(640)).cast("int")
    table = ids.select(
        F.concat(F.lpad((F.col("id") % 8).cast("string"), 2, "0"), F.lpad(
            F.col("id").cast("string"), 9, "0")).alias("PBatch"),
        F.expr("timestamp_ntz'2001-01-01'") .alias("InvTime"), "id")
    table = table.withColumn("InvTime", F.col("InvTime") + F.make_dt_interval(day)).withColumn(
        "received_day", F.to_date("InvTime"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.repartitionByRange("PBatch").sortWithinPartitions("PBatch").write.parquet(
            str(tmp_path / "lines"))
        along_curve(table, "PBatch", "received_day").write.parquet(str(tmp_path / "curve"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    windows = ["PBatch like '02%'",
               "received_day >= '2001-03-01' and received_day < '2001-04-01'",
               "PBatch like '02%' and received_day >= '2001-03-01' "
               "and received_day < '2001-04-01'"]
    scanned = {}
    for kind in ("lines", "curve"):
        stored = spark.read.schema(table.schema).parquet(str(tmp_path / kind))
        assert stored.count() == 64_000
        for window in windows:
            expected = table.where(window).count()
            run = counters(spark, lambda: stored.where(window).write.format("noop").mode(
                "overwrite").save())
            scanned[kind, window] = sum(m.get("number of output rows", 0) for n, _, m in run
                                        if n.startswith("Scan"))
            assert stored.where(window).count() == expected <= scanned[kind, window]
    batch, time, both = ((scanned["lines", w], scanned["curve", w]) for w in windows)
    # A window of time alone read all rows; along the curve it reads a small part.
    assert time[0] == 64_000 and time[1] < 64_000 / 3
    assert both[1] < both[0]
    # For that a prefix of batches alone reads more than it did, though not all.
    assert batch[1] < 64_000 / 2


def test_receipt_windows_reach_the_scan_of_stored_roles(spark, tables, tmp_path):
    from scanyard.plans.config import FCS
    from scanyard.plans.extracts import received
    from scanyard.sources.roles import store_roles
    store_roles({"physical_batch": tables()["physical_batch"]}, str(tmp_path))
    stored = load_roles(spark, str(tmp_path), clean=True)
    found = received(stored, FCS)
    assert found.columns == ["BatchName", "RMN", "BatchClassName", "InvTime"]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = found._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(received_day,2020-06-01)" in plan
    assert "StringStartsWith(PBatch,02)" in plan


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(at).getName() for at in range(found.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_stored_roles_leave_nothing_they_moved(spark, tmp_path):
    from scanyard.sources.roles import store_roles
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    roles, before, setting = derive_roles(spark, SF), shuffle_files(spark), spark.conf.get(key, None)
    store_roles({name: roles[name] for name in ("folder_map", "document", "exported")},
                str(tmp_path))
    until = time.monotonic() + 20
    while shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(key, None) == setting
    assert list(tmp_path.glob("document.parquet/*/*/*.zstd.parquet"))


@pytest.mark.parametrize("role, most", [
    # Lines move to their part and their order, to their order, as one row per order.
    ("customer_data", 2.5), ("folders_done", 1.4), ("boxes_done", 0.8)])
def test_derived_rows_of_an_order_move_to_it_and_no_further(spark, role, most):
    roles, lines = derive_roles(spark, SF), spark.read.parquet(f"{SF}/lineitem.parquet").count()
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        found = counters(spark, lambda: roles[role].write.format("noop").mode("overwrite").save())
    finally:
        spark.conf.set(key, before)
    moved = sum(m.get("shuffle records written", 0) for name, _, m in found if name == "Exchange")
    assert lines / 4 < moved < most * lines


def test_derived_folders_without_a_number_are_one(spark, tmp_path, values):
    """Lines that have no number, of an order that is there twice; no order, no folder."""
    at = "timestamp_ntz '2001-06-04 00:00:00'"
    spark.sql(f"select o_orderkey, 7L as o_custkey, 'F' as o_orderstatus, 1.0d as o_totalprice, {at} "
              "as o_orderdate, '5-LOW' as o_orderpriority from values (28L), (28L), (29L) "
              "t(o_orderkey)").write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql(f"select l_orderkey, 1L as l_partkey, 1L as l_suppkey, l_linenumber, 1.0d as "
              f"l_quantity, 1.0d as l_extendedprice, 0.0d as l_discount, 0.0d as l_tax, 'N' as "
              f"l_returnflag, l_linestatus, {at} as l_shipdate from values (28L, null, 'F'), "
              "(29L, cast(null as int), 'O'), (29L, 1, 'F'), (29L, 4, 'O'), (28L, 2, 'O'), "
              "(null, 1, 'F'), (30L, 1, 'F') t(l_orderkey, l_linenumber, l_linestatus)").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    spark.sql("select 1L as p_partkey, 'a' as p_name, 'b' as p_brand, 't' as p_type, 1 as p_size, "
              "1.0d as p_retailprice").write.parquet(str(tmp_path / "part.parquet"))
    roles, done = derive_roles(spark, str(tmp_path)), datetime(2001, 6, 4)
    assert values(roles["folders_done"]) == sorted(
        [(None, done), ("29-1", done), ("28-2", None)], key=repr)
    assert values(roles["boxes_done"], "CompleteDate") == [(done,)]
    assert values(roles["customer_data"], "dcsid", "Firstname") == sorted(
        [(None, "a"), (None, "a"), ("28-2x", "a"), ("29-1", "a")], key=repr)
