"""Scans, staging and sinks (S1 to S13). Sinks are written to the shared folder and read back."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import report_sql as sql
from catalog.registry import AS_OF, START, case, table_case
from scanyard import fixed
from scanyard.functions.dates import iso_date, us_date
from scanyard.operators.projection import or_blank_row
from scanyard.plans.config import FCS, OMPF, VAULT, Line
from scanyard.plans.report_set import report_set, with_folder_names
from scanyard.session import shared_dir
from scanyard.sources import files, publish
from scanyard.sources.roles import load_roles, store_roles
from scanyard.sources.schemas import ROLE_SCHEMAS
from scanyard.sources.tables import lookup, materialize, own_name, scan, stage


@table_case("s01_scan", "select o_orderkey, o_custkey, o_orderstatus from orders")
def _(spark, sf_dir):
    return scan(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


_COLUMNS = {role: [column.split()[0] for column in schema.split(", ")]
            for role, schema in ROLE_SCHEMAS.items()}


def _digest_sql(role: str) -> str:
    row = " || '|' || ".join(f"coalesce(cast({c} as varchar), '<null>')" for c in _COLUMNS[role])
    return (f"select '{role}' as role, count(*) as n, "
            f"cast(sum(('0x' || substr(md5({row}), 1, 8))::bigint) as bigint) as digest from {role}")


@case("s01_stored_roles", " union all ".join(map(_digest_sql, ROLE_SCHEMAS)))
def _(roles):
    """Every role table written in its stored form and read back: a hash of all its columns."""
    spark = roles["document"].sparkSession
    base = shared_dir(spark)
    store_roles(roles, base)
    stored = load_roles(spark, base, clean=True)

    def digest(role: str) -> DataFrame:
        row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>"))
                                 for c in _COLUMNS[role]])
        number = F.conv(F.substring(F.md5(row.cast("binary")), 1, 8), 16, 10).cast("bigint")
        return stored[role].agg(F.lit(role).alias("role"), F.count("*").alias("n"),
                                F.sum(number).alias("digest"))
    return reduce(DataFrame.unionByName, map(digest, ROLE_SCHEMAS))


@case("s02_federated_scan", """
    select p.PBatch, p.RMN, w.WFStep, s.BatchName as at_scanner
    from physical_batch p left join workflow w on w.BatchName = p.PBatch
    left join scanner s on s.BatchName = p.PBatch""")
def _(roles):
    """Batches, workflow and scanner come from three sources."""
    at_scanner = roles["scanner"].select(
        F.col("BatchName").alias("PBatch"), F.col("BatchName").alias("at_scanner"))
    steps = roles["workflow"].select(F.col("BatchName").alias("PBatch"), "WFStep")
    return roles["physical_batch"].select("PBatch", "RMN").join(steps, "PBatch", "left").join(
        at_scanner, "PBatch", "left")


@case("s03_dimension_scan", "select * from calendar")
def _(roles):
    return roles["calendar"]


@case("s04_point_lookup", """
    select PBatch from physical_batch where PBatch = '02000000000012'""")
def _(roles):
    return lookup(roles["physical_batch"], "PBatch", "02000000000012")


@case("s05_stage", """
    select claimtype, count(*) as boxes from check_in group by claimtype""")
def _(roles):
    """Staging replaces what stood under the name."""
    stage(roles["calendar"], "staged_boxes")
    staged = stage(roles["check_in"], "staged_boxes")
    return staged.sparkSession.sql(
        "select claimtype, count(*) as boxes from staged_boxes group by claimtype")


@case("s06_materialize", "select RMN, PBatch, BatchClassName from physical_batch")
def _(roles):
    df = roles["physical_batch"].select("RMN", "PBatch", "BatchClassName")
    return materialize(df, own_name("materialized_batches"), shared_dir(df.sparkSession))


_CSV_SCHEMA = "BatchName string, WFStep int, TotalImages int"
_CSV_SQL = "select BatchName, WFStep, TotalImages from workflow"


@case("s07_csv_sink", """
    select BatchName, WFStep, TotalImages, 'queue_06152001_1000' as run from workflow""")
def _(roles):
    """Header line, no index, run-stamped directory name."""
    df = roles["workflow"].select("BatchName", "WFStep", "TotalImages")
    path = files.run_path(f"{shared_dir(df.sparkSession)}/queue", AS_OF)
    files.write_csv(df, path)
    back = files.read_csv(df.sparkSession, path, _CSV_SCHEMA)
    run = F.regexp_extract(F.input_file_name(), r"/(queue_[0-9_]+)/", 1)
    return back.withColumn("run", run)


@case("s08_csv_read", """
    select RMN, trackingno, claimtype from
    (select rtrim(RMN) as RMN, nullif(trackingno, '') as trackingno, claimtype from check_in)""")
def _(roles):
    """A read-back makes text of everything; an empty text and NULL are one."""
    df = roles["check_in"].select("RMN", F.nullif("trackingno", F.lit("")).alias("trackingno"),
                                  "claimtype")
    return files.read_csv(df.sparkSession, files.write_csv(df, shared_dir(df.sparkSession)))


@case("s08_damaged_rows", """
    select 'good' as part, BatchName, WFStep, TotalImages, null as line from workflow
    where TotalImages % 7 not in (0, 1, 2)
    union all
    select 'damaged', null, null, null, case TotalImages % 7
        when 0 then BatchName || ',' || WFStep || ',many'
        when 1 then BatchName || ',' || WFStep
        else BatchName || ',' || WFStep || ',' || TotalImages || ',over' end
    from workflow where TotalImages % 7 in (0, 1, 2)""")
def _(roles):
    """Rows with a value of the wrong type, one too few or one too many go into quarantine."""
    work = roles["workflow"].where("TotalImages is not null")
    kind, start = F.col("TotalImages") % 7, F.concat_ws(",", "BatchName", "WFStep")
    text = F.when(kind == 0, F.concat(start, F.lit(",many"))).when(kind == 1, start).when(
        kind == 2, F.concat_ws(",", "BatchName", "WFStep", "TotalImages", F.lit("over"))
    ).otherwise(F.concat_ws(",", "BatchName", "WFStep", "TotalImages"))
    spark, path = work.sparkSession, shared_dir(work.sparkSession)
    work.select(text.alias("value")).write.text(path)
    good, damaged = files.read_checked(spark, path, _CSV_SCHEMA, header=False)
    return good.select(F.lit("good").alias("part"), "*").unionByName(
        damaged.select(F.lit("damaged").alias("part"), "line"), allowMissingColumns=True)


@case("s09_report_sheets", """
    select 'Batches' as sheet, count(*) as n from physical_batch
    union all select 'Boxes', count(*) from check_in""")
def _(roles):
    sheets = {"Batches": roles["physical_batch"].select("RMN", "PBatch"),
              "Boxes": roles["check_in"].select("RMN", "claimtype")}
    spark = roles["check_in"].sparkSession
    paths = files.write_report(sheets, shared_dir(spark))
    counts = [files.read_csv(spark, path).agg(F.count("*").alias("n"))
              .select(F.lit(sheet).alias("sheet"), "n") for sheet, path in paths.items()]
    return counts[0].unionByName(counts[1])


_SETS = {
    "FCS": (sql.claims_summary(sql.FCS_MASTER, sql.FCS_RECORDS),
            sql.aged(sql.FCS_MASTER, sql.FCS_RECORDS, folders=False),
            sql.aged(sql.FCS_MASTER, sql.FCS_RECORDS, folders=True)),
    "Vault": (sql.claims_summary(sql.VAULT_MASTER, sql.VAULT_RECORDS, "batches <> uploaded_batches"),
              sql.aged(sql.VAULT_MASTER, sql.VAULT_RECORDS, folders=False),
              sql.aged(sql.VAULT_MASTER, sql.VAULT_RECORDS, folders=True)),
    "OMPF": (sql.plain_summary(sql.OMPF_MASTER, sql.OMPF_RECORDS), sql.OPEN_BATCHES,
             sql.OPEN_FOLDERS),
}


_SUMMARY = list(fixed.BOX_SUMMARY_HEADER)
_CLAIMS = [*_SUMMARY[:2], "ClaimType", *_SUMMARY[2:], "Status"]
_AGED = (_CLAIMS, fixed.AGED_BATCH_HEADER, fixed.AGED_FOLDER_HEADER)
_HEADERS = {"FCS": _AGED, "Vault": _AGED,
            "OMPF": (_SUMMARY, fixed.OPEN_BATCH_HEADER, fixed.OPEN_FOLDER_HEADER)}
_WIDEST = max(len(h) for headers in _HEADERS.values() for h in headers)


def _sheet_sql(line: str, sheet: str, text: str, header) -> str:
    cells = [f"coalesce(cast(\"{c}\" as varchar), '')" for c in header]
    cells += ["''"] * (_WIDEST - len(cells))
    named = ", ".join(f"{cell} as c{n}" for n, cell in enumerate(cells))
    return f"select '{line}' as line, '{sheet}' as sheet, {named} from ({text})"


def _sheet_rows(line: str, sheet: str, df: DataFrame) -> DataFrame:
    cells = [F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in df.columns]
    cells += [F.lit("")] * (_WIDEST - len(cells))
    return df.select(F.lit(line).alias("line"), F.lit(sheet).alias("sheet"),
                     *[cell.alias(f"c{n}") for n, cell in enumerate(cells)])


@case("s09_report_sets", " union all ".join(
    _sheet_sql(line, sheet, text, header)
    for line, texts in _SETS.items()
    for sheet, text, header in zip((f"{line} Summary", *fixed.OUTSTANDING_SHEETS), texts,
                                   _HEADERS[line])))
def _(roles):
    """The three sheets of each line under run-stamped names, published as a whole, read back.

    The lines share the list of folders, and are built at the same time."""
    spark = roles["check_in"].sparkSession
    tables = with_folder_names(roles)

    def sheets(line: Line) -> list[DataFrame]:
        base = f"{shared_dir(spark)}/{line.name}"
        publish.publish(report_set(tables, line.starting(START), AS_OF), base,
                        named=lambda sheet: files.run_path(sheet, AS_OF))
        return [_sheet_rows(line.name, sheet, df)
                for sheet, df in publish.read_sheets(spark, base).items()]

    lines = (FCS, VAULT, OMPF)
    with ThreadPoolExecutor(len(lines)) as pool:
        found = [pool.submit(inheritable_thread_target(spark)(sheets), line) for line in lines]
    return reduce(DataFrame.unionByName, [df for one in found for df in one.result()])


@case("s13_published_run", """
    select 'boxes' as sheet, count(*) as n, 2 as run from check_in
    union all select 'none', 1, 2""")
def _(roles):
    """The second run's set is current; a sheet without rows has one row of blanks."""
    boxes = roles["check_in"].select("RMN", "claimtype")
    spark, base = boxes.sparkSession, shared_dir(boxes.sparkSession)
    none = boxes.where("claimtype = 'no such claim'")
    publish.publish({"boxes": none, "none": boxes}, base, or_blank=True)
    publish.publish({"boxes": boxes, "none": none}, base, compression="gzip", or_blank=True)
    sheets = publish.read_sheets(spark, base)
    counts = [df.agg(F.lit(sheet).alias("sheet"), F.count("*").alias("n"), F.lit(2).alias("run"))
              for sheet, df in sheets.items()]
    return counts[0].unionByName(counts[1])


@case("s10_compressed_csv", _CSV_SQL)
def _(roles):
    df = roles["workflow"].select("BatchName", "WFStep", "TotalImages")
    path = files.write_csv(df, shared_dir(df.sparkSession), compression="gzip")
    return files.read_csv(df.sparkSession, path, _CSV_SCHEMA)


@table_case("s11_text_redelimit", """
    select cast(l_orderkey as varchar) || '|' || cast(l_linenumber as varchar) || '|"'
           || l_returnflag || '|' || l_linestatus as value
    from lineitem""")
def _(spark, sf_dir):
    base = shared_dir(spark)
    cells = F.concat_ws("\t", F.col("l_orderkey").cast("string"),
                        F.col("l_linenumber").cast("string"),
                        F.concat(F.lit('"'), F.col("l_returnflag")), F.col("l_linestatus"))
    scan(spark, sf_dir, "lineitem").select(cells.alias("value")).write.text(f"{base}/in")
    files.redelimit(spark, f"{base}/in", f"{base}/out")
    return spark.read.text(f"{base}/out")


@case("s12_blank_row", """
    select 'none' as source, '' as "RMN", '' as "claimtype"
    where not exists (select 1 from check_in where claimtype = 'no such claim')
    union all
    select 'some', rtrim(RMN), claimtype from check_in where claimtype = 'OMPF'""")
def _(roles):
    boxes = roles["check_in"].select("RMN", "claimtype")
    none = or_blank_row(boxes.where(F.col("claimtype") == "no such claim"))
    some = or_blank_row(boxes.where(F.col("claimtype") == "OMPF"))
    return none.select(F.lit("none").alias("source"), "*").unionByName(
        some.select(F.lit("some").alias("source"), "*"))


@case("s13_run_stamped_output", """
    select strftime(calendardate, '%Y-%m-%d') as day,
           'calendar_20010615' as run_day, 'calendar_20010615100000' as run_second,
           strftime(calendardate, '%m/%d/%Y') as us_day
    from calendar""")
def _(roles):
    """The three stamps in use, on files that carry them."""
    spark = roles["calendar"].sparkSession
    base = f"{shared_dir(spark)}/calendar"
    day_path = files.run_path(base, AS_OF, files.STAMP_DAY)
    second_path = files.run_path(base, AS_OF, files.STAMP_SECOND)
    days = roles["calendar"].select(iso_date(F.col("calendardate")).alias("day"),
                                    us_date(F.col("calendardate")).alias("us_day"))
    files.write_csv(days, day_path)
    files.write_csv(days.select("day"), second_path)
    stamp = F.regexp_extract(F.input_file_name(), r"/(calendar_\d+)/", 1)
    first = files.read_csv(spark, day_path).withColumn("run_day", stamp)
    second = files.read_csv(spark, second_path).withColumn("run_second", stamp)
    return first.join(second, "day")
