"""Role tables: the inputs of every report.

``load_roles`` reads them from storage; ``derive_roles`` shapes the star-schema test tables
into the same form. Both normalise keys and codes, so reports compare them plainly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanyard.functions.curve import along_curve
from scanyard.functions.text import clean_code, clean_key
from scanyard.session import shared_dir, shuffles_freed
from scanyard.sources.schemas import (CODE_COLUMNS, DOCUMENT_MONTHS, KEY_COLUMNS, RECEIVED_DAY,
                                      ROLE_SCHEMAS, image_month)
from scanyard.sources.tables import scan


# Columns that name a batch, in one table or another.
_BATCH_COLUMNS = ("PBatch", "BatchName", "kbatch", "batchname")


class Roles(Mapping):
    """Role tables by name; each is planned on first use."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, role: str) -> DataFrame:
        if role not in self._frames:
            self._frames[role] = self._builders[role]()
        return self._frames[role]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def normalise(df: DataFrame) -> DataFrame:
    """Trim keys on the right and bring codes to upper case."""
    keys = {c: clean_key(F.col(c)) for c in df.columns if c in KEY_COLUMNS}
    codes = {c: clean_code(F.col(c)) for c in df.columns if c in CODE_COLUMNS}
    return df.withColumns(keys | codes)


def store_roles(roles: Mapping[str, DataFrame], base: str) -> None:
    """Write normalised role tables; documents are kept apart by upload and image month.

    Rows of a month are brought together first, so a month is not a small file per task; the
    rebalance splits a month that is much larger than the others. Documents are uploaded soon after
    they are imaged, so each upload month has few image months. Tables with a receipt time lie
    along a curve through batch and day, so that a batch prefix skips row groups and a window of
    days does too; other rows lie in the order of their batch. Files are compressed closely, and
    what a table moved is off the disks before the next one is written.
    """
    for role, df in roles.items():
        clean = normalise(df)
        spark = clean.sparkSession
        batch = next((c for c in _BATCH_COLUMNS if c in df.columns), None)
        with shuffles_freed(spark):
            if role == "document":
                months = {"upload_month": F.trunc(F.to_date("ftpstime"), "MM"),
                          "image_month": image_month()}
                clean = clean.withColumns(months).hint("rebalance", *months).sortWithinPartitions(
                    *months, "PBatch", "ImageDateTime")
            elif batch and "InvTime" in clean.columns:
                # Written first, so that the sample of the curve does not compute the rows again.
                path = f"{shared_dir(spark)}/{role}"
                _write(clean, path)
                rows = spark.read.schema(clean.schema).parquet(path)
                clean = along_curve(rows.withColumn("received_day", F.to_date("InvTime")), batch,
                                    "received_day")
            elif batch:
                clean = clean.repartitionByRange(batch).sortWithinPartitions(batch)
            _write(clean, f"{base}/{role}.parquet", *(months if role == "document" else ()))


def _write(df: DataFrame, path: str, *parts: str) -> None:
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*parts) if parts else writer).parquet(path)


def load_roles(spark: SparkSession, base: str, clean: bool = False) -> Roles:
    """Role tables under ``base``; ``clean`` says that ``store_roles`` wrote them.

    Tables that are already clean keep their stored columns bare, so that prefix and equality
    filters reach the scan.
    """
    def read(role: str) -> DataFrame:
        schema = ROLE_SCHEMAS[role]
        if not clean:
            return normalise(scan(spark, base, role, schema))
        if role == "document":
            schema += f", {DOCUMENT_MONTHS}"
        if "InvTime" in schema:
            schema += f", {RECEIVED_DAY}"
        return scan(spark, base, role, schema)

    return Roles({role: (lambda role=role: read(role)) for role in ROLE_SCHEMAS})


def _box(cust: str) -> Column:
    return F.expr(f"concat(if({cust} % 10 = 0, '101', '200'), lpad({cust}, 9, '0'))")


def _batch(order: str = "o_orderkey") -> Column:
    return F.expr(
        f"concat(case when {order} % 8 < 2 then '01' when {order} % 8 < 6 then '02' "
        f"when {order} % 8 = 6 then '07' else '08' end, lpad({order}, 12, '0'), "
        f"if({order} % 97 = 0, 'TEST', ''))")


# Location per workflow step in the derived data; step 13 also depends on the customer.
_LOCATION_OF_STEP = {1: 1, 2: 2, 3: 16, 4: 2, 5: 4, 6: 128, 7: 8, 8: 128, 9: 128,
                     10: 32, 11: 32, 12: 64}
_STATUS_CODES = (0, 1, 2, 4, 8)
# Added to the system keys of repeated documents.
_AGAIN = 10_000_000_000
# Remainders of line numbers, which make folders, and the bit of lines without one.
_PARTS, _UNNUMBERED = range(-2, 3), 5
_WEEK = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
_NAMED_DAYS = {"01-01": "New Year", "07-04": "Independence Day", "12-25": "Christmas Day"}


def derive_roles(spark: SparkSession, base: str) -> Roles:
    """Role tables out of ``customer``, ``orders``, ``lineitem`` and ``part``.

    Some rows are repeated with another key, so that boxes, batches, folders and images lie many
    to many; FIXTURES.md lists which.
    """
    c = F.col

    def orders() -> DataFrame:
        return scan(spark, base, "orders")

    def lines() -> DataFrame:
        return scan(spark, base, "lineitem")

    def batches_where(condition: Column, name: str) -> DataFrame:
        return orders().where(condition).select(_batch().alias(name))

    def folder_id() -> Column:
        return F.expr("concat(l_orderkey, '-', l_linenumber % 3)")

    def repeated(df: DataFrame, changes: dict[str, list[tuple[Column, Column]]],
                 number: str = "_copy") -> DataFrame:
        """The rows, and a copy with another value in a column wherever a condition holds.

        ``number`` is 0 in the rows themselves, and the place of its condition in a copy. There is
        always a row, so no test for one is added to the joins below.
        """
        cases = [(name, *one) for name, listed in changes.items() for one in listed]
        none = F.array().cast("array<int>")
        copies = [F.when(condition, F.array(F.lit(n))).otherwise(none)
                  for n, (_, condition, _) in enumerate(cases, 1)]

        def value(name: str) -> Column:
            shown = c(name)
            for n, (changed, _, other) in enumerate(cases, 1):
                if changed == name:
                    shown = F.when(c(number) == n, other).otherwise(shown)
            return shown.alias(name)

        numbered = df.withColumn(number, F.explode_outer(F.concat(F.array(F.lit(0)), *copies)))
        return numbered.select(*map(value, df.columns), number)

    def check_in() -> DataFrame:
        k = c("c_custkey")
        boxes = scan(spark, base, "customer").select(
            k,
            F.concat(_box("c_custkey"), F.lit("  ")).alias("RMN"),
            F.when(k % 17 == 0, None).when(k % 19 == 0, "").when(k % 23 == 0, "1234DUMMY1234")
            .otherwise(c("c_name")).alias("trackingno"),
            F.when(c("c_mktsegment") == "BUILDING", "OMPF")
            .when(c("c_mktsegment") == "MACHINERY", None)
            .otherwise(c("c_mktsegment")).alias("claimtype"),
            F.when(c("c_nationkey") % 2 == 0, "fcs").otherwise("other").alias("boxOrigin"),
            F.when(c("c_nationkey") % 3 == 0, "other").otherwise("ro").alias("boxSource"),
            F.date_add(F.lit("1995-01-01").cast("date"), (k % 1000).cast("int"))
            .cast("timestamp_ntz").alias("insertdate"),
        )
        other = F.when(c("claimtype") == "OMPF", "AUTOMOBILE").otherwise("OMPF")
        return repeated(boxes, {"claimtype": [(k % 43 == 0, other)]}).drop("c_custkey", "_copy")

    def physical_batch() -> DataFrame:
        o = c("o_orderkey")
        batches = orders().select(
            o, c("o_custkey"),
            _batch().alias("PBatch"),
            _box("o_custkey").alias("RMN"),
            F.when(c("o_orderpriority") == "1-URGENT", "SM")
            .when(c("o_orderpriority") == "5-LOW", None).otherwise("P").alias("BatchClassName"),
            _inv_time().alias("InvTime"),
        )
        return repeated(batches, {
            "RMN": [(o % 41 == 0, _box("(o_custkey + 1)"))],
            "InvTime": [(o % 47 == 0, c("InvTime") + F.make_dt_interval(F.lit(3)))],
            "PBatch": [(o % 59 == 0, F.concat("PBatch", F.lit("N")))],
        }).drop("o_orderkey", "o_custkey", "_copy")

    def _inv_time() -> Column:
        return c("o_orderdate") + F.make_dt_interval(
            F.lit(0), (c("o_orderkey") % 24).cast("int"))

    def placed_orders() -> DataFrame:
        """Batch and box of documents are made, and repeated, once per order rather than per line."""
        o = c("o_orderkey")
        entries = orders().select(o, c("o_custkey"), _batch().alias("PBatch"),
                                  _box("o_custkey").alias("RMN"))
        return repeated(entries, {"PBatch": [(o % 37 == 0, _batch("(o_orderkey - 8)"))],
                                  "RMN": [(o % 39 == 0, _box("(o_custkey + 1)"))]})

    def uploaded() -> Column:
        return F.when(c("l_linestatus") == "F", c("l_shipdate")).alias("ftpstime")

    def document() -> DataFrame:
        placed = placed_orders()
        names = [column.split()[0] for column in ROLE_SCHEMAS["document"].split(", ")]
        return lines().join(placed.drop("o_custkey"), c("l_orderkey") == c("o_orderkey")).select(
            "RMN", "PBatch",
            folder_id().alias("dcsid"),
            F.expr("concat(l_orderkey, '-', l_linenumber)").alias("ImageID"),
            c("l_returnflag").alias("docidDoctype"),
            F.concat(F.lit(" "), c("l_partkey").cast("string"), F.lit("  ")).alias("FileNumber"),
            (c("l_orderkey") * 10 + c("l_linenumber") + c("_copy") * _AGAIN).alias("SysKey"),
            c("l_quantity").cast("int").alias("NumPages"),
            uploaded(),
            (c("l_shipdate") - F.make_dt_interval(F.lit(1))).alias("ImageDateTime"),
        ).select(*names)

    def folder_map() -> DataFrame:
        o, names = c("o_orderkey"), ["RMN", "PBatch", "dcsid", "InvTime"]
        entry = [o, _batch().alias("PBatch"), _box("o_custkey").alias("RMN"),
                 _inv_time().alias("InvTime")]
        placed = repeated(orders().select(*entry), {
            "PBatch": [(o % 37 == 0, _batch("(o_orderkey - 8)"))]})
        # What parts an order has is a bit each, so that its lines become one row before they meet
        # the order: -2 to 2, and one for lines without a number.
        parts = lines().where(c("l_orderkey").isNotNull()).groupBy("l_orderkey").agg(F.expr(
            f"bit_or(shiftleft(1, coalesce(l_linenumber % 3 + 2, {_UNNUMBERED})))").alias("_parts"))
        # The number of a folder names its order, so rows of different orders differ, and those
        # of one lie together after the join. Only folders without a number must be compared.
        placed = parts.join(placed, c("l_orderkey") == o).select(
            "l_orderkey", "_parts", "RMN", "PBatch", "InvTime").distinct()

        def having(number: int) -> Column:
            return F.getbit("_parts", F.lit(number)) == 1

        none = F.array().cast("array<int>")
        numbers = F.concat(*[F.when(having(n + 2), F.array(F.lit(n))).otherwise(none)
                             for n in _PARTS])
        numbered = placed.withColumn("_part", F.explode(numbers)).withColumn(
            "dcsid", F.concat(c("l_orderkey").cast("string"), F.lit("-"),
                              c("_part").cast("string")))
        unnumbered = placed.where(having(_UNNUMBERED)).withColumn(
            "dcsid", F.lit(None).cast("string")).select(*names).distinct()
        waiting = orders().where(o % 59 == 0).select(
            "*", *entry[1:]).withColumns({
                "PBatch": F.concat("PBatch", F.lit("N")),
                "dcsid": F.concat(o.cast("string"), F.lit("-9"))}).select(*names).distinct()
        return numbered.select(*names).unionByName(unnumbered).unionByName(waiting)

    def customer_data() -> DataFrame:
        names = ["dcsid", "PBatch", "Firstname", "Lastname", "Recvdate"]
        received = orders().select("o_orderkey", "o_orderdate", _batch().alias("PBatch"))

        def customers(some: Column) -> DataFrame:
            # Orders come last, so rows of one lie together and are compared where they are.
            return (
                lines().where(some).join(scan(spark, base, "part"), c("l_partkey") == c("p_partkey"))
                .select("l_orderkey", (c("l_linenumber") % 3).alias("_part"), "p_name", "p_brand")
                .join(received, c("l_orderkey") == c("o_orderkey"))
                .select("l_orderkey", "_part", "PBatch", c("p_name").alias("Firstname"),
                        c("p_brand").alias("Lastname"), c("o_orderdate").alias("Recvdate"))
                .distinct())

        # The number of a folder names its order, as in the folder map.
        numbered = customers(c("l_linenumber").isNotNull()).withColumn("dcsid", F.concat(
            c("l_orderkey").cast("string"), F.lit("-"), c("_part").cast("string"),
            F.when(c("l_orderkey") % 7 == 0, "x").otherwise("")))
        unnumbered = customers(c("l_linenumber").isNull()).withColumn(
            "dcsid", F.lit(None).cast("string")).select(*names).distinct()
        return numbered.select(*names).unionByName(unnumbered)

    def workflow() -> DataFrame:
        o, step = c("o_orderkey"), c("o_orderkey") % 13 + 1
        location = F.when(step == 13, F.when(c("o_custkey") % 2 == 0, 256).otherwise(0))
        for at_step, place in _LOCATION_OF_STEP.items():
            location = location.when(step == at_step, place)
        status = F.when(o % 5 == 0, _STATUS_CODES[0])
        for code in range(1, 5):
            status = status.when(o % 5 == code, _STATUS_CODES[code])
        steps = orders().where(o % 11 != 0).select(
            o, _batch().alias("BatchName"),
            step.cast("int").alias("WFStep"),
            location.cast("int").alias("BatchLocation"),
            status.cast("int").alias("BatchStatus"),
            F.floor(c("o_totalprice") / 1000).cast("int").alias("TotalImages"),
            F.when(c("o_custkey") % 3 == 0, 9).otherwise(8).cast("int").alias("jobid"),
        )
        elsewhere = (o % 53 == 0) & (c("WFStep") <= 11), c("BatchLocation") + 512
        return repeated(steps, {"BatchLocation": [elsewhere]}).drop("o_orderkey", "_copy")

    def ocr(shard: int) -> DataFrame:
        o = c("o_orderkey")
        here = (o % 5 == shard) | ((o % 2 == 0) & ((o + 1) % 5 == shard))
        return orders().where((o % 29 == 0) & here).select(
            _batch().alias("BatchName"),
            F.floor(c("o_totalprice") / 500).cast("int").alias("TotalImages"),
            (c("o_custkey") % 4).cast("int").alias("BatchLocation"),
        )

    def calendar() -> DataFrame:
        day = c("calendardate")
        days = orders().select(F.to_date("o_orderdate").alias("calendardate")).distinct()
        since = F.date_diff(day, F.lit("1995-01-01").cast("date"))
        week = F.array(*[F.lit(name) for name in _WEEK])
        named = None
        for month_day, name in _NAMED_DAYS.items():
            hit = F.date_format(day, "MM-dd") == month_day
            named = F.when(hit, name) if named is None else named.when(hit, name)
        return days.select(day, F.get(week, F.pmod(since, F.lit(7))).alias("DayOfWeekName"),
                           named.alias("CalendarDateDescription"))

    def second_site() -> DataFrame:
        return (
            lines().where(c("l_suppkey") % 10 == 0)
            .groupBy(F.to_date("l_shipdate").alias("UploadDate"))
            .agg(F.count("*").alias("docs"), F.sum("l_quantity").cast("bigint").alias("images"))
        )

    last = F.max("ftpstime").alias("CompleteDate")

    def boxes_done() -> DataFrame:
        """The last upload of the documents of a box, which are those of its orders."""
        orders_done = lines().where(c("l_orderkey").isNotNull()).select(
            "l_orderkey", uploaded()).groupBy("l_orderkey").agg(F.max("ftpstime").alias("ftpstime"))
        return orders_done.join(placed_orders(), c("l_orderkey") == c("o_orderkey")).groupBy(
            "RMN").agg(last)

    def folders_done() -> DataFrame:
        """The last upload of the documents of a folder, whose number names their order."""
        def folders(some: Column) -> DataFrame:
            return lines().where(some).select(
                "l_orderkey", (c("l_linenumber") % 3).alias("_part"), uploaded()).join(
                orders().select("o_orderkey"), c("l_orderkey") == c("o_orderkey"), "left_semi")

        # Rows of an order lie together after the join, and so do those of its folders.
        numbered = folders(c("l_linenumber").isNotNull()).groupBy("l_orderkey", "_part").agg(
            last).select(F.concat(c("l_orderkey").cast("string"), F.lit("-"),
                                  c("_part").cast("string")).alias("dcsid"), "CompleteDate")
        unnumbered = folders(c("l_linenumber").isNull()).groupBy(
            c("_part").cast("string").alias("dcsid")).agg(last)
        return numbered.unionByName(unnumbered)

    in_f, in_fp = c("o_orderstatus") == "F", c("o_orderstatus").isin("F", "P")
    builders = {
        "check_in": check_in,
        "physical_batch": physical_batch,
        "folder_map": folder_map,
        "document": document,
        "customer_data": customer_data,
        "workflow": workflow,
        "scanner": lambda: batches_where(c("o_orderkey") % 22 == 0, "BatchName"),
        "exported": lambda: batches_where(in_f, "kbatch"),
        "scanner_stats": lambda: batches_where(in_fp, "kbatch"),
        "audit": lambda: batches_where(in_fp, "batchname"),
        **{f"ocr{n}": (lambda n=n: ocr(n % 5)) for n in range(1, 6)},
        "calendar": calendar,
        "second_site": second_site,
        "qa_exceptions": lambda: batches_where(c("o_orderkey") % 101 == 0, "batchname"),
        "excluded_folders": lambda: document().select("dcsid").distinct()
        .where(c("dcsid").startswith("5")).withColumnRenamed("dcsid", "dcs"),
        "boxes_done": boxes_done,
        "folders_done": folders_done,
    }
    return Roles({role: (lambda b=b: normalise(b())) for role, b in builders.items()})
